"""Ordered rule classifiers.

The reference writes its classifications as long ``CASE`` chains where the first
matching branch wins. Here one generic builder, :func:`classify`, turns an
ordered list of rules into a single chained ``when`` expression; the rule lists
themselves are plain data. Matching is substring containment (``LIKE '%x%'``)
on the text as given: no accent folding, order preserved (T23).
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# A rule is (label, alternatives); alternatives is a list of conjunctions, each a
# list of substrings: [["a"], ["b", "c"]] means  x LIKE '%a%' OR (x LIKE '%b%' AND x LIKE '%c%').
Rule = tuple[str, Sequence[Sequence[str]]]


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(text: Column, alternatives: Sequence[Sequence[str]]) -> Column:
    """OR over conjunctions of ``contains`` tests."""
    ors = None
    for conj in alternatives:
        ands = None
        for needle in conj:
            t = text.contains(needle)
            ands = t if ands is None else (ands & t)
        ors = ands if ors is None else (ors | ands)
    return ors


def classify(text: ColumnOrName, rules: Iterable[Rule], default: str | None,
             fold: Callable[[Column], Column] | None = None) -> Column:
    """First-match-wins classification of a text column.

    ``fold`` is applied to the text once (e.g. ``F.lower``) before matching.
    NULL text matches nothing and falls to ``default``.
    """
    t = _c(text)
    if fold is not None:
        t = fold(t)
    expr = None
    for label, alternatives in rules:
        cond = F.coalesce(contains_any(t, alternatives), F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def classify_when(branches: Iterable[tuple[Column, str]], default: str | None) -> Column:
    """First-match-wins over arbitrary predicates (numeric bands etc.)."""
    expr = None
    for cond, label in branches:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


# =====================================================================================
# Fixed values. These labels, thresholds and substrings must equal the reference's
# for identical results; they are listed in the reference's own order.
# =====================================================================================

# C07 specialty category: matched on lower(Fonction); the second rule also needs a
# non-blank Specialite and is handled in specialty_category().
SPECIALTY_RULES: list[Rule] = [
    ("Medecine generale", [["medecin generaliste"], ["medecine generale"]]),
    ("Medecine specialisee", [["medecin"]]),
    ("Soins infirmiers", [["infirmier"], ["ide"]]),
    ("Aide soignant", [["aide-soignant"], ["as "]]),
    ("Reeducation", [["kinesitherapeute"], ["masseur-kine"], ["mkde"]]),
    ("Medecine alternative", [["osteopathe"], ["chiropracteur"], ["etiopathe"]]),
    ("Obstetrique", [["sage-femme"], ["maieuticien"]]),
    ("Dentaire", [["dentiste"], ["chirurgien-dentiste"], ["odontolog"]]),
    ("Pharmacie", [["pharmacien"]]),
    ("Sante mentale", [["psychologue"], ["psychotherapeute"], ["psychiatre"]]),
    ("Imagerie medicale", [["radiologue"], ["imagerie"]]),
    ("Biologie medicale", [["biologiste"], ["laborantin"]]),
    ("Anesthesie", [["anesthes"]]),
    ("Chirurgie", [["chirurg"]]),
    ("Cardiologie", [["cardio"]]),
    ("Pediatrie", [["pediatr"]]),
    ("Gynecologie", [["gyneco"]]),
    ("Ophtalmologie", [["ophtalmolog"]]),
    ("ORL", [["orl"], ["oto-rhino"]]),
    ("Dermatologie", [["dermato"]]),
    ("Orthopedie", [["orthoped"], ["traumatolog"]]),
    ("Neurologie", [["neurologue"], ["neuro-"]]),
    ("Oncologie", [["radiotherap"], ["oncolog"]]),
    ("Medecine d'urgence", [["urgentiste"], ["urgence"]]),
    ("Geriatrie", [["geriatre"], ["gerontolog"]]),
    ("Readaptation", [["reeducateur"], ["readaptation"]]),
    ("Dietetique", [["dieteticien"], ["nutritionniste"]]),
    ("Ergotherapie", [["ergotherapeute"]]),
    ("Orthophonie", [["orthophoniste"]]),
    ("Orthoptie", [["orthoptiste"]]),
    ("Podologie", [["podologue"], ["pedicure"]]),
    ("Techniques medicales", [["manipulateur"], ["technicien radiolog"]]),
    ("Transport sanitaire", [["ambulancier"]]),
    ("Preparation pharmaceutique", [["preparateur"]]),
]
SPECIALTY_DEFAULT = "Autre"

# C08 ICD-10 chapters: inclusive string ranges on the 3-character category.
ICD10_CHAPTERS: list[tuple[str, str, str]] = [
    ("A00", "B99", "Maladies infectieuses et parasitaires"),
    ("C00", "D48", "Tumeurs"),
    ("D50", "D89", "Maladies du sang et organes hematopoietiques"),
    ("E00", "E90", "Maladies endocriniennes, nutritionnelles et metaboliques"),
    ("F00", "F99", "Troubles mentaux et du comportement"),
    ("G00", "G99", "Maladies du systeme nerveux"),
    ("H00", "H59", "Maladies de l'oeil et annexes"),
    ("H60", "H95", "Maladies de l'oreille et apophyse mastoide"),
    ("I00", "I99", "Maladies de l'appareil circulatoire"),
    ("J00", "J99", "Maladies de l'appareil respiratoire"),
    ("K00", "K93", "Maladies de l'appareil digestif"),
    ("L00", "L99", "Maladies de la peau et du tissu cellulaire sous-cutane"),
    ("M00", "M99", "Maladies du systeme osteo-articulaire et musculaire"),
    ("N00", "N99", "Maladies de l'appareil genito-urinaire"),
    ("O00", "O99", "Grossesse, accouchement et puerperalite"),
    ("P00", "P96", "Affections perinatales"),
    ("Q00", "Q99", "Malformations congenitales"),
    ("R00", "R99", "Symptomes, signes et resultats anormaux"),
    ("S00", "T98", "Lesions traumatiques, empoisonnements"),
    ("V01", "Y98", "Causes externes de morbidite et de mortalite"),
    ("Z00", "Z99", "Facteurs influant sur l'etat de sante"),
]
ICD10_DEFAULT = "Autre ou non classe"

# C09 establishment type: matched on upper(raison_sociale_site).
FACILITY_TYPE_RULES: list[Rule] = [
    ("CHU", [["CHU"], ["UNIVERSITAIRE"]]),
    ("Hopital Public", [["CH "], ["HOPITAL"], ["HOSP"]]),
    ("Clinique Privee", [["CLINIQUE"]]),
    ("EHPAD", [["EHPAD"]]),
    ("Maison de Retraite", [["MAISON", "RETRAITE"]]),
    ("Centre de Sante", [["CENTRE", "SANTE"]]),
    ("Cabinet Medical", [["CABINET"]]),
    ("Laboratoire", [["LABORATOIRE"], ["LABO"]]),
    ("Pharmacie", [["PHARMACIE"]]),
    ("Centre Communal Action Sociale", [["CIAS"], ["CCAS"]]),
    ("Conseil Departemental", [["CONSEIL", "DEPARTEMENTAL"]]),
]
FACILITY_TYPE_DEFAULT = "Autre etablissement"

# C10 establishment sector, on upper(raison_sociale_site).
FACILITY_SECTOR_RULES: list[Rule] = [
    ("Public", [["CHU"], ["CH "], ["HOPITAL"], ["CONSEIL"]]),
    ("Prive", [["CLINIQUE"], ["CABINET"]]),
    ("Medico-social", [["EHPAD"], ["MAISON"], ["CIAS"]]),
]
FACILITY_SECTOR_DEFAULT = "Non determine"

# C11 department -> region (the region map appears twice in the reference).
REGION_DEPARTMENTS: list[tuple[str, list[str]]] = [
    ("Ile-de-France", ["75", "77", "78", "91", "92", "93", "94", "95"]),
    ("Provence-Alpes-Cote d'Azur", ["04", "05", "06", "13", "83", "84"]),
    ("Auvergne-Rhone-Alpes", ["01", "03", "07", "15", "26", "38", "42", "43", "63", "69", "73", "74"]),
    ("Nouvelle-Aquitaine", ["16", "17", "19", "23", "24", "33", "40", "47", "64", "79", "86", "87"]),
    ("Occitanie", ["09", "11", "12", "30", "31", "32", "34", "46", "48", "65", "66", "81", "82"]),
    ("Hauts-de-France", ["02", "59", "60", "62", "80"]),
    ("Normandie", ["14", "27", "50", "61", "76"]),
    ("Grand Est", ["08", "10", "51", "52", "54", "55", "57", "67", "68", "88"]),
    ("Bourgogne-Franche-Comte", ["21", "25", "39", "58", "70", "71", "89", "90"]),
    ("Pays de la Loire", ["44", "49", "53", "72", "85"]),
    ("Bretagne", ["22", "29", "35", "56"]),
    ("Centre-Val de Loire", ["18", "28", "36", "37", "41", "45"]),
    ("Corse", ["2A", "2B", "20"]),
    ("Outre-mer", ["971", "97", "972", "973", "974", "976"]),
]
REGION_DEFAULT = "Non renseigne"

# C12 practice mode on categorie_professionnelle (accented or not).
PRACTICE_MODE_RULES: list[Rule] = [
    ("Libéral", [["Libéral"], ["Liberal"]]),
    ("Salarié", [["Salarié"], ["Salarie"]]),
    ("Mixte", [["Mixte"]]),
]
PRACTICE_MODE_DEFAULT = "Non renseigné"

# C06 insurer type on lower(Nom).
INSURER_RULES: list[Rule] = [
    ("CMU", [["cmu"]]),
    ("Assurance", [["assurance"]]),
]
INSURER_DEFAULT = "Mutuelle"

# C14 French day names (1 = Monday ... 7 = Sunday) and month names.
DAY_NAMES = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
MONTH_NAMES = ["Janvier", "Fevrier", "Mars", "Avril", "Mai", "Juin", "Juillet", "Aout",
               "Septembre", "Octobre", "Novembre", "Decembre"]

# C15 seasons by month.
SEASONS = [("Printemps", [3, 4, 5]), ("Ete", [6, 7, 8]), ("Automne", [9, 10, 11])]
SEASON_DEFAULT = "Hiver"

# C20 coverage zones (documentation rule).
ZONE_PARIS = ["75", "92", "93", "94"]
ZONE_OUTER = ["77", "78", "91", "95"]
ZONE_OVERSEAS = ["971", "972", "973", "974", "976"]

# C21 insurer group labels (documentation rule).
INSURER_GROUPS = [
    ("MUTUELLE", "MUTUELLE_COMPLEMENTAIRE"),
    ("ASSURANCE", "ASSURANCE_PRIVEE"),
    ("PREVOYANCE", "INSTITUTION_PREVOYANCE"),
    ("CMU", "COUVERTURE_UNIVERSELLE"),
]
INSURER_GROUP_DEFAULT = "AUTRE_ORGANISME"

# C18 satisfaction level thresholds (>=), and C22 territorial score weights.
SATISFACTION_LEVELS = [(80, "EXCELLENCE"), (70, "TRES_SATISFAISANT"), (60, "SATISFAISANT"),
                       (50, "A_AMELIORER")]
SATISFACTION_DEFAULT = "INSUFFISANT"
SATISFACTION_TOP_REGIONAL = "EXCELLENCE_REGIONALE"
SATISFACTION_NOT_RATED = "NON_EVALUE"
TERRITORIAL_WEIGHTS = (0.3, 0.7)

# =====================================================================================
# Classifiers
# =====================================================================================


def age_band(age: ColumnOrName) -> Column:
    """Patient age band. Parity: 18 and unknown ages fall into '66+' (T1)."""
    a = _c(age)
    return classify_when([(a < 18, "0-18"), (a.between(19, 30), "19-30"),
                          (a.between(31, 50), "31-50"), (a.between(51, 65), "51-65")], "66+")


def death_age_band(age: ColumnOrName) -> Column:
    """Age band at death."""
    a = _c(age)
    return classify_when([(a < 1, "MOINS_1_AN"), (a.between(1, 18), "ENFANT"),
                          (a.between(19, 30), "JEUNE_ADULTE"), (a.between(31, 65), "ADULTE"),
                          (a > 65, "SENIOR")], "NON_RENSEIGNE")


def patient_category(age: ColumnOrName) -> Column:
    """PEDIATRIE below 18, GERIATRIE above 65, else ADULTE (NULL -> ADULTE)."""
    a = _c(age)
    return classify_when([(a < 18, "PEDIATRIE"), (a > 65, "GERIATRIE")], "ADULTE")


def consultation_length(minutes: ColumnOrName) -> Column:
    """COURTE < 15 <= NORMALE <= 30 < LONGUE; NULL -> NON_RENSEIGNEE."""
    m = _c(minutes)
    return classify_when([(m < 15, "COURTE"), (m.between(15, 30), "NORMALE"),
                          (m > 30, "LONGUE")], "NON_RENSEIGNEE")


def stay_type(days: ColumnOrName) -> Column:
    """COURT_SEJOUR < 3 <= MOYEN_SEJOUR <= 7 < LONG_SEJOUR."""
    d = _c(days)
    return classify_when([(d < 3, "COURT_SEJOUR"), (d.between(3, 7), "MOYEN_SEJOUR"),
                          (d > 7, "LONG_SEJOUR")], "NON_RENSEIGNE")


def insurer_type(name: ColumnOrName) -> Column:
    """CMU / Assurance / Mutuelle from the insurer name, case-folded."""
    return classify(name, INSURER_RULES, INSURER_DEFAULT, fold=F.lower)


def specialty_category(fonction: ColumnOrName, specialite: ColumnOrName) -> Column:
    """34 ordered branches on lower(fonction) + 'Autre' (T23)."""
    f = F.lower(_c(fonction))
    s = _c(specialite)
    expr = None
    for label, alternatives in SPECIALTY_RULES:
        cond = F.coalesce(contains_any(f, alternatives), F.lit(False))
        if label == "Medecine specialisee":
            cond = cond & F.coalesce(s.isNotNull() & (F.trim(s) != ""), F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(SPECIALTY_DEFAULT))


def icd10_chapter(category: ColumnOrName) -> Column:
    """ICD-10 chapter from the 3-character category (binary string ranges)."""
    c = _c(category)
    return classify_when([(c.between(lo, hi), label) for lo, hi, label in ICD10_CHAPTERS],
                         ICD10_DEFAULT)


def facility_type(name: ColumnOrName) -> Column:
    """Establishment type from the upper-cased name."""
    return classify(name, FACILITY_TYPE_RULES, FACILITY_TYPE_DEFAULT, fold=F.upper)


def facility_sector(name: ColumnOrName) -> Column:
    """Public / Prive / Medico-social from the upper-cased name."""
    return classify(name, FACILITY_SECTOR_RULES, FACILITY_SECTOR_DEFAULT, fold=F.upper)


def region_of(dept: ColumnOrName) -> Column:
    """C11: region from a department code; a literal map lookup (O(1) per row).

    Parity: the map is keyed on exact codes, so 2-character departments never
    reach the 3-character overseas keys, only '97' (T25).
    """
    pairs = []
    for region, depts in REGION_DEPARTMENTS:
        for d in depts:
            pairs += [F.lit(d), F.lit(region)]
    lookup = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(lookup, _c(dept)), F.lit(REGION_DEFAULT))


def practice_mode(categorie: ColumnOrName) -> Column:
    """Practice mode from the professional category (accented or not)."""
    return classify(categorie, PRACTICE_MODE_RULES, PRACTICE_MODE_DEFAULT)


def has_active_cover(insurer_id: ColumnOrName, status: ColumnOrName) -> Column:
    """True when a matched insurer exists and the membership is ACTIF."""
    return F.coalesce(_c(insurer_id).isNotNull() & (_c(status) == "ACTIF"), F.lit(False))


def day_name(d: ColumnOrName) -> Column:
    """C14: French day name (Monday first)."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.weekday(_c(d)) + 1)


def month_name(d: ColumnOrName) -> Column:
    """C14: French month name."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.element_at(names, F.month(_c(d)))


def season(month: ColumnOrName) -> Column:
    """Season from the month number."""
    m = _c(month)
    return classify_when([(m.isin(*ms), label) for label, ms in SEASONS], SEASON_DEFAULT)


def is_weekend(d: ColumnOrName) -> Column:
    """Saturday or Sunday."""
    return F.weekday(_c(d)).isin(5, 6)


def stay_class(days: ColumnOrName) -> Column:
    """C17: AMBULATOIRE / COURT_SEJOUR / SEJOUR_NORMAL / SEJOUR_LONG / SEJOUR_TRES_LONG."""
    d = _c(days)
    return classify_when([(d == 0, "AMBULATOIRE"), (d == 1, "COURT_SEJOUR"),
                          (d.between(2, 7), "SEJOUR_NORMAL"), (d.between(8, 21), "SEJOUR_LONG")],
                         "SEJOUR_TRES_LONG")


def stay_complexity(chapter: ColumnOrName, days: ColumnOrName) -> Column:
    """C17: COMPLEXE / LONG_TERME / STANDARD."""
    ch, d = _c(chapter), _c(days)
    return classify_when([(ch.isin("CHIRURGIE", "TRAUMATOLOGIE") & (d >= 5), "COMPLEXE"),
                          (d >= 15, "LONG_TERME")], "STANDARD")


def satisfaction_level(score: ColumnOrName, regional: bool = False) -> Column:
    """Level of an aggregated satisfaction score (NULL -> lowest level).

    The regional variant names its top level EXCELLENCE_REGIONALE; the other
    labels are shared.
    """
    s = _c(score)
    labels = [(t, label) for t, label in SATISFACTION_LEVELS]
    if regional:
        labels[0] = (labels[0][0], SATISFACTION_TOP_REGIONAL)
    return classify_when([(s >= t, label) for t, label in labels], SATISFACTION_DEFAULT)


def mortality_class(age: ColumnOrName) -> Column:
    """Epidemiological mortality class."""
    a = _c(age)
    return classify_when([(a < 1, "MORTALITE_INFANTILE"), (a.between(1, 14), "MORTALITE_JUVENILE"),
                          (a.between(15, 44), "MORTALITE_JEUNE_ADULTE"),
                          (a.between(45, 64), "MORTALITE_ADULTE"),
                          (a.between(65, 84), "MORTALITE_SENIOR")], "MORTALITE_TRES_SENIOR")


def coverage_zone(dept: ColumnOrName, region: ColumnOrName) -> Column:
    """C20: geographic coverage zone."""
    d, r = _c(dept), _c(region)
    return classify_when([(d.isin(*ZONE_PARIS), "PARIS_PETITE_COURONNE"),
                          (d.isin(*ZONE_OUTER), "GRANDE_COURONNE"),
                          (r == "ILE_DE_FRANCE", "ILE_DE_FRANCE_AUTRE"),
                          (d.between("01", "95"), "FRANCE_METROPOLITAINE"),
                          (d.isin(*ZONE_OVERSEAS), "OUTRE_MER")], "ETRANGER_OU_INCONNU")


def insurer_group(kind: ColumnOrName) -> Column:
    """Insurer group label."""
    k = _c(kind)
    return classify_when([(k == key, label) for key, label in INSURER_GROUPS],
                         INSURER_GROUP_DEFAULT)


def completeness(n_deaths: ColumnOrName, satisfaction: ColumnOrName) -> Column:
    """Which territorial measures are present."""
    n = F.coalesce(_c(n_deaths), F.lit(0))
    s = F.coalesce(_c(satisfaction), F.lit(0))
    return classify_when([((n > 0) & (s > 0), "DONNEES_COMPLETES"), (n > 0, "DECES_SEULEMENT"),
                          (s > 0, "SATISFACTION_SEULEMENT")], "DONNEES_MANQUANTES")


def territorial_score(n_deaths: ColumnOrName, senior_pct: ColumnOrName,
                      satisfaction: ColumnOrName) -> Column:
    """Weighted score (100 - min(senior share, 100)) * 0.3 + satisfaction * 0.7."""
    w_mort, w_sat = TERRITORIAL_WEIGHTS
    n = F.coalesce(_c(n_deaths), F.lit(0))
    s = F.coalesce(_c(satisfaction), F.lit(0))
    score = (100 - F.least(_c(senior_pct), F.lit(100))) * w_mort + _c(satisfaction) * w_sat
    return F.when((n > 0) & (s > 0), score)


def flag(cond: Column) -> Column:
    """0/1 measure from a predicate."""
    return F.when(cond, 1).otherwise(0)
