"""Warehouse models (M28-M40): 8 dimensions, 5 facts.

Surrogate keys come from D01 (no single-partition sort); dimension lookups are
plain equi-joins that AQE turns into broadcasts when the dimension proves small
at run time. The calendar is bounded by its date range and is broadcast
explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions import calendar as cal
from carelake.functions import rules
from carelake.functions.clean import iso2_country, left_n
from carelake.operators.history import scd2_init
from carelake.operators.keys import hash_id, pseudonymize, with_surrogate_key
from carelake.operators.match import containment_lookup


def _ts(as_of):
    return F.lit(as_of).cast("timestamp")


def dim_temps(spark, as_of, start=cal.DEFAULT_START, end=cal.DEFAULT_END,
              holiday_until: int = cal.DEFAULT_HOLIDAY_UNTIL) -> DataFrame:
    """Calendar dimension (no unknown member)."""
    return cal.calendar(spark, start, end, cal.DEFAULT_HOLIDAY_FROM, holiday_until, as_of=as_of)


_PATIENT_ATTRS = ["id_patient", "nom", "prenom", "sexe", "date_naissance", "age", "tranche_age",
                  "groupe_sanguin", "poids", "taille", "code_postal", "ville", "pays", "num_secu",
                  "loaded_at"]


def dim_patient(patients: DataFrame) -> DataFrame:
    """One row per distinct patient tuple (A01), pseudonymised (D02/D03), keyed."""
    dedup = (patients.groupBy(*_PATIENT_ATTRS)
             .agg(F.max(F.when(F.col("a_mutuelle_active"), 1).otherwise(0)).alias("a_mutuelle_active")))
    keyed = with_surrogate_key(dedup, "sk_patient", ["id_patient"])
    return keyed.select(
        "sk_patient", "id_patient",
        pseudonymize("nom").alias("nom_anonyme"), pseudonymize("prenom").alias("prenom_anonyme"),
        "sexe", "date_naissance", "age", "tranche_age", "groupe_sanguin", "poids", "taille",
        "code_postal", "ville", "pays",
        hash_id("num_secu").alias("num_secu_hash"),
        F.col("loaded_at").alias("date_chargement"), F.col("loaded_at").alias("date_modification"))


def dim_specialite(specialites: DataFrame) -> DataFrame:
    """Specialties, code cut to 10 characters."""
    keyed = with_surrogate_key(specialites, "sk_specialite", ["code_specialite"])
    return keyed.select("sk_specialite", left_n("code_specialite", 10).alias("code_specialite"),
                        "fonction", "specialite", "categorie",
                        F.col("loaded_at").alias("date_chargement"))


def dim_etablissement(etabs: DataFrame) -> DataFrame:
    """Establishments with type, sector and region."""
    keyed = with_surrogate_key(etabs, "sk_etablissement", ["identifiant_organisation"])
    name = F.col("raison_sociale_site")
    return keyed.select(
        "sk_etablissement",
        F.col("identifiant_organisation").cast("string").alias("finess"),
        F.col("finess_etablissement_juridique").cast("string").alias("finess_etablissement_juridique"),
        F.col("finess_site").cast("string").alias("finess_site"),
        name.alias("nom_etablissement"),
        rules.facility_type(name).alias("type_etablissement"),
        rules.facility_sector(name).alias("categorie"),
        rules.region_of("departement").alias("region"),
        "departement", "adresse", "code_postal", F.col("commune").alias("ville"),
        F.col("loaded_at").alias("date_chargement"))


def dim_diagnostic(diagnostics: DataFrame) -> DataFrame:
    """Diagnoses with the ICD-10 chapter."""
    keyed = with_surrogate_key(diagnostics, "sk_diagnostic", ["code_diagnostic"])
    return keyed.select("sk_diagnostic", "code_diagnostic", "libelle_diagnostic", "categorie_cim10",
                        rules.icd10_chapter("categorie_cim10").alias("chapitre_cim10"),
                        "source_donnee", F.col("loaded_at").alias("date_chargement"))


def dim_localisation(places: DataFrame) -> DataFrame:
    """Places with region (C11) and ISO-2 country."""
    keyed = with_surrogate_key(places, "sk_localisation", ["code_lieu", "types_lieu"])
    return keyed.select("sk_localisation", "code_lieu", "nom_lieu", "code_postal", "ville", "departement",
                        rules.region_of("departement").alias("region"),
                        iso2_country("pays").alias("pays"),
                        F.col("types_lieu").alias("type_lieu"), "latitude", "longitude",
                        F.col("loaded_at").alias("date_chargement"))


def dim_mutuelle(mutuelles: DataFrame) -> DataFrame:
    """Insurers."""
    keyed = with_surrogate_key(mutuelles, "sk_mutuelle", ["id_mut"])
    return keyed.select("sk_mutuelle", "id_mut", "nom_mutuelle", "adresse", "type_mutuelle",
                        F.col("loaded_at").alias("date_chargement"))


def dim_professionnel(pros: DataFrame, dim_spec: DataFrame, dim_etab: DataFrame,
                      activites: DataFrame, as_of) -> DataFrame:
    """Professional x activity (J05, fan-out T17b) with SCD-2 columns."""
    s = dim_spec.select(F.col("code_specialite").alias("__spec"), F.col("sk_specialite").alias("fk_specialite"))
    a = activites.select(F.col("identifiant").alias("__a_id"), F.col("identifiant_organisation").alias("__org"))
    e = dim_etab.select(F.col("finess").alias("__finess"), F.col("sk_etablissement").alias("fk_organisation"))
    j = (pros.join(s, pros.code_specialite == s.__spec, "left")
         .join(a, pros.identifiant == a.__a_id, "left")
         .join(e, F.col("__org") == F.col("__finess"), "left"))
    base = j.select(
        "identifiant", "civilite",
        pseudonymize("nom").alias("nom_anonyme"), pseudonymize("prenom").alias("prenom_anonyme"),
        "profession", "categorie_professionnelle", "fk_specialite", "mode_exercice", "fk_organisation",
        F.col("loaded_at").alias("date_chargement"))
    keyed = with_surrogate_key(base, "sk_professionnel", ["identifiant"])
    keyed = scd2_init(keyed, as_of)
    return keyed.select("sk_professionnel", "identifiant", "civilite", "nom_anonyme", "prenom_anonyme",
                        "profession", "categorie_professionnelle", "fk_specialite", "mode_exercice",
                        "fk_organisation", "date_debut_validite", "date_fin_validite", "est_actuel",
                        "date_chargement")


def fait_consultation(cons: DataFrame, d_patient: DataFrame, d_pro: DataFrame, d_diag: DataFrame,
                      d_mut: DataFrame, d_temps: DataFrame) -> DataFrame:
    """Consultations with 4 required and 2 optional keys."""
    p = d_patient.select(F.col("id_patient").alias("__pid"), "sk_patient")
    pr = d_pro.where(F.col("est_actuel")).select(F.col("identifiant").alias("__prid"), "sk_professionnel",
                                                  "fk_organisation")
    d = d_diag.select(F.col("code_diagnostic").alias("__diag"), "sk_diagnostic")
    t = F.broadcast(d_temps.select(F.col("date_complete").alias("__date"), "sk_temps"))
    m = d_mut.select(F.col("id_mut").alias("__mut"), "sk_mutuelle")
    # the diagnosis first: M23 leaves its rows dealt and sorted by that code, so a diagnosis dimension too large to
    # broadcast meets them where they are
    j = (cons.join(d, cons.code_diagnostic == d.__diag, "inner")
         .join(pr, cons.id_professionnel == pr.__prid, "inner")
         .join(p, cons.id_patient == p.__pid, "inner")
         .join(t, cons.date_consultation == t.__date, "inner")
         .join(m, cons.id_mut == m.__mut, "left"))
    base = j.select(
        "sk_patient", "sk_professionnel", "sk_diagnostic",
        F.coalesce("sk_mutuelle", F.lit(-1)).cast("bigint").alias("sk_mutuelle"),
        F.coalesce("fk_organisation", F.lit(-1)).cast("bigint").alias("sk_etablissement"),
        "sk_temps", "num_consultation", "heure_debut", "heure_fin", "motif",
        F.col("duree_consultation_minutes").alias("duree_consultation"),
        F.lit(1).alias("nombre_consultations"), F.col("loaded_at").alias("date_chargement"))
    keyed = with_surrogate_key(base, "sk_fait_consultation", ["num_consultation"])
    return keyed.select("sk_fait_consultation", *base.columns)


def fait_hospitalisation(stays: DataFrame, d_patient: DataFrame, d_etab: DataFrame, d_diag: DataFrame,
                         d_temps: DataFrame, d_loc: DataFrame) -> DataFrame:
    """Stays; establishment place found through a filtered place lookup."""
    p = d_patient.select(F.col("id_patient").alias("__pid"), "sk_patient")
    t = F.broadcast(d_temps.select(F.col("date_complete").alias("__date"), "sk_temps"))
    e = d_etab.select(F.col("finess").alias("__finess"), "sk_etablissement",
                      F.col("code_postal").alias("__cp"))
    d = d_diag.select(F.col("code_diagnostic").alias("__diag"), "sk_diagnostic")
    loc = d_loc.where(F.col("type_lieu").contains("Etablissement")) \
               .select(F.col("code_lieu").alias("__lieu"), "sk_localisation")
    j = (stays.join(p, stays.id_patient == p.__pid, "inner")
         .join(t, stays.date_entree == t.__date, "inner")
         .join(e, stays.identifiant_organisation == e.__finess, "left")
         .join(d, stays.code_diagnostic == d.__diag, "left")
         .join(loc, F.col("__cp") == loc.__lieu, "left"))
    base = j.select(
        "sk_patient",
        F.coalesce("sk_etablissement", F.lit(-1)).cast("bigint").alias("sk_etablissement"),
        F.coalesce("sk_diagnostic", F.lit(-1)).cast("bigint").alias("sk_diagnostic"),
        "sk_temps",
        F.coalesce("sk_localisation", F.lit(-1)).cast("bigint").alias("sk_localisation"),
        "num_hospitalisation", "jour_hospitalisation",
        F.lit(1).alias("nombre_hospitalisations"), F.col("loaded_at").alias("date_chargement"))
    keyed = with_surrogate_key(base, "sk_fait_hospitalisation", ["num_hospitalisation"])
    return keyed.select("sk_fait_hospitalisation", *base.columns)


def fait_deces(deaths: DataFrame, d_patient: DataFrame, d_loc: DataFrame, d_temps: DataFrame) -> DataFrame:
    """Deaths; calendar required (T18), place via filtered lookup (J06),
    person via pseudonym + birth match (J07, homonym fan-out T17d)."""
    d = deaths.select("*", pseudonymize("nom").alias("__nom"), pseudonymize("prenom").alias("__prenom"),
                      F.col("date_naissance").cast("timestamp").alias("__birth"))
    t = F.broadcast(d_temps.select(F.col("date_complete").alias("__date"), "sk_temps"))
    loc = d_loc.where(F.col("type_lieu").contains("Deces")) \
               .select(F.col("code_lieu").alias("__lieu"), "sk_localisation")
    p = d_patient.select(F.col("nom_anonyme").alias("__pn"), F.col("prenom_anonyme").alias("__pp"),
                         F.col("date_naissance").alias("__pb"), "sk_patient")
    j = (d.join(t, d.date_deces == t.__date, "inner")
         .join(loc, d.code_lieu_deces == loc.__lieu, "left")
         .join(p, (d.__nom == p.__pn) & (d.__prenom == p.__pp) & (d.__birth == p.__pb), "left"))
    base = j.select(
        F.coalesce("sk_patient", F.lit(-1)).cast("bigint").alias("sk_patient"),
        F.coalesce("sk_localisation", F.lit(-1)).cast("bigint").alias("sk_localisation"),
        "sk_temps", "code_lieu_deces", "numero_acte_deces", "age_deces",
        F.lit(1).alias("nombre_deces"), F.col("loaded_at").alias("date_chargement"))
    keyed = with_surrogate_key(base, "sk_fait_deces", ["numero_acte_deces"])
    return keyed.select("sk_fait_deces", *base.columns)


_FINESS_COLS = ["finess_site", "finess", "finess_etablissement_juridique"]


def _with_establishment(src: DataFrame, d_etab: DataFrame) -> DataFrame:
    """Containment cascade finess_site -> finess -> juridical finess, else -1."""
    found = containment_lookup(src, "finess", d_etab, _FINESS_COLS, "sk_etablissement") \
        .withColumnRenamed("finess", "__needle")
    return (src.join(found, src.finess == found.__needle, "left")
            .withColumn("sk_etablissement", F.coalesce("sk_etablissement", F.lit(-1)).cast("bigint"))
            .drop("__needle"))


def fait_satisfaction(surveys: DataFrame, d_etab: DataFrame) -> DataFrame:
    """Survey facts keyed by (finess, year); establishment by containment."""
    s = _with_establishment(surveys, d_etab)
    base = s.select("finess", "sk_etablissement", "region", "annee_enquete", "score_global", "score_accueil",
                    F.col("score_pec_1").alias("score_pec_infirmiers"),
                    F.col("score_pec_2").alias("score_pec_medecins"),
                    "score_chambre", "score_repas", "score_sortie", "taux_recommandation",
                    "nombre_reponses", "classement", "evolution",
                    F.col("loaded_at").alias("date_chargement"))
    keyed = with_surrogate_key(base, "sk_fait_satisfaction", ["finess", "annee_enquete"])
    return keyed.select("sk_fait_satisfaction", *[c for c in base.columns if c != "finess"])


def fait_qualite_soins(quality: DataFrame, d_etab: DataFrame) -> DataFrame:
    """Quality facts keyed by (finess, year); establishment by containment."""
    q = _with_establishment(quality, d_etab)
    base = q.select("finess", "sk_etablissement", "region", "annee_enquete", "annee_donnee",
                    "ratio_ete_ortho", "alerte_ete", "cible", "observations", "attendu", "position_seuil",
                    F.col("loaded_at").alias("date_chargement"))
    keyed = with_surrogate_key(base, "sk_fait_qualite", ["finess", "annee_enquete"])
    return keyed.select("sk_fait_qualite", *[c for c in base.columns if c != "finess"])
