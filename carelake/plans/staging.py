"""Staging models (M01-M16): rename, type, clean, classify, drop keyless rows.

Each model is a function ``(raw DataFrame, as_of) -> DataFrame``. ``as_of``
replaces the clock (``current_date`` / ``current_timestamp``) so runs are
reproducible; it is a date or datetime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions import rules
from carelake.functions.clean import (age_years, clean_text, clean_upper, departement,
                                      duration_minutes, iso_date, parse_date_any, safe_cast,
                                      seconds_of_day, to_int)


def _ts(as_of):
    return F.lit(as_of).cast("timestamp")


def _clock(c: str) -> F.Column:
    """Strict TIME cast kept as canonical 'HH:mm:ss' text."""
    secs = seconds_of_day(c)
    # not format_string: Java's formatter costs more than the rest of the row
    two = [F.lpad(x.cast("string"), 2, "0") for x in ((secs / 3600).cast("int"), (F.pmod(secs, F.lit(3600)) / 60).cast("int"),
                                                      F.pmod(secs, F.lit(60)))]
    return F.concat(two[0], F.lit(":"), two[1], F.lit(":"), two[2])


def stg_adher(raw: DataFrame, as_of) -> DataFrame:
    """Memberships; rows without patient or insurer dropped; status ACTIF."""
    return (raw.where(F.col("Id_patient").isNotNull() & F.col("Id_mut").isNotNull())
            .select(F.col("Id_patient").cast("int").alias("id_patient"),
                    F.col("Id_mut").cast("int").alias("id_mut"),
                    F.lit("ACTIF").alias("statut_adhesion"),
                    _ts(as_of).alias("loaded_at")))


def stg_consultation(raw: DataFrame, as_of) -> DataFrame:
    """Consultations with the duration in minutes (strict casts)."""
    return (raw.where(F.col("Num_consultation").isNotNull() & F.col("Id_patient").isNotNull()
                      & F.col("Id_prof_sante").isNotNull() & F.col("Date").isNotNull())
            .select(F.col("Num_consultation").cast("int").alias("num_consultation"),
                    F.col("Id_patient").cast("int").alias("id_patient"),
                    clean_text("Id_prof_sante").alias("id_professionnel"),
                    F.col("Id_mut").cast("int").alias("id_mut"),
                    F.col("Date").cast("date").alias("date_consultation"),
                    _clock("Heure_debut").alias("heure_debut"),
                    _clock("Heure_fin").alias("heure_fin"),
                    duration_minutes("Heure_debut", "Heure_fin").alias("duree_consultation_minutes"),
                    clean_text("Motif").alias("motif"),
                    clean_text("Code_diag").alias("code_diagnostic"),
                    _ts(as_of).alias("loaded_at")))


def stg_deces(raw: DataFrame, as_of) -> DataFrame:
    """Death register; partial dates -> NULL (T4); age at death (T5)."""
    dd, dn = iso_date("date_deces"), iso_date("date_naissance")
    return (raw.where(F.col("date_deces").isNotNull() & F.col("date_naissance").isNotNull())
            .select(clean_text("numero_acte_deces").alias("numero_acte_deces"),
                    dd.alias("date_deces"),
                    clean_text("code_lieu_deces").alias("code_lieu_deces"),
                    clean_text("code_lieu_naissance").alias("code_lieu_naissance"),
                    clean_text("lieu_naissance").alias("lieu_naissance"),
                    clean_text("pays_naissance").alias("pays_naissance"),
                    F.col("sexe").cast("int").alias("sexe_code"),
                    dn.alias("date_naissance"),
                    age_years(dd, dn).alias("age_deces"),
                    clean_upper("nom").alias("nom"),
                    clean_upper("prenom").alias("prenom"),
                    _ts(as_of).alias("loaded_at")))


def stg_diagnostic(raw: DataFrame, as_of) -> DataFrame:
    """ICD codes with their 3-character category."""
    code = clean_upper("Code_diag")
    return (raw.where(F.col("Code_diag").isNotNull())
            .select(code.alias("code_diagnostic"),
                    clean_text("Diagnostic").alias("libelle_diagnostic"),
                    F.substring(code, 1, 3).alias("categorie_cim10"),
                    F.lit("PostgreSQL").alias("source_donnee"),
                    _ts(as_of).alias("loaded_at")))


def stg_etablissement_activite(raw: DataFrame, as_of) -> DataFrame:
    """Activities; star projection with the identifier trimmed in place."""
    return (raw.where(F.col("identifiant").isNotNull())
            .withColumn("identifiant", clean_text("identifiant"))
            .withColumn("loaded_at", _ts(as_of)))


def stg_etablissement_professionnel(raw: DataFrame, as_of) -> DataFrame:
    """Professional-to-commune rows."""
    return (raw.where(F.col("identifiant").isNotNull())
            .select(clean_text("identifiant").alias("identifiant"),
                    F.upper("civilite").alias("civilite"),
                    clean_upper("nom").alias("nom"), clean_upper("prenom").alias("prenom"),
                    clean_text("categorie_professionnelle").alias("categorie_professionnelle"),
                    clean_text("profession").alias("profession"),
                    clean_text("specialite").alias("specialite"),
                    clean_text("type_identifiant").alias("type_identifiant"),
                    clean_text("commune").alias("commune"),
                    _ts(as_of).alias("loaded_at")))


_ETAB_TEXT = ["identifiant_organisation", "finess_etablissement_juridique", "finess_site",
              "raison_sociale_site", "enseigne_commerciale_site", "siren_site", "siret_site",
              "numero_voie", "indice_repetition_voie", "type_voie", "voie", "complement_destinataire",
              "complement_point_geographique", "mention_distribution", "adresse", "code_postal",
              "code_commune", "commune", "cedex", "pays"]


def stg_etablissement_sante(raw: DataFrame, as_of) -> DataFrame:
    """Establishments with the department (Corsica 2A/2B)."""
    cols = [clean_text(c).alias(c) for c in _ETAB_TEXT]
    cols.append(departement("code_postal").alias("departement"))
    cols += [clean_text(c).alias(c) for c in ("telephone", "telephone_2", "telecopie", "email")]
    cols.append(_ts(as_of).alias("loaded_at"))
    return raw.where(F.col("identifiant_organisation").isNotNull()).select(*cols)


def stg_hospitalisation(raw: DataFrame, as_of) -> DataFrame:
    """Stays; numbers as text are rounded, not truncated."""
    return (raw.where(F.col("Num_Hospitalisation").isNotNull() & F.col("Id_patient").isNotNull()
                      & F.col("Date_Entree").isNotNull())
            .select(to_int("Num_Hospitalisation", safe=False).alias("num_hospitalisation"),
                    to_int("Id_patient", safe=False).alias("id_patient"),
                    clean_text("identifiant_organisation").alias("identifiant_organisation"),
                    F.col("Date_Entree").cast("date").alias("date_entree"),
                    to_int("Jour_Hospitalisation", safe=False).alias("jour_hospitalisation"),
                    clean_text("Code_diagnostic").alias("code_diagnostic"),
                    clean_text("Suite_diagnostic_consultation").alias("suite_diagnostic_consultation"),
                    _ts(as_of).alias("loaded_at")))


def stg_laboratoire(raw: DataFrame, as_of) -> DataFrame:
    """Laboratories with a default country."""
    return (raw.where(F.col("Id_labo").isNotNull())
            .select(F.col("Id_labo").cast("int").alias("id_labo"),
                    clean_text("Laboratoire").alias("nom_laboratoire"),
                    F.coalesce(clean_text("Pays"), F.lit("NON RENSEIGNE")).alias("pays"),
                    _ts(as_of).alias("loaded_at")))


_MED = [("Code_CIS", "code_cis"), ("Denomination", "denomination"),
        ("Forme_pharmaceutique", "forme_pharmaceutique"), ("Voies_d_administration", "voies_administration"),
        ("Statut_administratif", "statut_administratif"), ("Type_de_procedure", "type_procedure"),
        ("Etat_de_commercialisation", "etat_commercialisation"), ("StatutBdm", "statut_bdm"),
        ("Date_AMM", "date_amm"), ("Num_autorisation_europeenne", "num_autorisation_europeenne"),
        ("Titulaire", "titulaire"), ("Surveillance_renforcee", "surveillance_renforcee")]


def stg_medicaments(raw: DataFrame, as_of) -> DataFrame:
    """Drug reference, every text trimmed (NBSP included, T10)."""
    return (raw.where(F.col("Code_CIS").isNotNull())
            .select(*[clean_text(s).alias(t) for s, t in _MED], _ts(as_of).alias("loaded_at")))


def stg_mutuelle(raw: DataFrame, as_of) -> DataFrame:
    """Insurers with their type."""
    return (raw.where(F.col("Id_Mut").isNotNull())
            .select(F.col("Id_Mut").cast("int").alias("id_mut"),
                    clean_text("Nom").alias("nom_mutuelle"),
                    F.col("Adresse").cast("string").alias("adresse"),
                    rules.insurer_type("Nom").alias("type_mutuelle"),
                    _ts(as_of).alias("loaded_at")))


def stg_patient(raw: DataFrame, as_of) -> DataFrame:
    """Patients; multi-format birth date, age as of ``as_of``, age band."""
    birth = parse_date_any("Date")
    age = F.coalesce(age_years(F.lit(as_of).cast("date"), birth), F.col("Age").cast("int"))
    return (raw.where(F.col("Id_patient").isNotNull())
            .withColumn("__birth", birth).withColumn("__age", age)
            .select(F.col("Id_patient").cast("int").alias("id_patient"),
                    clean_upper("Nom").alias("nom"), clean_upper("Prenom").alias("prenom"),
                    F.upper("Sexe").alias("sexe"),
                    F.col("__birth").alias("date_naissance"),
                    F.col("Age").cast("int").alias("age_source"),
                    F.col("__age").alias("age"),
                    rules.age_band("__age").alias("tranche_age"),
                    F.upper("Groupe_sanguin").alias("groupe_sanguin"),
                    safe_cast("Poid", "decimal(5,2)").alias("poids"),
                    to_int("Taille").alias("taille"),
                    clean_text("Code_postal").alias("code_postal"),
                    clean_upper("Ville").alias("ville"),
                    F.coalesce(F.col("Pays"), F.lit("FR")).alias("pays"),
                    clean_text("Adresse").alias("adresse"),
                    clean_text("EMail").alias("email"),
                    clean_text("Tel").alias("telephone"),
                    F.col("Num_Secu").alias("num_secu"),
                    _ts(as_of).alias("loaded_at")))


def stg_prescription(raw: DataFrame, as_of) -> DataFrame:
    """Consultation-to-drug rows."""
    return (raw.where(F.col("Num_consultation").isNotNull() & F.col("Code_CIS").isNotNull())
            .select(F.col("Num_consultation").cast("int").alias("num_consultation"),
                    clean_text("Code_CIS").alias("code_cis"),
                    _ts(as_of).alias("loaded_at")))


def stg_professionnel_sante(raw: DataFrame, as_of) -> DataFrame:
    """Health professionals."""
    return (raw.where(F.col("Identifiant").isNotNull())
            .select(clean_text("Identifiant").alias("identifiant"),
                    F.upper("Civilite").alias("civilite"),
                    clean_upper("Nom").alias("nom"), clean_upper("Prenom").alias("prenom"),
                    clean_text("Profession").alias("profession"),
                    clean_text("Categorie_professionnelle").alias("categorie_professionnelle"),
                    clean_text("Code_specialite").alias("code_specialite"),
                    clean_text("Type_identifiant").alias("type_identifiant"),
                    _ts(as_of).alias("loaded_at")))


def stg_salle(raw: DataFrame, as_of) -> DataFrame:
    """Rooms."""
    return (raw.where(F.col("Id_salle").isNotNull())
            .select(clean_text("Id_salle").alias("id_salle"),
                    F.col("Num_consultation").cast("bigint").alias("num_consultation"),
                    clean_text("Code_bloc").alias("code_bloc"),
                    clean_text("Num_etage").alias("num_etage"),
                    clean_text("Num_salle").alias("num_salle"),
                    _ts(as_of).alias("loaded_at")))


def stg_specialites(raw: DataFrame, as_of) -> DataFrame:
    """Specialties with the 34-branch category."""
    return (raw.where(F.col("Code_specialite").isNotNull())
            .select(clean_upper("Code_specialite").alias("code_specialite"),
                    clean_text("Fonction").alias("fonction"),
                    clean_text("Specialite").alias("specialite"),
                    rules.specialty_category("Fonction", "Specialite").alias("categorie"),
                    _ts(as_of).alias("loaded_at")))


# model name -> (raw table, function)
STAGING = {
    "stg_adher": ("adher", stg_adher),
    "stg_consultation": ("consultation", stg_consultation),
    "stg_deces": ("deces_en_france_deces", stg_deces),
    "stg_diagnostic": ("diagnostic", stg_diagnostic),
    "stg_etablissement_activite": ("etablissement_de_sante_activite_professionnel_sante",
                                   stg_etablissement_activite),
    "stg_etablissement_professionnel": ("etablissement_de_sante_professionnel_sante",
                                        stg_etablissement_professionnel),
    "stg_etablissement_sante": ("etablissement_de_sante_etablissement_sante", stg_etablissement_sante),
    "stg_hospitalisation": ("hospitalisation_hospitalisations", stg_hospitalisation),
    "stg_laboratoire": ("laboratoire", stg_laboratoire),
    "stg_medicaments": ("medicaments", stg_medicaments),
    "stg_mutuelle": ("mutuelle", stg_mutuelle),
    "stg_patient": ("patient", stg_patient),
    "stg_prescription": ("prescription", stg_prescription),
    "stg_professionnel_sante": ("professionnel_de_sante", stg_professionnel_sante),
    "stg_salle": ("salle", stg_salle),
    "stg_specialites": ("specialites", stg_specialites),
}
