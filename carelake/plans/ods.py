"""Operational data store models (M17-M27): unify, enrich, consolidate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions import rules
from carelake.functions.clean import alert_flag, clean_text, decode_sex, departement, parse_decimal_comma
from carelake.operators.align import align, union_all
from carelake.operators.measures import join_distinct


def _ts(as_of):
    return F.lit(as_of).cast("timestamp")


# --- M17 / M18: yearly survey extracts --------------------------------------------------------

def _survey_common(raw: DataFrame, kind: str, year: int) -> dict:
    return {
        "finess": clean_text("finess"),
        "nom_etablissement": clean_text("rs_finess"),
        "region": clean_text("region"),
        "type_enquete": F.lit(kind),
        "annee_enquete": F.lit(year),
    }


def _survey_tail(raw: DataFrame, n_col: str, has_reco: bool) -> dict:
    return {
        # text-typed counts in the raw extracts are cast here
        "nombre_reponses": F.col(n_col).cast("bigint"),
        "classement": clean_text("classement"),
        "evolution": clean_text("evolution"),
        "taux_recommandation": parse_decimal_comma("taux_reco_brut") if has_reco else F.lit(None).cast("double"),
        "nb_recommandations": F.col("nb_reco_brut").cast("bigint") if has_reco else F.lit(None).cast("bigint"),
    }


def int_satisfaction_esatis48h(raw_2020: DataFrame, raw_2019: DataFrame, raw_2017: DataFrame) -> DataFrame:
    """Three yearly 48h-survey extracts aligned and unioned."""
    def one(raw, year, has_reco):
        m = _survey_common(raw, "E-SATIS 48h MCO", year)
        m.update({
            "score_global": parse_decimal_comma("score_all_rea_ajust"),
            "score_accueil": parse_decimal_comma("score_accueil_rea_ajust"),
            "score_pec_infirmiers": parse_decimal_comma("score_PECinf_rea_ajust"),
            "score_pec_medecins": parse_decimal_comma("score_PECmed_rea_ajust"),
            "score_chambre": parse_decimal_comma("score_chambre_rea_ajust"),
            "score_repas": parse_decimal_comma("score_repas_rea_ajust"),
            "score_sortie": parse_decimal_comma("score_sortie_rea_ajust"),
        })
        m.update(_survey_tail(raw, "nb_rep_score_all_rea_ajust", has_reco))
        return align(raw.where(F.col("finess").isNotNull()), m)
    return union_all([one(raw_2020, 2020, True), one(raw_2019, 2019, True), one(raw_2017, 2017, False)])


def int_satisfaction_esatisca(raw_2020: DataFrame, raw_2019: DataFrame) -> DataFrame:
    """Two yearly outpatient-survey extracts aligned and unioned."""
    def one(raw, year):
        m = _survey_common(raw, "E-SATIS CA MCO", year)
        m.update({
            "score_global": parse_decimal_comma("score_all_ajust"),
            "score_accueil": parse_decimal_comma("score_ACC_ajust"),
            "score_pec": parse_decimal_comma("score_PEC_ajust"),
            "score_avant_hospitalisation": parse_decimal_comma("score_AVH_ajust"),
            "score_ceremony": parse_decimal_comma("score_CER_ajust"),
            "score_organisation_sortie": parse_decimal_comma("score_OVS_ajust"),
        })
        m.update(_survey_tail(raw, "nb_rep_score_all_ajust", True))
        return align(raw.where(F.col("finess").isNotNull()), m)
    return union_all([one(raw_2020, 2020), one(raw_2019, 2019)])


UNIFIED_SURVEY = ["finess", "nom_etablissement", "region", "type_enquete", "annee_enquete",
                  "score_global", "score_accueil", "score_pec_1", "score_pec_2", "score_chambre",
                  "score_repas", "score_sortie", "score_extra_1", "score_extra_2", "nombre_reponses",
                  "classement", "evolution", "taux_recommandation", "nb_recommandations"]


def ods_satisfaction_unifie(esatis48h: DataFrame, esatisca: DataFrame, as_of) -> DataFrame:
    """Both surveys in one shape, NULL-padded where a survey lacks a score."""
    same = {c: c for c in UNIFIED_SURVEY}
    m48 = dict(same, score_pec_1="score_pec_infirmiers", score_pec_2="score_pec_medecins",
               score_extra_1=None, score_extra_2=None)
    mca = dict(same, score_pec_1="score_pec", score_pec_2=None, score_chambre=None, score_repas=None,
               score_sortie="score_organisation_sortie", score_extra_1="score_avant_hospitalisation",
               score_extra_2="score_ceremony")
    types = {c: "double" for c in ("score_pec_2", "score_chambre", "score_repas", "score_extra_1",
                                   "score_extra_2")}
    return (union_all([align(esatis48h, m48, types), align(esatisca, mca, types)])
            .withColumn("loaded_at", _ts(as_of)))


def ods_qualite_soins_unifie(raw: DataFrame, as_of) -> DataFrame:
    """Quality indicator with its threshold alert."""
    return (raw.where(F.col("finess").isNotNull())
            .select(clean_text("finess").alias("finess"),
                    clean_text("rs").alias("nom_etablissement"),
                    clean_text("region").alias("region"),
                    F.lit("ETE ORTHO").alias("type_indicateur"),
                    F.lit(2018).alias("annee_enquete"),
                    F.lit(2017).alias("annee_donnee"),
                    parse_decimal_comma("ete_ortho_etbt").alias("ratio_ete_ortho"),
                    alert_flag("ete_ortho_pos_seuil_etbt", "Supérieur au seuil").alias("alerte_ete"),
                    F.col("ete_ortho_cible_etbt").alias("cible"),
                    F.col("ete_ortho_obs_etbt").alias("observations"),
                    parse_decimal_comma("ete_ortho_att_etbt").alias("attendu"),
                    clean_text("ete_ortho_pos_seuil_etbt").alias("position_seuil"),
                    _ts(as_of).alias("loaded_at")))


def ods_patient_complet(patients: DataFrame, adhesions: DataFrame, mutuelles: DataFrame,
                        strict: bool = False) -> DataFrame:
    """Patient x membership x insurer.

    Parity: a patient with several memberships appears once per membership (T17a);
    ``strict`` keeps one membership per patient (smallest insurer id).
    """
    a = adhesions.select("id_patient", F.col("id_mut").alias("__a_mut"), "statut_adhesion")
    if strict:
        a = a.groupBy("id_patient").agg(F.min(F.struct("__a_mut", "statut_adhesion")).alias("__s")) \
             .select("id_patient", "__s.*")
    m = mutuelles.select(F.col("id_mut").alias("__m_mut"), "nom_mutuelle", "type_mutuelle")
    j = (patients.join(a, "id_patient", "left")
         .join(m, F.col("__a_mut") == F.col("__m_mut"), "left"))
    return j.select(*[F.col(c) for c in patients.columns],
                    F.col("__m_mut").alias("id_mut"), "nom_mutuelle", "type_mutuelle", "statut_adhesion",
                    rules.has_active_cover(F.col("__m_mut"), F.col("statut_adhesion")).alias("a_mutuelle_active"))


def ods_professionnel_complet(pros: DataFrame, etab_pros: DataFrame, specialites: DataFrame) -> DataFrame:
    """Professional + exercise communes + specialty + practice mode.

    The reference groups the professional-commune join by every professional
    column (J14); pre-aggregating the commune side per identifier and joining
    it to the distinct professionals gives the same rows without the fan-out.
    """
    ep = (etab_pros.groupBy("identifiant")
          .agg(F.max("commune").alias("commune_exercice"),
               F.max("specialite").alias("specialite_exercice_etab"),
               F.count_distinct("commune").alias("nb_etablissements")))
    p = pros.distinct().join(ep, "identifiant", "left") \
            .withColumn("nb_etablissements", F.coalesce(F.col("nb_etablissements"), F.lit(0)))
    s = specialites.select(F.col("code_specialite").alias("__code"),
                           F.col("fonction").alias("specialite_fonction"),
                           F.col("specialite").alias("specialite_libelle"),
                           F.col("categorie").alias("specialite_categorie"))
    return (p.join(s, p.code_specialite == s.__code, "left").drop("__code")
            .withColumn("mode_exercice", rules.practice_mode("categorie_professionnelle")))


def ods_consultation_enrichie(consultations: DataFrame, patients: DataFrame, professionnels: DataFrame,
                              diagnostics: DataFrame) -> DataFrame:
    """Consultation + patient (required) + professional + diagnosis (optional)."""
    c = consultations.alias("c")
    p = patients.alias("p")
    pr = professionnels.alias("pr")
    d = diagnostics.alias("d")
    j = (c.join(p, F.col("c.id_patient") == F.col("p.id_patient"), "inner")
         .join(pr, F.col("c.id_professionnel") == F.col("pr.identifiant"), "left")
         .join(d, F.col("c.code_diagnostic") == F.col("d.code_diagnostic"), "left"))
    return j.select(
        "c.num_consultation", "c.date_consultation", "c.heure_debut", "c.heure_fin",
        "c.duree_consultation_minutes", "c.motif", "c.id_patient", "c.id_professionnel",
        "c.code_diagnostic", "c.id_mut",
        F.col("p.nom").alias("patient_nom"), F.col("p.prenom").alias("patient_prenom"),
        F.col("p.sexe").alias("patient_sexe"), F.col("p.age").alias("patient_age"),
        F.col("p.tranche_age").alias("patient_tranche_age"), F.col("p.ville").alias("patient_ville"),
        F.col("p.code_postal").alias("patient_code_postal"),
        F.col("p.nom_mutuelle").alias("patient_mutuelle"),
        F.col("p.type_mutuelle").alias("patient_type_mutuelle"),
        F.col("p.a_mutuelle_active").alias("patient_a_mutuelle"),
        F.col("pr.nom").alias("professionnel_nom"), F.col("pr.prenom").alias("professionnel_prenom"),
        F.col("pr.profession").alias("professionnel_profession"),
        F.col("pr.code_specialite").alias("professionnel_code_specialite"),
        F.col("pr.mode_exercice").alias("professionnel_mode_exercice"),
        "d.libelle_diagnostic", "d.categorie_cim10",
        rules.patient_category(F.col("p.age")).alias("categorie_patient"),
        rules.consultation_length(F.col("c.duree_consultation_minutes")).alias("duree_categorie"),
        F.col("c.loaded_at").alias("loaded_at"))


def ods_hospitalisation_enrichie(stays: DataFrame, patients: DataFrame, etablissements: DataFrame,
                                 diagnostics: DataFrame) -> DataFrame:
    """Stay + patient (required) + establishment + diagnosis (optional)."""
    h, p, e, d = stays.alias("h"), patients.alias("p"), etablissements.alias("e"), diagnostics.alias("d")
    j = (h.join(p, F.col("h.id_patient") == F.col("p.id_patient"), "inner")
         .join(e, F.col("h.identifiant_organisation") == F.col("e.identifiant_organisation"), "left")
         .join(d, F.col("h.code_diagnostic") == F.col("d.code_diagnostic"), "left"))
    return j.select(
        "h.num_hospitalisation", "h.date_entree", "h.jour_hospitalisation", "h.id_patient",
        "h.identifiant_organisation", "h.code_diagnostic",
        F.col("p.nom").alias("patient_nom"), F.col("p.prenom").alias("patient_prenom"),
        F.col("p.sexe").alias("patient_sexe"), F.col("p.age").alias("patient_age"),
        F.col("p.tranche_age").alias("patient_tranche_age"),
        F.col("e.identifiant_organisation").alias("etablissement_identifiant"),
        F.col("e.raison_sociale_site").alias("etablissement_nom"),
        F.col("e.commune").alias("etablissement_commune"),
        F.col("e.departement").alias("etablissement_departement"),
        "d.libelle_diagnostic", "d.categorie_cim10", "h.suite_diagnostic_consultation",
        rules.stay_type(F.col("h.jour_hospitalisation")).alias("type_sejour"),
        rules.patient_category(F.col("p.age")).alias("categorie_patient"),
        F.col("h.loaded_at").alias("loaded_at"))


def ods_deces_enrichi(deaths: DataFrame) -> DataFrame:
    """Deaths with age band and decoded sex; unparsable dates dropped."""
    return (deaths.where(F.col("date_deces").isNotNull())
            .select("numero_acte_deces", "date_deces", "date_naissance", "age_deces",
                    rules.death_age_band("age_deces").alias("tranche_age_deces"),
                    decode_sex("sexe_code").alias("sexe"),
                    "code_lieu_deces", "code_lieu_naissance", "lieu_naissance", "pays_naissance",
                    "nom", "prenom", "loaded_at"))


def ods_prescription_enrichie(prescriptions: DataFrame, medicaments: DataFrame,
                              consultations: DataFrame) -> DataFrame:
    """Prescription + drug + consultation (both optional)."""
    p, m, c = prescriptions.alias("p"), medicaments.alias("m"), consultations.alias("c")
    j = (p.join(m, F.col("p.code_cis") == F.col("m.code_cis"), "left")
         .join(c, F.col("p.num_consultation") == F.col("c.num_consultation"), "left"))
    return j.select(
        "p.num_consultation", "p.code_cis",
        F.col("m.denomination").alias("medicament_nom"), "m.forme_pharmaceutique",
        "m.voies_administration", "m.statut_administratif", "m.etat_commercialisation",
        F.col("m.titulaire").alias("laboratoire"),
        "c.date_consultation", "c.id_patient", "c.patient_nom", "c.patient_prenom",
        "c.id_professionnel", "c.professionnel_nom", "c.code_diagnostic",
        F.col("p.loaded_at").alias("loaded_at"))


def ods_localisation_consolidee(patients: DataFrame, etablissements: DataFrame, deaths: DataFrame,
                                as_of) -> DataFrame:
    """One row per place code from three sources."""
    nul_s = F.lit(None).cast("string")
    lat, lon = F.lit(None).cast("decimal(10,8)"), F.lit(None).cast("decimal(11,8)")
    pat = patients.where(F.col("code_postal").isNotNull()).select(
        F.col("code_postal").alias("code_lieu"), F.col("ville").alias("nom_lieu"), "code_postal", "ville",
        departement("code_postal", trim=False).alias("departement"), "pays",
        F.lit("Patient").alias("type_lieu"), lat.alias("latitude"), lon.alias("longitude")).distinct()
    eta = etablissements.where(F.col("code_postal").isNotNull()).select(
        F.col("code_postal").alias("code_lieu"), F.col("commune").alias("nom_lieu"), "code_postal",
        F.col("commune").alias("ville"), "departement", "pays",
        F.lit("Etablissement").alias("type_lieu"), lat.alias("latitude"), lon.alias("longitude")).distinct()
    dec = deaths.where(F.col("code_lieu_deces").isNotNull()).select(
        F.col("code_lieu_deces").alias("code_lieu"), F.col("code_lieu_deces").alias("nom_lieu"),
        nul_s.alias("code_postal"), nul_s.alias("ville"), nul_s.alias("departement"),
        F.lit("FR").alias("pays"), F.lit("Deces").alias("type_lieu"),
        lat.alias("latitude"), lon.alias("longitude")).distinct()
    allp = union_all([pat, eta, dec])
    return (allp.groupBy("code_lieu")
            .agg(F.max("nom_lieu").alias("nom_lieu"), F.max("code_postal").alias("code_postal"),
                 F.max("ville").alias("ville"), F.max("departement").alias("departement"),
                 F.max("pays").alias("pays"), join_distinct("type_lieu").alias("types_lieu"),
                 F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"),
                 F.count(F.lit(1)).alias("nb_occurrences"))
            .withColumn("loaded_at", _ts(as_of)))
