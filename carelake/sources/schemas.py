"""Raw input schemas and the relational type map (S05, S06, §1.3).

Raw columns are strings unless the source is known to be typed: sources drift
between years (a score is numeric one year and comma-decimal text the next), so
the pipeline never infers types; staging casts explicitly.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()


def _schema(cols: list, typed: dict | None = None) -> T.StructType:
    typed = typed or {}
    return T.StructType([T.StructField(c, typed.get(c, S), True) for c in cols])


# The source tables' column names, as the sources deliver them.
SAT48_COLS = ["finess", "rs_finess", "region", "score_all_rea_ajust", "score_accueil_rea_ajust",
              "score_PECinf_rea_ajust", "score_PECmed_rea_ajust", "score_chambre_rea_ajust",
              "score_repas_rea_ajust", "score_sortie_rea_ajust", "nb_rep_score_all_rea_ajust",
              "classement", "evolution", "taux_reco_brut", "nb_reco_brut"]
SATCA_COLS = ["finess", "rs_finess", "region", "score_all_ajust", "score_ACC_ajust", "score_PEC_ajust",
              "score_AVH_ajust", "score_CER_ajust", "score_OVS_ajust", "nb_rep_score_all_ajust",
              "classement", "evolution", "taux_reco_brut", "nb_reco_brut"]

RAW_SCHEMAS: dict[str, T.StructType] = {
    # relational sources
    "patient": _schema(["Id_patient", "Nom", "Prenom", "Sexe", "Date", "Age", "Groupe_sanguin", "Poid",
                        "Taille", "Code_postal", "Ville", "Pays", "Adresse", "EMail", "Tel", "Num_Secu"],
                       {"Id_patient": I, "Age": I}),
    "adher": _schema(["Id_patient", "Id_mut"], {"Id_patient": I, "Id_mut": I}),
    "mutuelle": _schema(["Id_Mut", "Nom", "Adresse"], {"Id_Mut": I, "Adresse": I}),
    "consultation": _schema(["Num_consultation", "Id_patient", "Id_prof_sante", "Id_mut", "Date",
                             "Heure_debut", "Heure_fin", "Motif", "Code_diag"],
                            {"Num_consultation": I, "Id_patient": I, "Id_mut": I}),
    "prescription": _schema(["Num_consultation", "Code_CIS"], {"Num_consultation": I}),
    "medicaments": _schema(["Code_CIS", "Denomination", "Forme_pharmaceutique", "Voies_d_administration",
                            "Statut_administratif", "Type_de_procedure", "Etat_de_commercialisation",
                            "StatutBdm", "Date_AMM", "Num_autorisation_europeenne", "Titulaire",
                            "Surveillance_renforcee"]),
    "diagnostic": _schema(["Code_diag", "Diagnostic"]),
    "professionnel_de_sante": _schema(["Identifiant", "Civilite", "Nom", "Prenom", "Profession",
                                       "Categorie_professionnelle", "Code_specialite",
                                       "Type_identifiant"]),
    "specialites": _schema(["Code_specialite", "Fonction", "Specialite"]),
    "salle": _schema(["Id_salle", "Num_consultation", "Code_bloc", "Num_etage", "Num_salle"],
                     {"Num_consultation": L}),
    "laboratoire": _schema(["Id_labo", "Laboratoire", "Pays"], {"Id_labo": I}),
    # CSV sources
    "deces_en_france_deces": _schema(["numero_acte_deces", "date_deces", "code_lieu_deces",
                                      "code_lieu_naissance", "lieu_naissance", "pays_naissance", "sexe",
                                      "date_naissance", "nom", "prenom"]),
    "hospitalisation_hospitalisations": _schema(["Num_Hospitalisation", "Id_patient",
                                                 "identifiant_organisation", "Date_Entree",
                                                 "Jour_Hospitalisation", "Code_diagnostic",
                                                 "Suite_diagnostic_consultation"]),
    "etablissement_de_sante_etablissement_sante": _schema(
        ["identifiant_organisation", "finess_etablissement_juridique", "finess_site",
         "raison_sociale_site", "enseigne_commerciale_site", "siren_site", "siret_site", "numero_voie",
         "indice_repetition_voie", "type_voie", "voie", "complement_destinataire",
         "complement_point_geographique", "mention_distribution", "adresse", "code_postal",
         "code_commune", "commune", "cedex", "pays", "telephone", "telephone_2", "telecopie", "email"],
        {"finess_site": L}),
    "etablissement_de_sante_professionnel_sante": _schema(
        ["identifiant", "civilite", "nom", "prenom", "categorie_professionnelle", "profession",
         "specialite", "type_identifiant", "commune"]),
    "etablissement_de_sante_activite_professionnel_sante": _schema(
        ["identifiant", "identifiant_organisation", "mode_exercice"]),
    "satisfaction_2020_resultats_esatis48h_mco_open_data_2020": _schema(SAT48_COLS),
    "satisfaction_2019_resultats_esatis48h_mco_open_data_2019": _schema(SAT48_COLS),
    "satisfaction_esatis48h_mco_recueil2017_donnees": _schema(SAT48_COLS[:-2]),
    "satisfaction_2020_resultats_esatisca_mco_open_data_2020": _schema(SATCA_COLS),
    "satisfaction_2019_resultats_esatisca_mco_open_data_2019": _schema(SATCA_COLS),
    "satisfaction_2017_2018_ete_ortho_ipaqss_2017_2018_donnees": _schema(
        ["finess", "rs", "region", "ete_ortho_etbt", "ete_ortho_pos_seuil_etbt", "ete_ortho_cible_etbt",
         "ete_ortho_obs_etbt", "ete_ortho_att_etbt"]),
}

# Source type names -> engine types, default text.
JDBC_TYPE_MAP: dict[str, T.DataType] = {
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "numeric": T.DecimalType(38, 10),
    "real": T.FloatType(),
    "double precision": T.DoubleType(),
    "character varying": T.StringType(),
    "character": T.StringType(),
    "text": T.StringType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "timestamp with time zone": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "json": T.StringType(),
    "jsonb": T.StringType(),
    "uuid": T.StringType(),
}


def mapped_type(source_type: str) -> T.DataType:
    """Engine type of a source column type name (text when unknown)."""
    return JDBC_TYPE_MAP.get(source_type.lower(), T.StringType())


def schema_from_types(columns: list[tuple[str, str]]) -> T.StructType:
    """Typed empty-table schema from (column, source type) pairs."""
    return T.StructType([T.StructField(n, mapped_type(t), True) for n, t in columns])
