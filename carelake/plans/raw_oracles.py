"""DuckDB SQL of M01-M40 over the raw projections (``raw_tables.py``). Labels come from the hand-written tables there and from
plain CASE chains here, not from the rule tables of the code under test."""

from __future__ import annotations

from carelake.plans.raw_tables import CALENDAR, CHAPTERS, FACILITIES, RAW_SQL, SPECIALTIES, TABLES, models, pick, q


def _lookup(x: str, pairs: list[tuple[str, str]], default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in pairs) + f" ELSE {q(default)} END"


_DEPARTMENTS = {
    "Ile-de-France": "75 77 78 91 92 93 94 95", "Provence-Alpes-Cote d'Azur": "04 05 06 13 83 84",
    "Auvergne-Rhone-Alpes": "01 03 07 15 26 38 42 43 63 69 73 74", "Nouvelle-Aquitaine": "16 17 19 23 24 33 40 47 64 79 86 87",
    "Occitanie": "09 11 12 30 31 32 34 46 48 65 66 81 82", "Hauts-de-France": "02 59 60 62 80", "Normandie": "14 27 50 61 76",
    "Grand Est": "08 10 51 52 54 55 57 67 68 88", "Bourgogne-Franche-Comte": "21 25 39 58 70 71 89 90", "Pays de la Loire": "44 49 53 72 85",
    "Bretagne": "22 29 35 56", "Centre-Val de Loire": "18 28 36 37 41 45", "Corse": "2A 2B 20", "Outre-mer": "971 97 972 973 974 976"}


def _region(dept: str) -> str:
    return (f"CASE " + " ".join(f"WHEN {dept} IN ({', '.join(q(d) for d in ds.split())}) THEN {q(r)}" for r, ds in _DEPARTMENTS.items())
            + " ELSE 'Non renseigne' END")


def _dept(cp: str) -> str:
    return (f"CASE WHEN substr({cp}, 1, 2) = '20' AND length({cp}) >= 3 THEN CASE WHEN TRY_CAST(substr({cp}, 3, 1) AS INTEGER) < 2 THEN '2A' ELSE '2B' END "
            f"WHEN length({cp}) >= 2 THEN substr({cp}, 1, 2) END")


def _age_band(a: str) -> str:
    return f"CASE WHEN {a} < 18 THEN '0-18' WHEN {a} BETWEEN 19 AND 30 THEN '19-30' WHEN {a} BETWEEN 31 AND 50 THEN '31-50' WHEN {a} BETWEEN 51 AND 65 THEN '51-65' ELSE '66+' END"


def _years(end: str, start: str) -> str:
    def mmdd(d):
        return f"(month({d}) * 100 + day({d}))"
    return (f"CASE WHEN {end} >= {start} THEN year({end}) - year({start}) - (CASE WHEN {mmdd(end)} < {mmdd(start)} THEN 1 ELSE 0 END) "
            f"WHEN {end} < {start} THEN -(year({start}) - year({end}) - (CASE WHEN {mmdd(start)} < {mmdd(end)} THEN 1 ELSE 0 END)) END::INTEGER")


def _num(c: str) -> str:
    return f"replace({c}, ',', '.')::DOUBLE"


def _sha(c: str, n: int | None = 8) -> str:
    return f"substr(sha256({c}), 1, {n})" if n else f"sha256({c})"


def _iso(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN TRY_CAST(trim({c}) AS DATE) END"


def _seconds(c: str) -> str:
    return f"(substr({c}, 1, 2)::INTEGER * 3600 + substr({c}, 4, 2)::INTEGER * 60 + substr({c}, 7, 2)::INTEGER)"


_AS_OF = "DATE '2025-01-01'"
_SURVEY = "trim(finess) AS finess, trim(rs_finess) AS nom_etablissement, trim(region) AS region, {kind} AS type_enquete, {year} AS annee_enquete"


def _survey_tail(n: str, reco: bool) -> str:
    return (f"{n}::BIGINT AS nombre_reponses, trim(classement) AS classement, trim(evolution) AS evolution, "
            + (f"{_num('taux_reco_brut')} AS taux_recommandation, nb_reco_brut::BIGINT AS nb_recommandations" if reco
               else "NULL::DOUBLE AS taux_recommandation, NULL::BIGINT AS nb_recommandations"))


def _survey48(raw: str, year: int, reco: bool) -> str:
    scores = ", ".join(f"{_num(f'score_{a}_rea_ajust')} AS score_{b}" for a, b in (
        ("all", "global"), ("accueil", "accueil"), ("PECinf", "pec_infirmiers"), ("PECmed", "pec_medecins"), ("chambre", "chambre"), ("repas", "repas"), ("sortie", "sortie")))
    kind = _SURVEY.format(kind="'E-SATIS 48h MCO'", year=year)
    return f"SELECT {kind}, {scores}, {_survey_tail('nb_rep_score_all_rea_ajust', reco)} FROM raw_{raw} WHERE finess IS NOT NULL"


def _survey_ca(raw: str, year: int) -> str:
    scores = ", ".join(f"{_num(f'score_{a}_ajust')} AS score_{b}" for a, b in (
        ("all", "global"), ("ACC", "accueil"), ("PEC", "pec"), ("AVH", "avant_hospitalisation"), ("CER", "ceremony"), ("OVS", "organisation_sortie")))
    kind = _SURVEY.format(kind="'E-SATIS CA MCO'", year=year)
    return f"SELECT {kind}, {scores}, {_survey_tail('nb_rep_score_all_ajust', True)} FROM raw_{raw} WHERE finess IS NOT NULL"


def _trims(cols: str) -> str:
    return ", ".join(f"trim({c}::VARCHAR) AS {c}" for c in cols.split())


_CATEGORY = "CASE WHEN {a} < 18 THEN 'PEDIATRIE' WHEN {a} > 65 THEN 'GERIATRIE' ELSE 'ADULTE' END AS categorie_patient"

# name -> SELECT; a model reads raw_<table> and the models before it
_SQL: dict[str, str] = {
    "stg_adher": "SELECT Id_patient AS id_patient, Id_mut AS id_mut, 'ACTIF' AS statut_adhesion FROM raw_adher WHERE Id_patient IS NOT NULL AND Id_mut IS NOT NULL",
    "stg_consultation": f"""SELECT Num_consultation AS num_consultation, Id_patient AS id_patient, trim(Id_prof_sante) AS id_professionnel, Id_mut AS id_mut,
        Date::DATE AS date_consultation, Heure_debut AS heure_debut, Heure_fin AS heure_fin,
        trunc(({_seconds('Heure_fin')} - {_seconds('Heure_debut')}) / 60)::INTEGER AS duree_consultation_minutes, trim(Motif) AS motif, trim(Code_diag) AS code_diagnostic
        FROM raw_consultation WHERE Id_patient IS NOT NULL""",
    "stg_deces": f"""SELECT *, {_years('date_deces', 'date_naissance')} AS age_deces FROM (
        SELECT numero_acte_deces, {_iso('date_deces')} AS date_deces, trim(code_lieu_deces) AS code_lieu_deces, code_lieu_naissance, trim(lieu_naissance) AS lieu_naissance,
               pays_naissance::VARCHAR AS pays_naissance, sexe::INTEGER AS sexe_code, {_iso('date_naissance')} AS date_naissance, trim(upper(nom)) AS nom, trim(upper(prenom)) AS prenom
        FROM raw_deces_en_france_deces WHERE date_deces IS NOT NULL)""",
    "stg_diagnostic": "SELECT trim(upper(Code_diag)) AS code_diagnostic, trim(Diagnostic) AS libelle_diagnostic, upper(Code_diag)[1:3] AS categorie_cim10, 'PostgreSQL' AS source_donnee FROM raw_diagnostic",
    "stg_etablissement_activite": "SELECT trim(identifiant) AS identifiant, identifiant_organisation, mode_exercice FROM raw_etablissement_de_sante_activite_professionnel_sante",
    "stg_etablissement_professionnel": f"""SELECT identifiant, upper(civilite) AS civilite, upper(nom) AS nom, upper(prenom) AS prenom,
        {_trims('categorie_professionnelle profession specialite type_identifiant commune')} FROM raw_etablissement_de_sante_professionnel_sante""",
    "stg_etablissement_sante": f"""SELECT {_trims('identifiant_organisation finess_etablissement_juridique finess_site raison_sociale_site enseigne_commerciale_site siren_site siret_site numero_voie indice_repetition_voie type_voie voie complement_destinataire complement_point_geographique mention_distribution adresse code_postal code_commune commune cedex pays telephone telephone_2 telecopie email')},
        {_dept('code_postal')} AS departement FROM raw_etablissement_de_sante_etablissement_sante""",
    "stg_hospitalisation": """SELECT Num_Hospitalisation::INTEGER AS num_hospitalisation, Id_patient::INTEGER AS id_patient, trim(identifiant_organisation) AS identifiant_organisation,
        Date_Entree::DATE AS date_entree, floor(Jour_Hospitalisation::DOUBLE + 0.5)::INTEGER AS jour_hospitalisation, trim(Code_diagnostic) AS code_diagnostic,
        trim(Suite_diagnostic_consultation) AS suite_diagnostic_consultation FROM raw_hospitalisation_hospitalisations WHERE Id_patient IS NOT NULL""",
    "stg_laboratoire": "SELECT Id_labo AS id_labo, trim(Laboratoire) AS nom_laboratoire, coalesce(trim(Pays), 'NON RENSEIGNE') AS pays FROM raw_laboratoire",
    "stg_medicaments": """SELECT trim(Code_CIS) AS code_cis, trim(Denomination) AS denomination, Forme_pharmaceutique AS forme_pharmaceutique, Voies_d_administration AS voies_administration,
        Statut_administratif AS statut_administratif, Type_de_procedure AS type_procedure, Etat_de_commercialisation AS etat_commercialisation, StatutBdm::VARCHAR AS statut_bdm, Date_AMM AS date_amm,
        Num_autorisation_europeenne::VARCHAR AS num_autorisation_europeenne, Titulaire AS titulaire, Surveillance_renforcee AS surveillance_renforcee FROM raw_medicaments""",
    "stg_mutuelle": f"""SELECT Id_Mut AS id_mut, trim(Nom) AS nom_mutuelle, Adresse::VARCHAR AS adresse, {pick('(Id_Mut - 100)', ['Mutuelle', 'CMU', 'Assurance'])} AS type_mutuelle FROM raw_mutuelle""",
    "stg_patient": f"""SELECT * EXCLUDE (age), coalesce(age, age_source) AS age, {_age_band('coalesce(age, age_source)')} AS tranche_age FROM (
        SELECT *, {_years(_AS_OF, 'date_naissance')} AS age FROM (
          SELECT Id_patient AS id_patient, trim(upper(Nom)) AS nom, trim(upper(Prenom)) AS prenom, upper(Sexe) AS sexe,
               coalesce(try_strptime(Date, '%m/%d/%Y')::DATE, try_strptime(Date, '%d/%m/%Y')::DATE, {_iso('Date')}) AS date_naissance, Age AS age_source,
               upper(Groupe_sanguin) AS groupe_sanguin, CASE WHEN TRY_CAST(Poid AS DOUBLE) < 999.995 THEN TRY_CAST(Poid AS DECIMAL(5, 2)) END::DOUBLE AS poids,
               floor(Taille::DOUBLE + 0.5)::INTEGER AS taille, trim(Code_postal) AS code_postal, trim(upper(Ville)) AS ville, coalesce(Pays, 'FR') AS pays, trim(Adresse) AS adresse,
               EMail AS email, Tel AS telephone, Num_Secu AS num_secu FROM raw_patient WHERE Id_patient IS NOT NULL))""",
    "stg_prescription": "SELECT Num_consultation AS num_consultation, trim(Code_CIS) AS code_cis FROM raw_prescription WHERE Num_consultation IS NOT NULL",
    "stg_professionnel_sante": f"""SELECT Identifiant AS identifiant, upper(Civilite) AS civilite, trim(upper(Nom)) AS nom, trim(upper(Prenom)) AS prenom, Profession AS profession,
        Categorie_professionnelle AS categorie_professionnelle, Code_specialite AS code_specialite, Type_identifiant AS type_identifiant FROM raw_professionnel_de_sante""",
    "stg_salle": "SELECT Id_salle AS id_salle, Num_consultation AS num_consultation, trim(Code_bloc) AS code_bloc, Num_etage AS num_etage, Num_salle AS num_salle FROM raw_salle WHERE Id_salle IS NOT NULL",
    "stg_specialites": f"""SELECT upper(Code_specialite) AS code_specialite, Fonction AS fonction, Specialite AS specialite,
        {pick('substr(Code_specialite, 2)::INTEGER', [c for _, _, c in SPECIALTIES])} AS categorie FROM raw_specialites""",
    "int_satisfaction_esatis48h": " UNION ALL ".join([_survey48("satisfaction_2020_resultats_esatis48h_mco_open_data_2020", 2020, True),
                                                      _survey48("satisfaction_2019_resultats_esatis48h_mco_open_data_2019", 2019, True),
                                                      _survey48("satisfaction_esatis48h_mco_recueil2017_donnees", 2017, False)]),
    "int_satisfaction_esatisca": " UNION ALL ".join([_survey_ca("satisfaction_2020_resultats_esatisca_mco_open_data_2020", 2020),
                                                     _survey_ca("satisfaction_2019_resultats_esatisca_mco_open_data_2019", 2019)]),
    "ods_satisfaction_unifie": """SELECT finess, nom_etablissement, region, type_enquete, annee_enquete, score_global, score_accueil, score_pec_infirmiers AS score_pec_1, score_pec_medecins AS score_pec_2,
          score_chambre, score_repas, score_sortie, NULL::DOUBLE AS score_extra_1, NULL::DOUBLE AS score_extra_2, nombre_reponses, classement, evolution, taux_recommandation, nb_recommandations FROM int_satisfaction_esatis48h
        UNION ALL SELECT finess, nom_etablissement, region, type_enquete, annee_enquete, score_global, score_accueil, score_pec, NULL, NULL, NULL, score_organisation_sortie, score_avant_hospitalisation,
          score_ceremony, nombre_reponses, classement, evolution, taux_recommandation, nb_recommandations FROM int_satisfaction_esatisca""",
    "ods_qualite_soins_unifie": f"""SELECT finess, trim(rs) AS nom_etablissement, region, 'ETE ORTHO' AS type_indicateur, 2018 AS annee_enquete, 2017 AS annee_donnee, {_num('ete_ortho_etbt')} AS ratio_ete_ortho,
        CASE WHEN trim(ete_ortho_pos_seuil_etbt) = 'Supérieur au seuil' THEN 1 ELSE 0 END AS alerte_ete, ete_ortho_cible_etbt AS cible, ete_ortho_obs_etbt AS observations, {_num('ete_ortho_att_etbt')} AS attendu,
        trim(ete_ortho_pos_seuil_etbt) AS position_seuil FROM raw_satisfaction_2017_2018_ete_ortho_ipaqss_2017_2018_donnees WHERE finess IS NOT NULL""",
    "ods_patient_complet": """SELECT p.*, m.id_mut, nom_mutuelle, type_mutuelle, statut_adhesion, m.id_mut IS NOT NULL AND statut_adhesion = 'ACTIF' AS a_mutuelle_active
        FROM stg_patient p LEFT JOIN stg_adher a ON p.id_patient = a.id_patient LEFT JOIN stg_mutuelle m ON a.id_mut = m.id_mut""",
    "ods_professionnel_complet": """SELECT p.*, commune_exercice, specialite_exercice_etab, coalesce(nb_etablissements, 0) AS nb_etablissements, s.fonction AS specialite_fonction,
          s.specialite AS specialite_libelle, s.categorie AS specialite_categorie, CASE categorie_professionnelle WHEN 'Libéral' THEN 'Libéral' WHEN 'Liberal' THEN 'Libéral' WHEN 'Salarie' THEN 'Salarié' WHEN 'Mixte' THEN 'Mixte'
          ELSE 'Non renseigné' END AS mode_exercice
        FROM (SELECT DISTINCT * FROM stg_professionnel_sante) p
        LEFT JOIN (SELECT identifiant, max(commune) AS commune_exercice, max(specialite) AS specialite_exercice_etab, count(DISTINCT commune) AS nb_etablissements
                   FROM stg_etablissement_professionnel GROUP BY identifiant) e ON p.identifiant = e.identifiant
        LEFT JOIN stg_specialites s ON p.code_specialite = s.code_specialite""",
    "ods_consultation_enrichie": f"""SELECT c.num_consultation, date_consultation, heure_debut, heure_fin, duree_consultation_minutes, motif, c.id_patient, id_professionnel, c.code_diagnostic, c.id_mut,
          p.nom AS patient_nom, p.prenom AS patient_prenom, p.sexe AS patient_sexe, p.age AS patient_age, p.tranche_age AS patient_tranche_age, p.ville AS patient_ville, p.code_postal AS patient_code_postal,
          p.nom_mutuelle AS patient_mutuelle, p.type_mutuelle AS patient_type_mutuelle, p.a_mutuelle_active AS patient_a_mutuelle, r.nom AS professionnel_nom, r.prenom AS professionnel_prenom,
          r.profession AS professionnel_profession, r.code_specialite AS professionnel_code_specialite, r.mode_exercice AS professionnel_mode_exercice, libelle_diagnostic, categorie_cim10,
          {_CATEGORY.format(a='p.age')}, CASE WHEN duree_consultation_minutes < 15 THEN 'COURTE' WHEN duree_consultation_minutes <= 30 THEN 'NORMALE' WHEN duree_consultation_minutes > 30 THEN 'LONGUE'
          ELSE 'NON_RENSEIGNEE' END AS duree_categorie
        FROM stg_consultation c JOIN ods_patient_complet p ON c.id_patient = p.id_patient LEFT JOIN ods_professionnel_complet r ON id_professionnel = r.identifiant
        LEFT JOIN stg_diagnostic d ON c.code_diagnostic = d.code_diagnostic""",
    "ods_hospitalisation_enrichie": f"""SELECT num_hospitalisation, date_entree, jour_hospitalisation, h.id_patient, h.identifiant_organisation, h.code_diagnostic, p.nom AS patient_nom, p.prenom AS patient_prenom,
          p.sexe AS patient_sexe, p.age AS patient_age, p.tranche_age AS patient_tranche_age, e.identifiant_organisation AS etablissement_identifiant, raison_sociale_site AS etablissement_nom,
          commune AS etablissement_commune, departement AS etablissement_departement, libelle_diagnostic, categorie_cim10, suite_diagnostic_consultation,
          CASE WHEN jour_hospitalisation < 3 THEN 'COURT_SEJOUR' WHEN jour_hospitalisation <= 7 THEN 'MOYEN_SEJOUR' WHEN jour_hospitalisation > 7 THEN 'LONG_SEJOUR' ELSE 'NON_RENSEIGNE' END AS type_sejour,
          {_CATEGORY.format(a='p.age')}
        FROM stg_hospitalisation h JOIN ods_patient_complet p ON h.id_patient = p.id_patient LEFT JOIN stg_etablissement_sante e ON h.identifiant_organisation = e.identifiant_organisation
        LEFT JOIN stg_diagnostic d ON h.code_diagnostic = d.code_diagnostic""",
    "ods_deces_enrichi": """SELECT numero_acte_deces, date_deces, date_naissance, age_deces, CASE WHEN age_deces < 1 THEN 'MOINS_1_AN' WHEN age_deces <= 18 THEN 'ENFANT' WHEN age_deces <= 30 THEN 'JEUNE_ADULTE'
          WHEN age_deces <= 65 THEN 'ADULTE' WHEN age_deces > 65 THEN 'SENIOR' ELSE 'NON_RENSEIGNE' END AS tranche_age_deces, CASE sexe_code WHEN 1 THEN 'M' WHEN 2 THEN 'F' ELSE 'INCONNU' END AS sexe,
          code_lieu_deces, code_lieu_naissance, lieu_naissance, pays_naissance, nom, prenom FROM stg_deces WHERE date_deces IS NOT NULL""",
    "ods_prescription_enrichie": """SELECT p.num_consultation, p.code_cis, denomination AS medicament_nom, forme_pharmaceutique, voies_administration, statut_administratif, etat_commercialisation, titulaire AS laboratoire,
          date_consultation, id_patient, patient_nom, patient_prenom, id_professionnel, professionnel_nom, code_diagnostic
        FROM stg_prescription p LEFT JOIN stg_medicaments m ON p.code_cis = m.code_cis LEFT JOIN ods_consultation_enrichie c ON p.num_consultation = c.num_consultation""",
    "ods_localisation_consolidee": f"""SELECT code_lieu, max(nom_lieu) AS nom_lieu, max(code_postal) AS code_postal, max(ville) AS ville, max(departement) AS departement, max(pays) AS pays,
          string_agg(DISTINCT t, ', ' ORDER BY t) AS types_lieu, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude, count(*) AS nb_occurrences FROM (
          SELECT DISTINCT code_postal AS code_lieu, ville AS nom_lieu, code_postal, ville, {_dept('code_postal')} AS departement, pays, 'Patient' AS t FROM stg_patient WHERE code_postal IS NOT NULL
          UNION ALL SELECT DISTINCT code_postal, commune, code_postal, commune, departement, pays, 'Etablissement' FROM stg_etablissement_sante WHERE code_postal IS NOT NULL
          UNION ALL SELECT DISTINCT code_lieu_deces, code_lieu_deces, NULL, NULL, NULL, 'FR', 'Deces' FROM stg_deces WHERE code_lieu_deces IS NOT NULL) GROUP BY code_lieu""",
    "dim_specialite": "SELECT row_number() OVER (ORDER BY code_specialite) AS sk_specialite, code_specialite, fonction, specialite, categorie FROM stg_specialites",
    "dim_mutuelle": "SELECT row_number() OVER (ORDER BY id_mut) AS sk_mutuelle, * FROM stg_mutuelle",
    "dim_diagnostic": f"""SELECT row_number() OVER (ORDER BY code_diagnostic) AS sk_diagnostic, code_diagnostic, libelle_diagnostic, categorie_cim10,
        {_lookup('categorie_cim10', CHAPTERS, '?')} AS chapitre_cim10, source_donnee FROM stg_diagnostic""",
    "dim_localisation": f"""SELECT row_number() OVER (ORDER BY code_lieu, types_lieu) AS sk_localisation, code_lieu, nom_lieu, code_postal, ville, departement, {_region('departement')} AS region,
        CASE WHEN pays IN ('France', 'FR', 'FRANCE') THEN 'FR' WHEN pays IS NOT NULL THEN substr(pays, 1, 2) ELSE 'FR' END AS pays, types_lieu AS type_lieu, latitude, longitude FROM ods_localisation_consolidee""",
    "dim_etablissement": f"""SELECT row_number() OVER (ORDER BY identifiant_organisation) AS sk_etablissement, identifiant_organisation AS finess, finess_etablissement_juridique, finess_site,
        raison_sociale_site AS nom_etablissement, {pick('substr(identifiant_organisation, 4)::BIGINT', [t for _, t, _ in FACILITIES])} AS type_etablissement,
        {pick('substr(identifiant_organisation, 4)::BIGINT', [s for _, _, s in FACILITIES])} AS categorie, {_region('departement')} AS region, departement, adresse, code_postal, commune AS ville FROM stg_etablissement_sante""",
    "dim_patient": f"""SELECT row_number() OVER (ORDER BY id_patient) AS sk_patient, id_patient, {_sha('nom')} AS nom_anonyme, {_sha('prenom')} AS prenom_anonyme, sexe, date_naissance, age, tranche_age, groupe_sanguin,
        poids, taille, code_postal, ville, pays, {_sha('num_secu', None)} AS num_secu_hash FROM (SELECT DISTINCT * FROM stg_patient)""",
    "dim_professionnel": f"""SELECT row_number() OVER (ORDER BY p.identifiant, fk_organisation) AS sk_professionnel, p.identifiant, civilite, {_sha('nom')} AS nom_anonyme, {_sha('prenom')} AS prenom_anonyme, profession,
          categorie_professionnelle, fk_specialite, mode_exercice, fk_organisation, {_AS_OF} AS date_debut_validite, NULL::DATE AS date_fin_validite, TRUE AS est_actuel
        FROM (SELECT p.*, sk_specialite AS fk_specialite, sk_etablissement AS fk_organisation FROM ods_professionnel_complet p LEFT JOIN dim_specialite s ON p.code_specialite = s.code_specialite
              LEFT JOIN stg_etablissement_activite a ON p.identifiant = a.identifiant LEFT JOIN dim_etablissement e ON a.identifiant_organisation = e.finess) p""",
    "jours": f"SELECT d::DATE AS jour, (year(d) * 10000 + month(d) * 100 + day(d))::BIGINT AS sk_temps FROM generate_series(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 DAY) AS t(d)",
    "fait_consultation": """SELECT row_number() OVER (ORDER BY num_consultation, sk_patient, sk_professionnel) AS sk_fait_consultation, sk_patient, sk_professionnel, sk_diagnostic, coalesce(sk_mutuelle, -1) AS sk_mutuelle,
          coalesce(fk_organisation, -1) AS sk_etablissement, sk_temps, num_consultation, heure_debut, heure_fin, motif, duree_consultation_minutes AS duree_consultation, 1 AS nombre_consultations
        FROM ods_consultation_enrichie c JOIN dim_patient p ON c.id_patient = p.id_patient JOIN dim_professionnel r ON c.id_professionnel = r.identifiant JOIN dim_diagnostic d ON c.code_diagnostic = d.code_diagnostic
        JOIN jours ON date_consultation = jour LEFT JOIN dim_mutuelle m ON c.id_mut = m.id_mut""",
    "fait_hospitalisation": """SELECT row_number() OVER (ORDER BY num_hospitalisation, sk_patient, coalesce(sk_etablissement, -1), coalesce(sk_diagnostic, -1), sk_temps, jour_hospitalisation) AS sk_fait_hospitalisation, sk_patient, coalesce(sk_etablissement, -1) AS sk_etablissement, coalesce(sk_diagnostic, -1) AS sk_diagnostic,
          sk_temps, coalesce(sk_localisation, -1) AS sk_localisation, num_hospitalisation, jour_hospitalisation, 1 AS nombre_hospitalisations
        FROM ods_hospitalisation_enrichie h JOIN dim_patient p ON h.id_patient = p.id_patient JOIN jours ON date_entree = jour LEFT JOIN dim_etablissement e ON identifiant_organisation = finess
        LEFT JOIN dim_diagnostic d ON h.code_diagnostic = d.code_diagnostic LEFT JOIN dim_localisation l ON e.code_postal = code_lieu AND type_lieu LIKE '%Etablissement%'""",
    "fait_deces": f"""SELECT row_number() OVER (ORDER BY numero_acte_deces, sk_patient) AS sk_fait_deces, coalesce(sk_patient, -1) AS sk_patient, coalesce(sk_localisation, -1) AS sk_localisation, sk_temps, code_lieu_deces,
          numero_acte_deces, age_deces, 1 AS nombre_deces
        FROM ods_deces_enrichi d JOIN jours ON date_deces = jour LEFT JOIN dim_localisation l ON code_lieu_deces = code_lieu AND type_lieu LIKE '%Deces%'
        LEFT JOIN dim_patient p ON {_sha('nom')} = nom_anonyme AND {_sha('prenom')} = prenom_anonyme AND d.date_naissance = p.date_naissance""",
    "trouves": """SELECT x AS finess, min(struct_pack(p := prio, s := sk)).s AS sk_etablissement FROM (SELECT finess AS x FROM ods_satisfaction_unifie UNION SELECT finess FROM ods_qualite_soins_unifie)
        JOIN (SELECT 1 AS prio, finess_site AS h, sk_etablissement AS sk FROM dim_etablissement UNION ALL SELECT 2, finess, sk_etablissement FROM dim_etablissement
              UNION ALL SELECT 3, finess_etablissement_juridique, sk_etablissement FROM dim_etablissement) ON contains(h, x) GROUP BY x""",
    "fait_satisfaction": """SELECT row_number() OVER (ORDER BY s.finess, annee_enquete, coalesce(sk_etablissement, -1), region, score_global, score_accueil, score_pec_1, score_pec_2) AS sk_fait_satisfaction,
          coalesce(sk_etablissement, -1) AS sk_etablissement, region, annee_enquete, score_global, score_accueil, score_pec_1 AS score_pec_infirmiers, score_pec_2 AS score_pec_medecins, score_chambre, score_repas, score_sortie,
          taux_recommandation, nombre_reponses, classement, evolution FROM ods_satisfaction_unifie s LEFT JOIN trouves t ON s.finess = t.finess""",
    "fait_qualite_soins": """SELECT row_number() OVER (ORDER BY s.finess, annee_enquete) AS sk_fait_qualite, coalesce(sk_etablissement, -1) AS sk_etablissement, region, annee_enquete, annee_donnee, ratio_ete_ortho, alerte_ete,
          cible, observations, attendu, position_seuil FROM ods_qualite_soins_unifie s LEFT JOIN trouves t ON s.finess = t.finess""",
}

_CTES = "WITH " + ",\n".join([f"raw_{n} AS ({s.format(**{t: t for t in TABLES})})" for n, s in RAW_SQL.items()] + [f"{n} AS ({s})" for n, s in _SQL.items()])
ORACLES = {f"m_{m}": f"{_CTES}\nSELECT * FROM {m}" for m in models()}

_SCORES = ["score_global", "score_accueil", "taux_recommandation"]
_S48 = ["score_pec_infirmiers", "score_pec_medecins", "score_chambre", "score_repas", "score_sortie"]
DOUBLE_COLUMNS = {
    "m_stg_patient": ["poids"], "m_ods_patient_complet": ["poids"], "m_dim_patient": ["poids"],
    "m_int_satisfaction_esatis48h": _SCORES + _S48, "m_fait_satisfaction": _SCORES + _S48,
    "m_int_satisfaction_esatisca": _SCORES + ["score_pec", "score_avant_hospitalisation", "score_ceremony", "score_organisation_sortie"],
    "m_ods_satisfaction_unifie": _SCORES + ["score_pec_1", "score_pec_2", "score_chambre", "score_repas", "score_sortie", "score_extra_1", "score_extra_2"],
    "m_ods_qualite_soins_unifie": ["ratio_ete_ortho", "attendu"], "m_fait_qualite_soins": ["ratio_ete_ortho", "attendu"],
    "m_ods_localisation_consolidee": ["latitude", "longitude"], "m_dim_localisation": ["latitude", "longitude"],
}
