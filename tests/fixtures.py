"""Inline raw rows for model tests (every row exists for a reason, see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from carelake.sources.schemas import RAW_SCHEMAS

AS_OF = dt.datetime(2025, 1, 1)

SAT48 = ["finess", "rs_finess", "region", "score_all_rea_ajust", "score_accueil_rea_ajust",
         "score_PECinf_rea_ajust", "score_PECmed_rea_ajust", "score_chambre_rea_ajust",
         "score_repas_rea_ajust", "score_sortie_rea_ajust", "nb_rep_score_all_rea_ajust",
         "classement", "evolution", "taux_reco_brut", "nb_reco_brut"]


def _row(cols, **kv):
    return tuple(kv.get(c) for c in cols)


def raw_tables(spark):
    S = RAW_SCHEMAS
    rows = {
        "patient": [
            (1, "Dupont ", "Marie", "f", "4/6/1980", 44, "72.456", "170", "75011", "Paris", "France", "1 rue A",
             "m@x.fr", "0102", "2800675"),
            (2, "Martin", "Paul", "m", "25/7/2013", 11, "31,5", "140.6", "20090", "Ajaccio", None, None,
             None, None, "1130720"),
            (3, "Bernard", "Luc", "m", None, 18, None, None, "20200", "Bastia", "FR", None, None, None, None),
            (4, "Petit", "Anne", "f", "1950-12-31", 74, "1000.5", "160", "97400", "St Denis", "FR", None,
             None, None, None),
            (None, "Nobody", "X", "m", "1/1/2000", 25, None, None, None, None, None, None, None, None, None),
            (6, "Durand", "Eve", "f", "garbage", None, None, None, None, None, None, None, None, None, None),
        ],
        "adher": [(1, 100), (1, 101), (None, 100)],
        "mutuelle": [(100, "Mutuelle Generale", 1), (101, "CMU Complementaire", 2), (102, "Axa Assurance", 3)],
        "consultation": [
            (10, 1, "P1", 100, "2020-03-01", "09:00:00", "09:14:59", "Controle", "a00.1"),
            (11, 2, "P2", None, "2020-03-01", "09:00:00", "09:15:00", "Suivi", "D48"),
            (12, 2, "P1", None, "2020-03-02", "09:00:00", "09:30:59", "Suivi", "D49"),
            (13, 4, "P1", 999, "2020-03-02", "09:00:00", "09:31:00", "Urgence", "Z99"),
            (14, 4, "P2", None, "2021-06-01", "23:50:30", "09:15:00", "Nuit", "D50"),
            (15, 3, "P1", None, "2021-06-01", None, None, "Inconnu", "U07"),
            (16, None, "P1", None, "2021-06-01", "10:00:00", "10:20:00", "Sans patient", "D48"),
        ],
        "prescription": [(10, "C1"), (11, "C2"), (99, "C1"), (None, "C3")],
        "medicaments": [_row(S["medicaments"].names, Code_CIS=" C1 ", Denomination="Doliprane ",
                             Titulaire="Sanofi"),
                        _row(S["medicaments"].names, Code_CIS="C2", Denomination="Advil")],
        "diagnostic": [("a00.1", "Cholera"), ("D48", "Tumeur incertaine"), ("D49", "Autre tumeur"),
                       ("D50", "Anemie"), ("U07", "Covid"), ("Z99", "Dependance")],
        "professionnel_de_sante": [
            ("P1", "Dr", "House", "Greg", "Medecin", "Libéral", "S01", "RPPS"),
            ("P2", "Mme", "Grey", "Meredith", "Infirmier", "Salarie", "S02", "RPPS"),
        ],
        "specialites": [
            ("s01", "Medecin generaliste", None), ("S02", "Aide-soignant", None),
            ("S03", "Medecin", "Cardiologie"), ("S04", "Médecin", "x"), ("S05", None, None),
            ("S06", "Ambulancier", None),
        ],
        "salle": [("R1", 10, "B", "1", "101"), (None, 11, "B", "1", "102")],
        "laboratoire": [(1, "Lab A", None), (2, "Lab B", "Suisse")],
        "deces_en_france_deces": [
            _row(S["deces_en_france_deces"].names, numero_acte_deces="D1", date_deces="2019-03-01",
                 date_naissance="1950-03-02", sexe="1", code_lieu_deces="33063", nom="a", prenom="b"),
            _row(S["deces_en_france_deces"].names, numero_acte_deces="D2", date_deces="2019-03-02",
                 date_naissance="1950-03-02", sexe="2", code_lieu_deces="75011", nom="c", prenom="d"),
            _row(S["deces_en_france_deces"].names, numero_acte_deces="D3", date_deces="2019-05",
                 date_naissance="1950-03-02", sexe="1", code_lieu_deces="33063", nom="e", prenom="f"),
            _row(S["deces_en_france_deces"].names, numero_acte_deces="D4", date_deces="2001-02-28",
                 date_naissance="2000-02-29", sexe="1", code_lieu_deces="33063", nom="g", prenom="h"),
            _row(S["deces_en_france_deces"].names, numero_acte_deces="D5", date_deces="2018-01-01",
                 date_naissance="2018-06-01", sexe="3", code_lieu_deces="33063", nom="i", prenom="j"),
            _row(S["deces_en_france_deces"].names, numero_acte_deces="D6", date_deces="2020-05-01",
                 date_naissance="1980-04-06", sexe="2", code_lieu_deces="75011", nom="Dupont", prenom="Marie"),
        ],
        "hospitalisation_hospitalisations": [
            ("1", "1", "E1", "2020-02-01", "2", "D48", None),
            ("2", "2", "X020000456", "2020-02-02", "3.5", "Z99", None),
            ("3", "4", "NOPE", "2020-02-03", "8", "XXX", None),
            ("4", "99", "E1", "2020-02-03", "1", "D48", None),
            ("5", None, "E1", "2020-02-03", "1", "D48", None),
        ],
        "etablissement_de_sante_etablissement_sante": [
            _row(S["etablissement_de_sante_etablissement_sante"].names, identifiant_organisation="E1",
                 finess_site=9010000123, raison_sociale_site="CHU de Paris", code_postal="75011",
                 commune="PARIS", pays="France"),
            _row(S["etablissement_de_sante_etablissement_sante"].names, identifiant_organisation="X020000456",
                 raison_sociale_site="Clinique du Parc", code_postal="33000", commune="BORDEAUX"),
            _row(S["etablissement_de_sante_etablissement_sante"].names, identifiant_organisation="E3",
                 finess_etablissement_juridique="030000789", raison_sociale_site="EHPAD Les Pins",
                 code_postal="20090", commune="AJACCIO"),
            _row(S["etablissement_de_sante_etablissement_sante"].names, identifiant_organisation="E4",
                 finess_site=7010000123, raison_sociale_site="Hopital Nord", code_postal="13001",
                 commune="MARSEILLE"),
        ],
        "etablissement_de_sante_professionnel_sante": [
            ("P1", "m", "House", "Greg", "Libéral", "Medecin", "Cardio", "RPPS", "Paris"),
            ("P1", "m", "House", "Greg", "Libéral", "Medecin", "Cardio", "RPPS", "Lyon"),
        ],
        "etablissement_de_sante_activite_professionnel_sante": [
            (" P1", "E1", "Liberal"), ("P1", "X020000456", "Liberal"),
        ],
        "satisfaction_2020_resultats_esatis48h_mco_open_data_2020": [
            _row(SAT48, finess="010000123", rs_finess="CHU", region="Ile-de-France", score_all_rea_ajust="75,5",
                 nb_rep_score_all_rea_ajust="100", taux_reco_brut="90,0", nb_reco_brut="80"),
            _row(SAT48, finess="020000456", rs_finess="Clinique", region="Ile-de-France",
                 nb_rep_score_all_rea_ajust="50"),
        ],
        "satisfaction_2019_resultats_esatis48h_mco_open_data_2019": [
            _row(SAT48, finess="030000789", rs_finess="EHPAD", region=None, score_all_rea_ajust="60.0",
                 nb_rep_score_all_rea_ajust="10"),
        ],
        "satisfaction_esatis48h_mco_recueil2017_donnees": [
            _row(SAT48[:-2], finess="999999999", rs_finess="Ailleurs", region="Bretagne",
                 score_all_rea_ajust="50", nb_rep_score_all_rea_ajust="5"),
        ],
        "satisfaction_2020_resultats_esatisca_mco_open_data_2020": [
            ("010000123", "CHU", "Ile-de-France", "80,0", "70", "71", "72", "73", "74", "20", "A", "=", "85",
             "15"),
        ],
        "satisfaction_2019_resultats_esatisca_mco_open_data_2019": [],
        "satisfaction_2017_2018_ete_ortho_ipaqss_2017_2018_donnees": [
            ("010000123", "CHU", "IDF", "1,2", "Supérieur au seuil ", "3", "4", "2,5"),
            ("020000456", "Clin", "IDF", "0,5", "Inférieur au seuil", "1", "1", "1"),
        ],
    }
    # blood group sits between Age and Poid
    rows["patient"] = [r[:6] + ("a+",) + r[6:] for r in rows["patient"]]
    return {name: spark.createDataFrame(r, RAW_SCHEMAS[name]) for name, r in rows.items()}
