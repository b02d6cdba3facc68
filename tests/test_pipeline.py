"""The 47 models on the inline fixtures (FIXTURES.md), materialised layer by layer."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake.plans import kpi
from carelake.plans.registry import LAYERS, Pipeline, topological_order
from fixtures import AS_OF, raw_tables


@pytest.fixture(scope="module")
def wh(spark):
    import tempfile
    p = Pipeline(spark, raw_tables(spark), AS_OF, root=tempfile.mkdtemp(prefix="carelake-pipe-"))
    return p.run()


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_every_model_is_built_in_dependency_order(wh):
    from carelake.plans.registry import _registry
    models = _registry(AS_OF, None, None)
    order = topological_order(models)
    for name in order:
        for dep in models[name].inputs:
            if not dep.startswith("raw."):
                assert order.index(dep) < order.index(name)
    assert len([n for n in order if models[n].layer in LAYERS]) == 47
    assert set(wh) == set(order)


def test_stg_patient_fixture(wh):
    got = {r.id_patient: r for r in wh["stg_patient"].collect()}
    assert sorted(got) == [1, 2, 3, 4, 6]  # NULL id dropped
    assert got[1].date_naissance == dt.datetime(1980, 4, 6) and got[1].age == 44 and got[1].tranche_age == "31-50"
    assert float(got[1].poids) == 72.46 and got[1].taille == 170 and got[1].nom == "DUPONT"
    assert got[2].date_naissance == dt.datetime(2013, 7, 25) and got[2].poids is None and got[2].taille == 141
    assert (got[3].age, got[3].tranche_age) == (18, "66+")
    assert got[4].poids is None and got[6].tranche_age == "66+" and got[6].age is None


def test_membership_fanout_t17a(wh):
    opc = wh["ods_patient_complet"]
    assert opc.where("id_patient = 1").count() == 2 and opc.where("id_patient = 2").count() == 1
    assert wh["dim_patient"].where("id_patient = 1").count() == 1
    dp = {r.id_patient: r for r in wh["dim_patient"].collect()}
    assert dp[1].nom_anonyme == "f84be3f9" and dp[1].prenom_anonyme == "19b710d8"
    assert len(dp[1].num_secu_hash) == 64 and dp[3].num_secu_hash is None


def test_professional_activity_fanout_t17b(wh):
    pro = wh["dim_professionnel"]
    assert pro.where("identifiant = 'P1'").count() == 2
    p2 = pro.where("identifiant = 'P2'").first()
    assert p2.fk_organisation is None and p2.est_actuel and p2.date_debut_validite == dt.date(2025, 1, 1)
    fc = wh["fait_consultation"]
    # consultation 12 (P1) appears twice; consultation 11 (P2) gets establishment -1
    assert fc.where("num_consultation = 12").count() == 2
    assert rows(fc.where("num_consultation = 11"), "sk_etablissement") == [(-1,)]
    # consultation 10 has code 'a00.1' which staging trims but does not upper-case: no diagnosis, dropped
    assert fc.where("num_consultation = 10").count() == 0


def test_consultation_durations_and_classes(wh):
    got = {r.num_consultation: (r.duree_consultation_minutes, r.duree_categorie)
           for r in wh["ods_consultation_enrichie"].collect()}
    assert got[12] == (30, "NORMALE") and got[13] == (31, "LONGUE") and got[14] == (-875, "COURTE")
    assert got[15] == (None, "NON_RENSEIGNEE")


def test_deaths_dates_ages_and_person_match(wh):
    stg = {r.numero_acte_deces: r for r in wh["stg_deces"].collect()}
    assert stg["D3"].date_deces is None and stg["D4"].age_deces == 0 and stg["D1"].age_deces == 68
    ods = {r.numero_acte_deces: r for r in wh["ods_deces_enrichi"].collect()}
    assert "D3" not in ods and ods["D1"].tranche_age_deces == "SENIOR" and ods["D5"].sexe == "INCONNU"
    fd = {r.numero_acte_deces: r for r in wh["fait_deces"].collect()}
    assert "D4" not in fd  # outside the calendar (T18)
    assert fd["D6"].sk_patient == 1 and fd["D1"].sk_patient == -1
    assert fd["D1"].sk_localisation != -1  # '33063' is a death place


def test_containment_cascade_and_satisfaction_mart(wh):
    fs = wh["fait_satisfaction"]
    by_year = {(r.annee_enquete, r.score_global): r.sk_etablissement for r in fs.collect()}
    assert by_year[(2020, 75.5)] == 1 and by_year[(2019, 60.0)] == 2 and by_year[(2017, 50.0)] == -1
    assert rows(fs.where("annee_enquete = 2020 AND score_global IS NULL"), "sk_etablissement") == [(4,)]
    m = wh["dm_satisfaction_analysis"].first()
    # (75.5*100 + 80*20 + NULL*50) / 170: the NULL score keeps its weight
    assert abs(m.taux_satisfaction_moyen_region - 9150 / 170) < 1e-9 and m.note_moyenne_simple_region == 77.75
    assert m.nb_etablissements_region == 2 and m.sk_temps == 20200101


def test_places_and_regional_death_mart(wh):
    loc = {r.code_lieu: r for r in wh["ods_localisation_consolidee"].collect()}
    assert loc["75011"].types_lieu == "Deces, Etablissement, Patient" and loc["75011"].nb_occurrences == 3
    assert loc["33063"].types_lieu == "Deces" and loc["33063"].departement is None
    dim = {r.code_lieu: r for r in wh["dim_localisation"].collect()}
    assert dim["33063"].region == "Non renseigne" and dim["20090"].region == "Corse"
    dm = wh["dm_deces_analysis"].collect()  # 2019: D1 (33063, excluded) and D2 (75011)
    assert [(r.region, r.nb_deces_departement) for r in dm] == [("Ile-de-France", 1)]


def test_quality_alert_and_union(wh):
    q = rows(wh["ods_qualite_soins_unifie"], "finess", "alerte_ete")
    assert q == [("010000123", 1), ("020000456", 0)]
    u = wh["ods_satisfaction_unifie"]
    assert u.count() == 5
    ca = u.where("type_enquete = 'E-SATIS CA MCO'").first()
    assert ca.score_pec_2 is None and ca.score_chambre is None and ca.score_extra_1 == 72.0
    assert u.where("annee_enquete = 2017").first().taux_recommandation is None


def test_keys_dense_and_unique(wh):
    for name, sk in [("dim_patient", "sk_patient"), ("dim_diagnostic", "sk_diagnostic"),
                     ("dim_etablissement", "sk_etablissement"), ("dim_localisation", "sk_localisation"),
                     ("fait_consultation", "sk_fait_consultation"), ("fait_deces", "sk_fait_deces")]:
        r = wh[name].agg(F.count("*").alias("n"), F.countDistinct(sk).alias("d"), F.min(sk).alias("lo"),
                         F.max(sk).alias("hi")).first()
        assert (r.d, r.lo, r.hi) == (r.n, 1, r.n), name


def test_grain_totals_add_up(wh):
    hagg = wh["dm_hospitalisations_agregees"]
    base = wh["dm_hospitalisations_analysis"]
    assert hagg.count() == base.count()  # one row per stay: no fan-out
    per_day = base.groupBy("sk_temps", "sk_etablissement").agg(F.sum("nombre_hospitalisations").alias("n"))
    joined = hagg.join(per_day, ["sk_temps", "sk_etablissement"])
    assert joined.where("n != nb_hospitalisations_etablissement").count() == 0


def test_kpis_on_fixture_marts(wh):
    k5 = kpi.kpi5(wh["dm_hospitalisations_analysis"], year=2020).collect()
    assert abs(sum(r.pourcentage_total for r in k5) - 100.0) < 1e-9
    k3 = kpi.kpi3(wh["dm_hospitalisations_analysis"], since=2020).collect()
    assert sum(r.hospitalisations_totales for r in k3) == wh["fait_hospitalisation"].count()
    k8 = kpi.kpi8(wh["dm_satisfaction_analysis"], year=2020).collect()
    assert k8[0].rang_national == 1
