"""Cleaning expressions, rule classifiers and the calendar (P, C, G operators)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake.functions import calendar as cal
from carelake.functions import rules
from carelake.functions.clean import (age_years, alert_flag, clean_text, clean_upper, decode_sex, departement,
                                      duration_minutes, iso2_country, iso_date, pad_code, parse_date_any,
                                      parse_decimal_comma, to_int)
from carelake.sources.io import normalize_name


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_date_any_order_and_fallbacks(spark):
    got = one_col(spark, ["4/6/1980", "25/7/2013", "1950-12-31", "garbage", None, " 7/25/2013 ", "1980-05", "4/6/80"],
                  lambda c: parse_date_any(c).cast("date"))
    assert got == [dt.date(1980, 4, 6), dt.date(2013, 7, 25), dt.date(1950, 12, 31), None, None,
                   dt.date(2013, 7, 25), None, None]  # T3 month first, T4 partial, T11 2-digit year


def test_iso_date_rejects_partial_dates(spark):
    assert one_col(spark, ["2019-05", "2019-05-03", "1980"], iso_date) == [None, dt.date(2019, 5, 3), None]


def test_decimal_comma(spark):
    assert one_col(spark, ["75,5", "60.0", None], parse_decimal_comma) == [75.5, 60.0, None]
    assert one_col(spark, ["n/a"], lambda c: parse_decimal_comma(c, safe=True)) == [None]


@pytest.mark.parametrize("end,start,years", [
    ("2001-02-28", "2000-02-29", 0), ("1999-01-01", "2000-06-01", -1), ("2019-03-01", "1950-03-02", 68),
    ("2019-03-02", "1950-03-02", 69), ("2018-01-01", "2018-06-01", 0), ("2001-03-01", "2000-02-29", 1)])
def test_age_years_trap_t5(spark, end, start, years):
    df = spark.createDataFrame([(end, start)], "e string, s string")
    assert df.select(age_years(F.col("e").cast("date"), F.col("s").cast("date"))).first()[0] == years


def test_duration_minutes_fixture(spark):
    rows = [("09:00:00", "09:14:59", 14), ("09:00:00", "09:15:00", 15), ("09:00:00", "09:30:59", 30),
            ("09:00:00", "09:31:00", 31), ("23:50:30", "09:15:00", -875), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, m int")
    got = df.select(duration_minutes("a", "b").alias("d"), rules.consultation_length(
        duration_minutes("a", "b")).alias("c"), "m").collect()
    assert [r.d for r in got] == [r.m for r in got]
    assert [r.c for r in got] == ["COURTE", "NORMALE", "NORMALE", "LONGUE", "COURTE", "NON_RENSEIGNEE"]


def test_departement_and_region(spark):
    cps = ["75011", "20090", "20200", "97400", "2", None, "20", "20A11", " 13001 "]
    got = one_col(spark, cps, departement)
    assert got == ["75", "2A", "2B", "97", None, None, "20", "2B", "13"]
    regions = one_col(spark, ["75", "2A", "97", "971", "99", None], rules.region_of)
    assert regions == ["Ile-de-France", "Corse", "Outre-mer", "Outre-mer", "Non renseigne", "Non renseigne"]


def test_to_int_rounds_like_reference_t9(spark):
    assert one_col(spark, ["2.5", "3.7", "140.6", "170", "x", None], to_int) == [3, 4, 141, 170, None, None]


def test_trim_removes_nbsp_t10(spark):
    assert one_col(spark, [" Doliprane ", " a b "], clean_text) == ["Doliprane", "a b"]
    assert one_col(spark, ["Dupont "], clean_upper) == ["DUPONT"]


def test_small_helpers(spark):
    assert one_col(spark, ["France", "FR", "Belgique", None], iso2_country) == ["FR", "FR", "Be", "FR"]
    assert one_col(spark, [1, 2, 3, None], decode_sex, "int") == ["M", "F", "INCONNU", "INCONNU"]
    assert one_col(spark, ["Supérieur au seuil ", "Inférieur"], lambda c: alert_flag(c, "Supérieur au seuil")) == [1, 0]
    assert one_col(spark, ["7"], lambda c: pad_code(c, 3)) == ["007"]


def test_normalize_name(spark):
    names = ["DECES EN FRANCE/deces.csv", "Référentiel Pièces", "__a--b  c.xlsx", "x.csv.y", "DECES EN FRANCE", None]
    assert one_col(spark, names, normalize_name) == ["deces_en_france_deces", "référentiel_pièces", "a_b_c", "x_y",
                                                     "deces_en_france", None]


def test_age_band_gap_t1(spark):
    got = one_col(spark, [0, 17, 18, 19, 30, 31, 50, 51, 65, 66, None], rules.age_band, "int")
    assert got == ["0-18", "0-18", "66+", "19-30", "19-30", "31-50", "31-50", "51-65", "51-65", "66+", "66+"]


def test_specialty_rules_order_t23(spark):
    df = spark.createDataFrame(
        [("Aide-soignant", None), ("Medecin generaliste", None), ("Medecin", "Cardiologie"), ("Medecin", " "),
         ("Médecin", "x"), (None, None), ("Ambulancier", None), ("Chirurgien-dentiste", None),
         ("Infirmier", None), ("ORL", None), ("Urgentiste", None)], "f string, s string")
    got = [r[0] for r in df.select(rules.specialty_category("f", "s")).collect()]
    assert got == ["Soins infirmiers", "Medecine generale", "Medecine specialisee", "Autre", "Autre", "Autre",
                   "Transport sanitaire", "Dentaire", "Soins infirmiers", "ORL", "Medecine d'urgence"]


def test_icd10_chapters(spark):
    got = one_col(spark, ["A00", "D48", "D49", "D50", "U07", "Z99", "T98", "H59", "H60", None], rules.icd10_chapter)
    assert got[0].startswith("Maladies infectieuses")
    assert got[1] == "Tumeurs" and got[2] == "Autre ou non classe" and got[4] == "Autre ou non classe"
    assert got[3].startswith("Maladies du sang") and got[5].startswith("Facteurs")
    assert got[6].startswith("Lesions") and got[7].startswith("Maladies de l'oeil")
    assert got[8].startswith("Maladies de l'oreille") and got[9] == "Autre ou non classe"


def test_facility_type_and_sector(spark):
    names = ["CHU de Paris", "CH de Lyon", "Clinique du Parc", "EHPAD Les Pins", "Maison de retraite x",
             "Centre de sante", "Laboratoire Bio", "CCAS Nord", "Conseil departemental", "Autre"]
    got = one_col(spark, names, rules.facility_type)
    assert got == ["CHU", "Hopital Public", "Clinique Privee", "EHPAD", "Maison de Retraite", "Centre de Sante",
                   "Laboratoire", "Centre Communal Action Sociale", "Conseil Departemental", "Autre etablissement"]
    sect = one_col(spark, names, rules.facility_sector)
    assert sect[:4] == ["Public", "Public", "Prive", "Medico-social"]


def test_numeric_bands(spark):
    assert one_col(spark, [2, 3, 7, 8, None], rules.stay_type, "int") == [
        "COURT_SEJOUR", "MOYEN_SEJOUR", "MOYEN_SEJOUR", "LONG_SEJOUR", "NON_RENSEIGNE"]
    assert one_col(spark, [0, 1, 2, 8, 22], rules.stay_class, "int") == [
        "AMBULATOIRE", "COURT_SEJOUR", "SEJOUR_NORMAL", "SEJOUR_LONG", "SEJOUR_TRES_LONG"]
    assert one_col(spark, [0, 1, 18, 19, 66, None], rules.death_age_band, "int") == [
        "MOINS_1_AN", "ENFANT", "ENFANT", "JEUNE_ADULTE", "SENIOR", "NON_RENSEIGNE"]
    assert one_col(spark, [17, 40, 66, None], rules.patient_category, "int") == [
        "PEDIATRIE", "ADULTE", "GERIATRIE", "ADULTE"]
    assert one_col(spark, ["CMU x", "AXA Assurance", "MGEN"], rules.insurer_type) == ["CMU", "Assurance", "Mutuelle"]
    assert one_col(spark, ["Libéral", "Salarie", "Mixte", None], rules.practice_mode) == [
        "Libéral", "Salarié", "Mixte", "Non renseigné"]


def test_calendar_fixture_values(spark):
    c = cal.calendar(spark, as_of="2025-01-01")
    assert c.count() == 5844
    rows = {r.sk_temps: r for r in c.where("sk_temps in (20210103, 20241207, 20250421, 20260101)").collect()}
    assert (rows[20210103].semaine_annee, rows[20210103].jour_semaine) == (53, 7)
    assert (rows[20241207].semaine_annee, rows[20241207].jour_semaine, rows[20241207].est_weekend) == (49, 6, True)
    assert (rows[20250421].semaine_annee, rows[20250421].jour_semaine, rows[20250421].est_ferie) == (17, 1, True)
    assert rows[20260101].est_ferie is False  # T22: holidays stop in 2025
    assert rows[20250421].nom_jour == "Lundi" and rows[20250421].nom_mois == "Avril"
    assert rows[20241207].saison == "Hiver" and rows[20250421].saison == "Printemps"


def test_holidays_count_and_easter(spark):
    h = cal.holidays(spark, 2015, 2025)
    assert h.count() == 88 + 33
    assert h.select("date_ferie").distinct().count() == 121  # no overlap between fixed and movable
    easter_mondays = {r[0] for r in h.where("nom_ferie = 'Lundi de Pâques'").collect()}
    assert dt.date(2016, 3, 28) in easter_mondays and dt.date(2019, 4, 22) in easter_mondays
    assert dt.date(2025, 4, 21) in easter_mondays
    years = spark.range(1900, 2100).select(F.col("id").cast("int").alias("y"))
    e = years.select("y", cal.easter_sunday(F.col("y")).alias("e")).collect()
    assert all(d.e.month in (3, 4) and d.e.weekday() == 6 for d in e)  # always a Sunday in March/April


def test_clocks_and_dates_without_costly_calls(spark):
    """clocks are put together by lpad, and a text without a slash never reaches the slash formats."""
    from carelake.plans.staging import _clock
    rows = [("0:00:00", "13/02/1999"), (" 9:5:07 ", "2/13/1999"), ("23:59:59", " 1999-2-3 "), (None, "garbage"), ("12:00:30", None), ("01:02:03", "1/2/99")]
    df = spark.createDataFrame(rows, "h string, d string").select(_clock("h").alias("h"), parse_date_any("d").cast("string").alias("d"))
    assert [r.h for r in df.collect()] == ["00:00:00", "09:05:07", "23:59:59", None, "12:00:30", "01:02:03"]
    assert [r.d for r in df.collect()] == ["1999-02-13 00:00:00", "1999-02-13 00:00:00", "1999-02-03 00:00:00", None, None, None]
    plan = spark.range(1).select(F.col("id").cast("string").alias("x")).select(_clock("x"), parse_date_any("x"))._jdf.queryExecution().analyzed().toString()
    assert "format_string" not in plan and "contains(" in plan.lower()


def test_consultations_meet_the_diagnoses_where_they_lie(spark, monkeypatch):
    """with dimensions too large to broadcast, the fact's diagnosis lookup moves no consultation again."""
    from carelake.plans import dwh, ods
    monkeypatch.setattr(dwh, "with_surrogate_key", lambda df, name, order: df.withColumn(name, F.lit(1)))
    frame = lambda schema: spark.createDataFrame([], schema)
    cons = frame("num_consultation int, date_consultation date, heure_debut string, heure_fin string, duree_consultation_minutes int, motif string, "
                 "id_patient int, id_professionnel string, code_diagnostic string, id_mut int, loaded_at timestamp").repartition(2)
    pat = frame("id_patient int, nom string, prenom string, sexe string, age int, tranche_age string, ville string, code_postal string, "
                "nom_mutuelle string, type_mutuelle string, a_mutuelle_active boolean").repartition(2)
    pro = frame("identifiant string, nom string, prenom string, profession string, code_specialite string, mode_exercice string").repartition(2)
    diag = frame("code_diagnostic string, libelle_diagnostic string, categorie_cim10 string").repartition(2)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.optimizer.excludedRules")
           if spark.conf.get(k, None) is not None}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.optimizer.excludedRules", "org.apache.spark.sql.catalyst.optimizer.PropagateEmptyRelation,"
                       "org.apache.spark.sql.catalyst.optimizer.ConvertToLocalRelation")
        fact = dwh.fait_consultation(ods.ods_consultation_enrichie(cons, pat, pro, diag), frame("sk_patient long, id_patient int").repartition(2),
                                     frame("sk_professionnel long, identifiant string, fk_organisation long, est_actuel boolean").repartition(2),
                                     frame("sk_diagnostic long, code_diagnostic string").repartition(2), frame("sk_mutuelle long, id_mut int").repartition(2),
                                     frame("sk_temps int, date_complete date"))
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.optimizer.excludedRules"):
            spark.conf.set(k, old[k]) if k in old else spark.conf.unset(k)
    assert plan.count("Exchange hashpartitioning(code_diagnostic") == 2, plan  # the consultations and M23's dimension; the fact's is __diag
