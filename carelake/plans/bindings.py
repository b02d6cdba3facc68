"""Registered queries over the driver's test tables.

Every query reads whole tables (no sampling, no id subsets) and runs the
library's own operators; ``oracles.py`` holds the equivalent DuckDB SQL.
Outputs are aliased and cast to agreed types (T12); load timestamps are left
out so results do not depend on the run.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.functions import calendar as cal
from carelake.functions import rules
from carelake.functions.clean import (age_years, departement, duration_minutes, parse_date_any,
                                      parse_decimal_comma)
from carelake.operators import history, measures, quality
from carelake.operators.align import align, union_all
from carelake.operators.keys import hash_id, lookup, pseudonymize, with_surrogate_key
from carelake.operators.match import containment_lookup, match_person, residual_lookup
from carelake.plans import kpi, marts
from carelake.plans.bound import BoundWarehouse, birth_of, name_of, table
from carelake.sources.io import ingest_csv_tree, normalize_name

AS_OF = dt.datetime(2025, 1, 1)


def _lpad2(c):
    return F.lpad(c.cast("string"), 2, "0")


# --- calendar ---------------------------------------------------------------------------------

def _order_bounds(spark, sf_dir):
    """First and last order day (two scalars)."""
    r = table(spark, sf_dir, "orders").agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"),
                                           F.max(F.col("o_orderdate").cast("date")).alias("hi")).first()
    return r["lo"], r["hi"]


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the order date range + orders per day."""
    lo, hi = _order_bounds(spark, sf_dir)
    days = cal.calendar(spark, lo, hi, lo.year, hi.year, as_of=AS_OF).drop("date_chargement")
    per_day = (table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("__d"))
               .agg(F.count(F.lit(1)).alias("nb_commandes")))
    return (days.join(per_day, days.date_complete == per_day.__d, "left").drop("__d")
            .withColumn("nb_commandes", F.coalesce("nb_commandes", F.lit(0)).cast("bigint")))


def calendar_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holidays of every order year with their order counts."""
    lo, hi = _order_bounds(spark, sf_dir)
    hol = cal.holidays(spark, lo.year, hi.year)
    per_day = (table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("__d"))
               .agg(F.count(F.lit(1)).alias("nb_commandes")))
    return (hol.join(per_day, hol.date_ferie == per_day.__d, "left")
            .select("date_ferie", "nom_ferie", F.year("date_ferie").alias("annee"),
                    rules.is_weekend(F.col("date_ferie")).alias("est_weekend"),
                    F.coalesce("nb_commandes", F.lit(0)).cast("bigint").alias("nb_commandes")))


# --- cleaning expressions over formatted casts --------------------------------------------------

def date_parse_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-first, day-first, ISO and partial dates parsed with first-success-wins."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    y, m, dd = F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    variant = F.pmod(F.col("o_orderkey"), F.lit(4))
    txt = (F.when(variant == 0, F.concat_ws("/", m, dd, y))
            .when(variant == 1, F.concat_ws("/", dd, m, y))
            .when(variant == 2, F.concat_ws("-", y, _lpad2(F.month(d)), _lpad2(F.dayofmonth(d))))
            .otherwise(F.concat_ws("-", y, m)))
    return o.select("o_orderkey", txt.alias("date_texte")) \
            .withColumn("date_parsee", parse_date_any("date_texte").cast("date"))


def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-decimal text back to double."""
    li = table(spark, sf_dir, "lineitem")
    txt = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(","),
                   _lpad2(F.round(F.col("l_discount") * 100).cast("bigint")))
    return li.select("l_orderkey", "l_linenumber", txt.alias("valeur_texte")) \
             .withColumn("valeur", parse_decimal_comma("valeur_texte"))


def age_years_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole years between a customer's stand-in birth date and each order date."""
    o = table(spark, sf_dir, "orders")
    birth = birth_of("o_custkey")
    return o.select("o_orderkey", birth.alias("date_naissance"),
                    F.col("o_orderdate").cast("date").alias("date_commande"),
                    age_years(F.col("o_orderdate").cast("date"), birth).alias("age"))


def _clock_txt(secs):
    return F.concat_ws(":", _lpad2((secs / 3600).cast("int")), _lpad2((F.pmod(secs, F.lit(3600)) / 60).cast("int")),
                       _lpad2(F.pmod(secs, F.lit(60))))


def duration_minutes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 + C04: minutes between two clock times (some cross midnight) and the length class."""
    ev = table(spark, sf_dir, "events")
    start = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts").cast("int")
    end = F.pmod(start + F.pmod(F.col("event_id") * 97, F.lit(86400)), F.lit(86400))
    out = ev.select("event_id", _clock_txt(start).alias("heure_debut"), _clock_txt(end).alias("heure_fin"))
    mins = duration_minutes("heure_debut", "heure_fin")
    return out.withColumn("duree_minutes", mins) \
              .withColumn("duree_categorie", rules.consultation_length("duree_minutes"))


def department_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 + C11: department (Corsica 2A/2B) and region of stand-in postal codes."""
    c = table(spark, sf_dir, "customer")
    cp = F.pmod(F.col("c_custkey") * 7919, F.lit(100000)).cast("string")
    return c.select("c_custkey", cp.alias("code_postal")) \
            .withColumn("departement", departement("code_postal")) \
            .withColumn("region", rules.region_of("departement"))


# --- rule classifiers ------------------------------------------------------------------------

def rule_classify_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered text rules over part names and types."""
    p = table(spark, sf_dir, "part")
    txt = F.concat_ws(" ", "p_name", F.lower("p_type"), "p_brand")
    return p.select("p_partkey", txt.alias("texte"),
                    rules.specialty_category(txt, F.col("p_brand")).alias("categorie_specialite"),
                    rules.facility_type(txt).alias("type_etablissement"),
                    rules.facility_sector(txt).alias("secteur"),
                    rules.insurer_type(txt).alias("type_mutuelle"),
                    rules.practice_mode(txt).alias("mode_exercice"))


def range_classify_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ICD-10 chapter by binary string ranges."""
    p = table(spark, sf_dir, "part")
    catg = F.concat(F.upper(F.substring("p_type", 1, 1)), _lpad2(F.col("p_size")))
    return p.select("p_partkey", catg.alias("categorie_cim10"), rules.icd10_chapter(catg).alias("chapitre_cim10"))


def band_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age bands over the stand-in age (key mod 100)."""
    c = table(spark, sf_dir, "customer")
    age = F.pmod(F.col("c_custkey"), F.lit(100)).cast("int")
    return c.select("c_custkey", age.alias("age"), rules.age_band(age).alias("tranche_age"),
                    rules.death_age_band(age).alias("tranche_age_deces"),
                    rules.patient_category(age).alias("categorie_patient"),
                    rules.mortality_class(age).alias("classe_mortalite"))


def band_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stay classes over the stand-in length (quantity)."""
    li = table(spark, sf_dir, "lineitem")
    days = F.col("l_quantity").cast("int")
    return li.select("l_orderkey", "l_linenumber", days.alias("jours"),
                     rules.stay_type(days).alias("type_sejour"), rules.stay_class(days).alias("classe_sejour"))


def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-name normalisation applied to every page URL."""
    return table(spark, sf_dir, "pages").select("page_id", "url", normalize_name("url").alias("nom_table"))


# --- keys and pseudonyms ----------------------------------------------------------------------

def sk_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense key over one ordering column."""
    return with_surrogate_key(table(spark, sf_dir, "customer"), "sk_patient", ["c_custkey"])


def sk_two_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense key over (order, line); ties broken by every other column."""
    return with_surrogate_key(table(spark, sf_dir, "lineitem"), "sk_fait", ["l_orderkey", "l_linenumber"])


def pseudonym_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8-character pseudonyms and full hashes."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", pseudonymize("c_name").alias("nom_anonyme"),
                    pseudonymize("c_mktsegment").alias("prenom_anonyme"),
                    hash_id(F.concat_ws("|", "c_name", "c_mktsegment")).alias("hash_complet"))


# --- lookups and joins -------------------------------------------------------------------------

def lookup_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays keep only rows whose patient and day exist (inner lookups).

    The calendar stops at 2000-12-31 here, so later stays are dropped (T18).
    """
    wh = BoundWarehouse(spark, sf_dir, cal_end=dt.date(2000, 12, 31))
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    base = li.join(o, li.l_orderkey == o.o_orderkey, "inner").withColumn("__date", F.col("l_shipdate").cast("date"))
    j = lookup(base, wh.dim_patient(), [("o_custkey", "id_patient")], "sk_patient", required=True)
    j = lookup(j, wh.dim_temps(), [("__date", "date_complete")], "sk_temps", required=True, broadcast=True)
    return j.select("l_orderkey", "l_linenumber", "sk_patient", "sk_temps",
                    F.col("l_quantity").cast("int").alias("jour_hospitalisation"))


def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optional lookup of the part among current parts, -1 when absent."""
    p = table(spark, sf_dir, "part").withColumn("est_actuel", F.col("p_retailprice") < 1500)
    dim = with_surrogate_key(p.select("p_partkey", "p_name", "est_actuel"), "sk_diagnostic", ["p_partkey"])
    li = table(spark, sf_dir, "lineitem")
    j = lookup(li, dim.where("est_actuel"), [("l_partkey", "p_partkey")], "sk_diagnostic", required=False)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "sk_diagnostic")


def bridge_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient -> memberships -> insurer with the multiplication kept."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    memberships = (table(spark, sf_dir, "orders")
                   .select(F.col("o_custkey").alias("__cust"), F.col("o_orderpriority").alias("__prio"),
                           F.lit("ACTIF").alias("statut_adhesion")).distinct())
    insurers = with_surrogate_key(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("id_mut"))
                                  .distinct().where(~F.col("id_mut").startswith("5")), "sk_mutuelle", ["id_mut"])
    j = (c.join(memberships, c.c_custkey == memberships.__cust, "left")
         .join(insurers, F.col("__prio") == F.col("id_mut"), "left"))
    return j.select("c_custkey", F.col("__prio").alias("priorite"), "sk_mutuelle", "statut_adhesion",
                    rules.has_active_cover(F.col("sk_mutuelle"), F.col("statut_adhesion")).alias("a_mutuelle_active"))


def residual_like_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays -> customer place, looked up among places typed as establishments."""
    wh = BoundWarehouse(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    base = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    j = residual_lookup(base, wh.dim_localisation(), [("c_nationkey", "id_lieu")], "sk_localisation",
                        right_filter=F.col("types_lieu").contains("Etablissement"))
    return j.select("l_orderkey", "l_linenumber", "c_nationkey", "sk_localisation")


def pseudonym_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths matched to patients on (name pseudonym, first-name pseudonym, birth)."""
    wh = BoundWarehouse(spark, sf_dir)
    ev = table(spark, sf_dir, "events")
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("__ck"), F.col("c_mktsegment").alias("__seg"))
    birth = F.when(F.col("event_type") == "error", F.date_add(birth_of("user_id"), 1)).otherwise(birth_of("user_id"))
    d = (ev.join(cust, ev.user_id == cust.__ck, "left")
         .select("event_id", pseudonymize(name_of("user_id")).alias("nom_anonyme"),
                 pseudonymize("__seg").alias("prenom_anonyme"), birth.cast("timestamp").alias("date_naissance")))
    j = match_person(d, wh.dim_patient(), [("nom_anonyme", "nom_anonyme"), ("prenom_anonyme", "prenom_anonyme"),
                                           ("date_naissance", "date_naissance")], "sk_patient")
    return j.select("event_id", "nom_anonyme", "sk_patient")


def containment_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part codes looked up by containment in three supplier columns, in priority order."""
    s = table(spark, sf_dir, "supplier")
    dim = with_surrogate_key(
        s.select("s_name", (F.col("s_suppkey") * 7919).cast("string").alias("code_secondaire"),
                 F.concat_ws("-", F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string"))
                 .alias("code_juridique"), "s_suppkey"),
        "sk_etablissement", ["s_name"])
    survey = (table(spark, sf_dir, "lineitem")
              .groupBy(F.col("l_partkey").cast("string").alias("finess"), F.year("l_shipdate").alias("annee"))
              .agg(F.sum("l_quantity").cast("bigint").alias("nombre_reponses")))
    found = containment_lookup(survey, "finess", dim, ["s_name", "code_secondaire", "code_juridique"],
                               "sk_etablissement", with_step=True).withColumnRenamed("finess", "__n")
    return (survey.join(found, survey.finess == found.__n, "left")
            .select("finess", "annee", "nombre_reponses", "sk_etablissement", F.col("step").alias("etape")))


# --- marts on the bound warehouse ------------------------------------------------------------------

def _no_load_ts(df: DataFrame) -> DataFrame:
    return df.drop("date_chargement")


def star_mart_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays denormalised over calendar, establishment, diagnosis, patient."""
    wh = BoundWarehouse(spark, sf_dir)
    return _no_load_ts(marts.dm_hospitalisations_analysis(wh.fait_hospitalisation(), wh.dim_temps(),
                                                          wh.dim_etablissement(), wh.dim_diagnostic(),
                                                          wh.dim_patient(), AS_OF))


def star_mart_consultation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consultations denormalised incl. the snowflake specialty."""
    wh = BoundWarehouse(spark, sf_dir)
    return _no_load_ts(marts.dm_consultations_analysis(wh.fait_consultation(), wh.dim_temps(),
                                                       wh.dim_etablissement(), wh.dim_diagnostic(),
                                                       wh.dim_professionnel(), wh.dim_specialite(), AS_OF))


def grains_consultation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consultation detail with four re-attached grains."""
    wh = BoundWarehouse(spark, sf_dir)
    return _no_load_ts(marts.dm_consultations_agregees(wh.fait_consultation(), wh.dim_temps(),
                                                       wh.dim_etablissement(), wh.dim_diagnostic(),
                                                       wh.dim_professionnel(), wh.dim_specialite(),
                                                       wh.dim_patient(), AS_OF))


def grains_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stay detail with four re-attached grains incl. region."""
    wh = BoundWarehouse(spark, sf_dir)
    return _no_load_ts(marts.dm_hospitalisations_agregees(wh.fait_hospitalisation(), wh.dim_temps(),
                                                          wh.dim_etablissement(), wh.dim_diagnostic(),
                                                          wh.dim_patient(), AS_OF))


def region_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths and survey totals per day x region, full outer."""
    wh = BoundWarehouse(spark, sf_dir)
    return _no_load_ts(marts.dm_analyse_territoriale(wh.fait_deces(), wh.fait_satisfaction(), wh.dim_temps(),
                                                     wh.dim_localisation(), wh.dim_patient(),
                                                     wh.dim_etablissement(), AS_OF))


def deaths_region_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths per day x region x department for one year."""
    wh = BoundWarehouse(spark, sf_dir)
    return _no_load_ts(marts.dm_deces_analysis(wh.fait_deces(), wh.dim_temps(), wh.dim_localisation(), AS_OF,
                                               year=2024))


def weighted_region_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey per region for one year, weighted by responses."""
    wh = BoundWarehouse(spark, sf_dir)
    return _no_load_ts(marts.dm_satisfaction_analysis(wh.fait_satisfaction(), wh.dim_etablissement(), AS_OF,
                                                      year=1998))


def survey_union_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two survey shapes aligned by mapping, NULL-padded, unioned."""
    li = table(spark, sf_dir, "lineitem")
    by = li.groupBy("l_suppkey", F.year("l_shipdate").alias("annee_enquete"))
    s48 = by.agg((F.avg("l_discount") * 1000).alias("score_all"), (F.avg("l_tax") * 1000).alias("score_room"),
                 F.sum("l_quantity").cast("bigint").alias("n"))
    sca = by.agg((F.max("l_discount") * 1000).alias("score_all"), (F.min("l_tax") * 1000).alias("score_before"),
                 F.count(F.lit(1)).alias("n"))
    common = {"finess": F.lpad(F.col("l_suppkey").cast("string"), 9, "0"), "annee_enquete": "annee_enquete",
              "score_global": "score_all"}
    m48 = dict(common, type_enquete=F.lit("E-SATIS 48h MCO"), score_chambre="score_room", score_extra_1=None,
               nombre_reponses="n")
    mca = dict(common, type_enquete=F.lit("E-SATIS CA MCO"), score_chambre=None, score_extra_1="score_before",
               nombre_reponses="n")
    types = {"score_chambre": "double", "score_extra_1": "double", "nombre_reponses": "bigint"}
    return union_all([align(s48, m48, types), align(sca, mca, types)])


def place_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places from three sources, distinct types joined, keyed."""
    return BoundWarehouse(spark, sf_dir).dim_localisation()


# --- KPIs ---------------------------------------------------------------------------------------

def _cmart(spark, sf_dir):
    wh = BoundWarehouse(spark, sf_dir)
    return marts.dm_consultations_analysis(wh.fait_consultation(), wh.dim_temps(), wh.dim_etablissement(),
                                           wh.dim_diagnostic(), wh.dim_professionnel(), wh.dim_specialite(), AS_OF)


def _hmart(spark, sf_dir):
    wh = BoundWarehouse(spark, sf_dir)
    return marts.dm_hospitalisations_analysis(wh.fait_hospitalisation(), wh.dim_temps(), wh.dim_etablissement(),
                                              wh.dim_diagnostic(), wh.dim_patient(), AS_OF)


def kpi1_q(spark, sf_dir):
    return kpi.kpi1(_cmart(spark, sf_dir), year=1998, n=10)


def kpi2_q(spark, sf_dir):
    return kpi.kpi2(_cmart(spark, sf_dir), 1996, 1998, n=15)


def kpi3_q(spark, sf_dir):
    return kpi.kpi3(_hmart(spark, sf_dir), since=1998)


def kpi4_q(spark, sf_dir):
    return kpi.kpi4(_hmart(spark, sf_dir), year=1997, n=15)


def kpi5_q(spark, sf_dir):
    return kpi.kpi5(_hmart(spark, sf_dir), year=1998)


def kpi6_q(spark, sf_dir):
    return kpi.kpi6(_cmart(spark, sf_dir), year=1998, n=20)


def kpi7_q(spark, sf_dir):
    wh = BoundWarehouse(spark, sf_dir)
    return kpi.kpi7(marts.dm_deces_analysis(wh.fait_deces(), wh.dim_temps(), wh.dim_localisation(), AS_OF,
                                            year=2024), year=2024)


def kpi8_q(spark, sf_dir):
    wh = BoundWarehouse(spark, sf_dir)
    return kpi.kpi8(marts.dm_satisfaction_analysis(wh.fait_satisfaction(), wh.dim_etablissement(), AS_OF,
                                                   year=1998), year=1998)


def kpi9_q(spark, sf_dir):
    wh = BoundWarehouse(spark, sf_dir)
    return kpi.kpi9(wh.fait_consultation(), wh.dim_professionnel(), wh.dim_specialite(), n=10)


def kpi10_q(spark, sf_dir):
    wh = BoundWarehouse(spark, sf_dir)
    return kpi.kpi10(wh.fait_hospitalisation(), wh.fait_satisfaction(), wh.dim_etablissement())


def kpi11_q(spark, sf_dir):
    wh = BoundWarehouse(spark, sf_dir)
    return kpi.kpi11(wh.fait_satisfaction(), wh.dim_temps())


def kpi12_q(spark, sf_dir):
    """Ranking over the pre-aggregated consultation mart, above a threshold."""
    return kpi.kpi12(grains_consultation(spark, sf_dir), year=1998, threshold=1, n=20)


def kpi13_q(spark, sf_dir):
    """Top specialties of one region over the pre-aggregated consultation mart."""
    return kpi.kpi13(grains_consultation(spark, sf_dir), year=1998, region="EUROPE", n=10)


def kpi12_ambulatory_q(spark, sf_dir):
    """Establishments above a stay threshold with their ambulatory share."""
    return kpi.kpi12_ambulatory(_hmart(spark, sf_dir), year=1998, threshold=50)


# --- windows and aggregates -------------------------------------------------------------------------

def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's share of all stays (aggregated rows only)."""
    g = (_hmart(spark, sf_dir).groupBy("region_etablissement")
         .agg(F.sum("nombre_hospitalisations").cast("bigint").alias("total_hospitalisations")))
    return g.withColumn("pourcentage_total", measures.share_of_total("total_hospitalisations"))


def rank_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions ranked by stay days (ties share a rank)."""
    g = (_hmart(spark, sf_dir).groupBy("region_etablissement", "annee")
         .agg(F.sum("jour_hospitalisation").cast("bigint").alias("jours")))
    return g.withColumn("rang", measures.rank_desc("jours", partition=["annee"]))


def moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer, mean order value over the current and 10 preceding orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return measures.moving_avg_frame(o, "o_totalprice", ["o_custkey"], ["o_orderdate", "o_orderkey"], 10) \
        .select("o_orderkey", "o_custkey", "moyenne_mobile")


def median_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, min / max / mean and occupancy of stay length per establishment."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("int").alias("jours"))
    stats = (li.groupBy("l_suppkey")
             .agg(*measures.stats("jours", "duree"),
                  measures.occupancy(F.sum("jours"), F.count(F.lit(1))).alias("taux_occupation"),
                  measures.share(F.sum(F.when(F.col("jours") > 25, 1).otherwise(0)), F.count(F.lit(1)))
                  .alias("pct_longs")))
    return stats.join(measures.exact_percentiles(li, ["l_suppkey"], "jours", {"duree_mediane": 0.5}), "l_suppkey")


def territorial_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness label, senior share, weighted territorial score and
    satisfaction level per day x region of the territorial mart."""
    t = region_full_outer(spark, sf_dir)
    senior = measures.share(F.col("nb_deces_66_plus"), F.col("nb_deces_region"))
    return t.select("sk_temps", "region",
                    rules.completeness("nb_deces_region", "note_moyenne_satisfaction")
                    .alias("completude_donnees_territoriales"),
                    senior.alias("taux_deces_seniors"),
                    rules.territorial_score("nb_deces_region", senior, "note_moyenne_satisfaction")
                    .alias("score_territorial_global"),
                    F.when(F.col("nb_etablissements_satisfaction") == 0, F.lit(rules.SATISFACTION_NOT_RATED))
                    .otherwise(rules.satisfaction_level("note_moyenne_satisfaction", regional=True))
                    .alias("niveau_satisfaction_regional"))


def coverage_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage zone of stand-in departments and insurer group labels."""
    c = table(spark, sf_dir, "customer")
    cp = F.pmod(F.col("c_custkey") * 7919, F.lit(100000)).cast("string")
    d = c.select("c_custkey", "c_mktsegment", departement(cp).alias("departement"))
    kind = F.upper(rules.insurer_type(F.col("c_mktsegment")))
    return d.select("c_custkey", "departement", rules.region_of("departement").alias("region"),
                    rules.coverage_zone("departement", rules.region_of("departement")).alias("zone_couverture"),
                    rules.insurer_group(kind).alias("categorie_organisme"))


def completeness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of NULLs per column of the stay fact stand-in (one pass)."""
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey", "left")
    with_nulls = li.select("l_orderkey", F.when(F.col("l_quantity") > 45, None).otherwise(F.col("l_quantity"))
                           .alias("qte"), "o_orderpriority", "l_shipdate")
    return measures.completeness_pct(with_nulls, ["qte", "o_orderpriority", "l_shipdate"])


# --- history -----------------------------------------------------------------------------------

def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of each customer's order priority over time."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority",
                                              F.col("o_orderdate").cast("date").alias("jour"))
    h = history.scd2_history(o, ["o_custkey"], ["o_orderpriority"], ["jour", "o_orderkey"], "jour")
    return h.select("o_custkey", "o_orderkey", "o_orderpriority", "numero_version", "date_debut_validite",
                    "date_fin_validite", "est_actuel")


def _customer_dim(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return history.scd2_init(c, dt.date(2024, 1, 1))


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D06 merge: customers whose segment changed get a closed and a new version."""
    current = _customer_dim(spark, sf_dir)
    incoming = (table(spark, sf_dir, "customer")
                .select("c_custkey", F.when(F.pmod("c_custkey", F.lit(7)) == 0, F.lit("CHANGED"))
                        .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), "c_nationkey"))
    merged = history.scd2_merge(current, incoming, ["c_custkey"], ["c_mktsegment", "c_nationkey"],
                                dt.date(2025, 1, 1))
    return merged.select("c_custkey", "c_mktsegment", "c_nationkey", "date_debut_validite", "date_fin_validite",
                         "est_actuel", "numero_version")


def upsert_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-1 upsert of suppliers from a batch of revised balances."""
    s = table(spark, sf_dir, "supplier")
    src = s.where(F.pmod("s_suppkey", F.lit(3)) == 0).withColumn("s_acctbal", F.round(F.col("s_acctbal") + 1, 2))
    return history.upsert(s, src, ["s_suppkey"])


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders not yet in a target loaded up to 1998-01-01."""
    o = table(spark, sf_dir, "orders")
    target = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return history.append_new(target, o, ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))


# --- quality -------------------------------------------------------------------------------------

def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return quality.run_checks([quality.unique(o, "o_orderkey", "orders"),
                               quality.unique(li, ["l_orderkey", "l_linenumber"], "lineitem"),
                               quality.unique(table(spark, sf_dir, "customer"), "c_name", "customer")])


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(table(spark, sf_dir, "lineitem"),
                            ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"], "lineitem")


def dq_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    cheap = p.where(F.col("p_retailprice") < 1500)
    return quality.run_checks([
        quality.relationship(li, "l_partkey", p, "p_partkey", "lineitem"),
        quality.relationship(li, "l_partkey", cheap, "p_partkey", "lineitem_vs_cheap_parts"),
        quality.relationship(table(spark, sf_dir, "labels"), "doc_id", table(spark, sf_dir, "documents"),
                             "doc_id", "labels")])


def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return quality.run_checks([
        quality.in_range(li, "l_quantity", 1, 40, "lineitem"),
        quality.in_range(li, "l_discount", 0.0, 0.08, "lineitem"),
        quality.accepted_values(li, "l_returnflag", ["A", "N"], "lineitem"),
        quality.holds(li, F.col("l_tax") <= F.col("l_discount"), "tax_le_discount", "lineitem"),
        quality.min_rows(table(spark, sf_dir, "nation"), 30, "nation"),
        quality.max_length(table(spark, sf_dir, "customer"), {"c_name": 17, "c_mktsegment": 10}, "customer")])


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts and distinct ids per table."""
    from carelake.operators.align import profile
    names = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey", "part": "p_partkey",
             "supplier": "s_suppkey", "events": "user_id", "documents": "doc_id", "pages": "page_id",
             "conversations": "conv_id", "labels": "doc_id"}
    return profile({n: table(spark, sf_dir, n) for n in names}, names)


def dq_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published-table contract checked on the customer table."""
    from carelake.operators.contract import conform, contract_violations
    spec = [("c_custkey", "bigint", None), ("c_name", "string", 18), ("c_mktsegment", "string", 9),
            ("c_phone", "string", 15)]
    c = table(spark, sf_dir, "customer")
    conform(c, spec[:3])  # raises if a contract column is missing or does not cast
    return contract_violations(c, spec, "customer")


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stay rows whose part is not among the current (cheap) parts."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    cheap = table(spark, sf_dir, "part").where(F.col("p_retailprice") < 1500)
    return quality.orphans(li, cheap, "l_partkey", "p_partkey")


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, line) pairs that occur more than once, with their count."""
    li = table(spark, sf_dir, "lineitem")
    return quality.having(li, ["l_orderkey", "l_linenumber"], F.count(F.lit(1)).alias("nb"), F.col("nb") > 1)


def dq_current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q09: one current version per key after the SCD-2 merge."""
    return quality.one_current(scd2_merge(spark, sf_dir), ["c_custkey"], table="dim_client")


# --- file round trip ------------------------------------------------------------------------------

def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written as a CSV tree in the shared checkpoint
    folder, ingested back to Parquet; returns the load audit (rows per table)."""
    from carelake.session import scratch_path
    root = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    src = os.path.join(root, "src")
    for sub, name in [("Ventes", "orders"), ("Ventes", "lineitem"), ("Référentiel Pièces", "part")]:
        table(spark, sf_dir, name).write.option("header", True).csv(os.path.join(src, sub, f"{name} export.csv"))
    audit = ingest_csv_tree(spark, src, os.path.join(root, "raw"), load_id=1, as_of=AS_OF)
    return audit.select("table_name", "nb_lignes", "statut")


def stream_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D08 with Structured Streaming: orders land as two overlapping file batches
    (the second replays half a year of the first); the file stream appends only
    keys not yet in the year-partitioned target, so the target ends equal to the
    orders table. Files, target and stream checkpoint live in the shared folder."""
    from carelake.session import scratch_path
    from carelake.streaming.incremental import incremental_fact_load
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("jour"), "o_totalprice",
        F.year("o_orderdate").alias("annee"))
    src, target, ckpt = (os.path.join(root, x) for x in ("src", "fait", "ckpt"))
    o.where(F.col("jour") < F.lit(dt.date(1998, 1, 1))).write.parquet(os.path.join(src, "batch1"))
    incremental_fact_load(spark, os.path.join(src, "*"), o.schema, target, ["o_orderkey"], "annee",
                          checkpoint=ckpt)
    o.where(F.col("jour") >= F.lit(dt.date(1997, 7, 1))).write.parquet(os.path.join(src, "batch2"))
    incremental_fact_load(spark, os.path.join(src, "*"), o.schema, target, ["o_orderkey"], "annee",
                          checkpoint=ckpt)
    return spark.read.parquet(target).select("o_orderkey", "o_custkey", F.col("jour").cast("date").alias("jour"),
                                             "o_totalprice", F.col("annee").cast("int").alias("annee"))


QUERIES = {
    "calendar_days": calendar_days,
    "calendar_holidays": calendar_holidays,
    "date_parse_multi": date_parse_multi,
    "decimal_comma": decimal_comma,
    "age_years": age_years_q,
    "duration_minutes": duration_minutes_q,
    "department_code": department_code,
    "rule_classify_part": rule_classify_part,
    "range_classify_type": range_classify_type,
    "band_age": band_age,
    "band_days": band_days,
    "name_normalise": name_normalise,
    "sk_customer": sk_customer,
    "sk_two_key": sk_two_key,
    "pseudonym_customer": pseudonym_customer,
    "lookup_required": lookup_required,
    "lookup_default": lookup_default,
    "bridge_fanout": bridge_fanout,
    "residual_like_join": residual_like_join,
    "pseudonym_match": pseudonym_match,
    "containment_cascade": containment_cascade,
    "star_mart_lineitem": star_mart_lineitem,
    "star_mart_consultation": star_mart_consultation,
    "grains_consultation": grains_consultation,
    "grains_stay": grains_stay,
    "region_full_outer": region_full_outer,
    "deaths_region_day": deaths_region_day,
    "weighted_region_score": weighted_region_score,
    "survey_union_align": survey_union_align,
    "place_consolidated": place_consolidated,
    "kpi1": kpi1_q,
    "kpi2": kpi2_q,
    "kpi3": kpi3_q,
    "kpi4": kpi4_q,
    "kpi5": kpi5_q,
    "kpi6": kpi6_q,
    "kpi7": kpi7_q,
    "kpi8": kpi8_q,
    "kpi9": kpi9_q,
    "kpi10": kpi10_q,
    "kpi11": kpi11_q,
    "kpi12": kpi12_q,
    "kpi13": kpi13_q,
    "kpi12_ambulatory": kpi12_ambulatory_q,
    "territorial_scores": territorial_scores,
    "coverage_zone": coverage_zone,
    "completeness_profile": completeness_profile,
    "share_of_total": share_of_total,
    "rank_region": rank_region,
    "moving_avg": moving_avg,
    "median_stay": median_stay,
    "scd2_history": scd2_history,
    "scd2_merge": scd2_merge,
    "upsert_dim": upsert_dim,
    "incremental_append": incremental_append,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_relationship": dq_relationship,
    "dq_range": dq_range,
    "dq_profile": dq_profile,
    "dq_current_version": dq_current_version,
    "dq_contract": dq_contract,
    "dq_orphans": dq_orphans,
    "dq_duplicates": dq_duplicates,
    "csv_roundtrip": csv_roundtrip,
    "stream_incremental_load": stream_incremental_load,
}
