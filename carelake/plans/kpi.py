"""User-facing KPI queries (K1-K13) over the marts and the warehouse.

Top-N queries break ties on their group keys so the result is a total order
(O02); global ranks and shares of total run on aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.operators.measures import order, per_workday, rank_desc, ratio, share_of_total, top_n


def kpi1(mart: DataFrame, year: int = 2023, n: int = 10) -> DataFrame:
    """K1: consultations, unique patients and rate per establishment-month; top n."""
    g = (mart.where((F.col("annee") == year) & F.col("nom_etablissement").isNotNull())
         .groupBy("annee", "mois", "nom_etablissement", "region_etablissement")
         .agg(F.sum("nombre_consultations").cast("bigint").alias("total_consultations"),
              F.count_distinct("sk_patient").alias("patients_uniques")))
    g = g.withColumn("taux_consultation", ratio(F.col("total_consultations"), F.col("patients_uniques"), 2))
    return top_n(g, [F.col("total_consultations").desc(), F.col("mois").asc(),
                     F.col("nom_etablissement").asc(), F.col("region_etablissement").asc_nulls_last()], n)


def kpi2(mart: DataFrame, y0: int = 2021, y1: int = 2023, n: int = 15) -> DataFrame:
    """K2: consultations and establishments per diagnosis-quarter; top n."""
    g = (mart.where(F.col("annee").between(y0, y1) & F.col("categorie_diagnostic").isNotNull())
         .groupBy("annee", "trimestre", "categorie_diagnostic", "libelle_diagnostic")
         .agg(F.sum("nombre_consultations").cast("bigint").alias("consultations_totales"),
              F.count_distinct("sk_etablissement").alias("nb_etablissements")))
    return top_n(g, [F.col("consultations_totales").desc(), F.col("annee"), F.col("trimestre"),
                     F.col("categorie_diagnostic"), F.col("libelle_diagnostic").asc_nulls_last()], n)


def kpi3(mart: DataFrame, since: int = 2020) -> DataFrame:
    """K3: stays, mean length, establishments and patients per month since a year."""
    rows = mart.where(F.col("annee") >= since)
    month = ["annee", "mois"]
    # two distinct counts in one aggregate would write each row three times before the shuffle;
    # apart, each keeps one partial row per (month, value), and the months, a few rows each, meet again
    places = rows.groupBy(*month).agg(F.sum("nombre_hospitalisations").cast("bigint").alias("hospitalisations_totales"),
                                      F.avg("jour_hospitalisation").alias("duree_moyenne_jours"),
                                      F.count_distinct("sk_etablissement").alias("nb_etablissements"))
    people = rows.groupBy(*month).agg(F.count_distinct("sk_patient").alias("patients_hospitalises"))
    same = places["annee"].eqNullSafe(people["annee"]) & places["mois"].eqNullSafe(people["mois"])
    g = places.join(people, same, "inner").drop(people["annee"], people["mois"])
    return order(g, ["annee", "mois"])  # O03


def kpi4(mart: DataFrame, year: int = 2016, n: int = 15) -> DataFrame:
    """K4: stays per diagnosis with min / mean / max length; top n."""
    g = (mart.where((F.col("annee") == year) & F.col("libelle_diagnostic").isNotNull())
         .groupBy("annee", "code_diagnostic", "libelle_diagnostic")
         .agg(F.sum("nombre_hospitalisations").cast("bigint").alias("nb_hospitalisations"),
              F.avg("jour_hospitalisation").alias("duree_moyenne_jours"),
              F.min("jour_hospitalisation").alias("duree_min_jours"),
              F.max("jour_hospitalisation").alias("duree_max_jours"),
              F.count_distinct("sk_etablissement").alias("nb_etablissements_concernes")))
    return top_n(g, [F.col("nb_hospitalisations").desc(), F.col("code_diagnostic").asc_nulls_last(),
                     F.col("libelle_diagnostic")], n)


def kpi5(mart: DataFrame, year: int = 2020) -> DataFrame:
    """K5: stays by sex x age band with the share of the year's total."""
    g = (mart.where((F.col("annee") == year) & F.col("sexe").isNotNull() & F.col("tranche_age").isNotNull())
         .groupBy("annee", "sexe", "tranche_age")
         .agg(F.sum("nombre_hospitalisations").cast("bigint").alias("total_hospitalisations"),
              F.avg("jour_hospitalisation").alias("duree_moyenne_jours"),
              F.count_distinct("sk_patient").alias("patients_uniques")))
    return (g.withColumn("pourcentage_total", share_of_total("total_hospitalisations"))
            .orderBy("total_hospitalisations", "sexe", "tranche_age"))


def kpi6(mart: DataFrame, year: int = 2023, n: int = 20) -> DataFrame:
    """K6: professional workload with a per-working-day rate (A13); groups also
    by establishment like the reference; top n."""
    g = (mart.where((F.col("annee") == year) & F.col("profession").isNotNull())
         .groupBy("annee", "sk_professionnel", "profession", "specialite", "nom_etablissement")
         .agg(F.sum("nombre_consultations").cast("bigint").alias("consultations_totales"),
              F.count_distinct("sk_patient").alias("patients_suivis"),
              F.avg("duree_consultation").alias("duree_moyenne_min")))
    g = g.withColumn("consultations_par_jour_ouvre", per_workday(F.col("consultations_totales")))
    return top_n(g, [F.col("consultations_totales").desc(), F.col("sk_professionnel"),
                     F.col("nom_etablissement").asc_nulls_last()], n).drop("nom_etablissement")


def kpi7(mart: DataFrame, year: int = 2019) -> DataFrame:
    """K7: deaths by region with the national rank."""
    g = (mart.where((F.col("annee") == year) & F.col("region").isNotNull())
         .groupBy("annee", "region")
         .agg(F.sum("nb_deces_departement").cast("bigint").alias("nombre_deces_total")))
    return (g.withColumn("rang_national", rank_desc("nombre_deces_total"))
            .orderBy(F.col("nombre_deces_total").desc(), "region"))


def kpi8(mart: DataFrame, year: int = 2020) -> DataFrame:
    """K8: regional satisfaction with the national rank (W05; GROUP BY = distinct)."""
    cols = ["annee", "region", "nb_etablissements_region", "nb_reponses_totales_region",
            "taux_satisfaction_moyen_region", "taux_recommandation_moyen_region", "note_min_region",
            "note_max_region", "note_moyenne_simple_region"]
    g = mart.where((F.col("annee") == year) & F.col("region").isNotNull()).select(*cols).distinct()
    return (g.select("annee", "region", "nb_etablissements_region", "nb_reponses_totales_region",
                     F.col("taux_satisfaction_moyen_region").alias("score_satisfaction_global"),
                     F.col("taux_recommandation_moyen_region").alias("taux_recommandation"),
                     F.col("note_min_region").alias("score_min"), F.col("note_max_region").alias("score_max"),
                     F.col("note_moyenne_simple_region").alias("score_moyen"),
                     rank_desc("taux_satisfaction_moyen_region").alias("rang_national"))
            .orderBy(F.col("score_satisfaction_global").desc_nulls_last(), "region"))


def kpi9(fc: DataFrame, d_pro: DataFrame, d_spec: DataFrame, n: int = 10) -> DataFrame:
    """K9: most active specialty categories (snowflake walk J09)."""
    p = d_pro.where(F.col("est_actuel")).select("sk_professionnel", "fk_specialite")
    s = d_spec.select(F.col("sk_specialite").alias("fk_specialite"), "categorie")
    g = (fc.join(p, "sk_professionnel").join(s, "fk_specialite")
         .groupBy("categorie").agg(F.count(F.lit(1)).alias("consultation_count"),
                                   F.avg("duree_consultation").alias("avg_duration")))
    return top_n(g, [F.col("consultation_count").desc(), F.col("categorie")], n)


def kpi10(fh: DataFrame, fs: DataFrame, d_etab: DataFrame) -> DataFrame:
    """Length of stay vs satisfaction by region.

    The documented query joins two facts through the establishment, multiplying
    stays by surveys; each fact is aggregated per establishment first, then
    weighted back so the figures equal the documented join's.
    """
    stays = fh.groupBy("sk_etablissement").agg(F.sum("jour_hospitalisation").alias("__days"),
                                               F.count(F.lit(1)).alias("__stays"))
    sat = fs.groupBy("sk_etablissement").agg(F.count(F.lit(1)).alias("__n_s"),
                                             F.count("score_global").alias("__n_score"),
                                             F.sum("score_global").alias("__sum_score"))
    e = d_etab.select("sk_etablissement", "region")
    j = stays.join(e, "sk_etablissement").join(sat, "sk_etablissement", "left")
    mult = F.greatest(F.coalesce(F.col("__n_s"), F.lit(0)), F.lit(1))  # left join keeps unmatched stays once
    g = j.groupBy("region").agg(
        (F.sum(F.col("__days") * mult) / F.sum(F.col("__stays") * mult)).alias("avg_los"),
        F.sum(F.col("__stays") * mult).alias("total_stays"),
        (F.sum(F.col("__sum_score") * F.col("__stays"))
         / F.sum(F.col("__n_score") * F.col("__stays"))).alias("satisfaction_score"))
    return g.orderBy(F.col("avg_los").desc(), "region")


def kpi11(fs: DataFrame, d_temps: DataFrame) -> DataFrame:
    """Satisfaction trend per quarter (survey day = January 1st of its year, T19)."""
    t = d_temps.select("sk_temps", F.col("annee").alias("year"), F.col("trimestre").alias("quarter"))
    return (fs.withColumn("sk_temps", (F.col("annee_enquete") * 10000 + 101).cast("bigint"))
            .join(t, "sk_temps")
            .groupBy("year", "quarter")
            .agg(F.avg("score_global").alias("avg_satisfaction"),
                 F.count_distinct("sk_etablissement").alias("facilities_surveyed"))
            .orderBy("year", "quarter"))


def kpi12(mart: DataFrame, year: int = 2024, threshold: int = 100, n: int = 20) -> DataFrame:
    """Ranking over the pre-aggregated consultation mart with a threshold."""
    g = (mart.where((F.col("annee") == year) & (F.col("nb_consultations_professionnel") > threshold))
         .select("region_etablissement", "specialite", "nb_consultations_professionnel",
                 (F.col("duree_totale_professionnel") / F.col("nb_consultations_professionnel"))
                 .alias("duree_moyenne_professionnel"),
                 "nb_patients_uniques_professionnel", "sk_professionnel", "sk_temps").distinct())
    return top_n(g, [F.col("nb_consultations_professionnel").desc(), F.col("sk_professionnel"),
                     F.col("sk_temps")], n)


def kpi12_ambulatory(mart: DataFrame, year: int = 2024, threshold: int = 50) -> DataFrame:
    """Establishments above a stay threshold with their ambulatory share."""
    g = (mart.where(F.col("annee") == year)
         .groupBy("nom_etablissement", "region_etablissement")
         .agg(F.sum("nombre_hospitalisations").alias("total_hospitalisations_etablissement"),
              F.avg("jour_hospitalisation").alias("duree_moyenne_etablissement"),
              F.sum(F.when(F.col("jour_hospitalisation") == 0, F.col("nombre_hospitalisations"))
                    .otherwise(0)).alias("nb_ambulatoire")))
    return (g.where(F.col("total_hospitalisations_etablissement") > threshold)
            .withColumn("pct_ambulatoire", F.col("nb_ambulatoire") * 100.0
                        / F.col("total_hospitalisations_etablissement"))
            .orderBy(F.col("duree_moyenne_etablissement").desc(), "nom_etablissement"))


def kpi13(mart: DataFrame, year: int = 2024, region: str | None = None, n: int = 10) -> DataFrame:
    """Top specialties, optionally restricted to one region."""
    m = mart.where(F.col("annee") == year)
    if region is not None:
        m = m.where(F.col("region_etablissement") == region)
    g = m.groupBy("specialite").agg(F.sum("nb_consultations_professionnel").alias("total"))
    return top_n(g, [F.col("total").desc(), F.col("specialite").asc_nulls_last()], n)
