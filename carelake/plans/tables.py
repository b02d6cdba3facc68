"""Registered queries of the table mechanisms: bucketed merges, distinct counts that roll up, exact percentiles by
counting, containment with priorities. Each has its DuckDB SQL beside it."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators import distinct, history, measures, suite
from carelake.operators.keys import lookup_report, with_surrogate_key
from carelake.operators.match import containment_lookup
from carelake.plans.bound import BoundWarehouse, table
from carelake.session import pin, scratch_path
from carelake.sources.bucketed import BucketedTable
from carelake.sources.fileindex import IndexedTable
from carelake.sources.io import read_layer, write_layer
from carelake.streaming.incremental import incremental_fact_load

ATTRS = ["segment", "nation"]


def _customers(spark, sf_dir, segment=None) -> DataFrame:
    """Customers with a two-part key whose first part is NULL for every 50th."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k, F.when(k % 50 != 0, k).alias("cle_a"), F.col("c_name").alias("cle_b"),
        (F.col("c_mktsegment") if segment is None else segment).alias("segment"), F.col("c_nationkey").alias("nation"))


def bucketed_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed customer dimension after a delta (1 % of keys changed, NULL key parts among them, some new) and a full
    snapshot in which another 1 % changed; both merges rewrite the buckets of changed keys only."""
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    dim = BucketedTable(spark, scratch_path(spark, f"tables-{uuid.uuid4().hex}"), "dwh", "dim_client", ["cle_a", "cle_b"], buckets=64)
    first = history.scd2_init(_customers(spark, sf_dir).where(k % 211 != 3).drop("c_custkey"), dt.date(2024, 1, 1))
    dim.create(first.withColumns({history.HASH: history.attribute_hash(ATTRS), history.VERSION: F.lit(1)}))
    now = F.when(k % 100 == 0, F.lit("CHANGED-1")).otherwise(seg)
    delta = _customers(spark, sf_dir, now).where((k % 100 == 0) | (k % 211 == 3)).drop("c_custkey")
    dim.scd2_merge(delta, ATTRS, dt.date(2024, 6, 1))
    later = F.when(k % 100 == 1, F.lit("CHANGED-2")).otherwise(now)
    dim.scd2_merge(_customers(spark, sf_dir, later).drop("c_custkey"), ATTRS, dt.date(2025, 1, 1))
    return dim.read().select("cle_a", "cle_b", *ATTRS, "date_debut_validite", "date_fin_validite", "est_actuel", "numero_version")


_BUCKETED_SCD2 = """
WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS cle_a, c_name AS cle_b, c_mktsegment AS s,
                  c_nationkey AS nation, CASE WHEN c_custkey % 211 = 3 THEN DATE '2024-06-01' ELSE DATE '2024-01-01' END AS d FROM customer),
v AS (
  SELECT k, cle_a, cle_b, CASE WHEN k % 100 = 0 AND k % 211 = 3 THEN 'CHANGED-1' ELSE s END AS segment, nation, d AS date_debut_validite,
         CASE WHEN k % 100 = 0 AND k % 211 <> 3 THEN DATE '2024-05-31' WHEN k % 100 = 1 THEN DATE '2024-12-31' END AS date_fin_validite,
         1 AS numero_version FROM c
  UNION ALL SELECT k, cle_a, cle_b, 'CHANGED-1', nation, DATE '2024-06-01', NULL, 2 FROM c WHERE k % 100 = 0 AND k % 211 <> 3
  UNION ALL SELECT k, cle_a, cle_b, 'CHANGED-2', nation, DATE '2025-01-01', NULL, 2 FROM c WHERE k % 100 = 1)
SELECT cle_a, cle_b, segment, nation, date_debut_validite, date_fin_validite, date_fin_validite IS NULL AS est_actuel, numero_version FROM v"""


def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-1 upsert of every 50th key (first key part NULL) and of new keys into a bucketed table."""
    k = F.col("c_custkey")
    dim = BucketedTable(spark, scratch_path(spark, f"tables-{uuid.uuid4().hex}"), "dwh", "dim_client", ["cle_a", "cle_b"], buckets=64)
    dim.create(_customers(spark, sf_dir).where(k % 211 != 3).drop("c_custkey"))
    dim.upsert(_customers(spark, sf_dir, F.lit("REVISED")).where((k % 50 == 0) | (k % 211 == 3)).drop("c_custkey"))
    return dim.read()


_BUCKETED_UPSERT = """
SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS cle_a, c_name AS cle_b,
       CASE WHEN c_custkey % 50 = 0 OR c_custkey % 211 = 3 THEN 'REVISED' ELSE c_mktsegment END AS segment, c_nationkey AS nation
FROM customer"""


def unique_patients_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct patients per region and month, quarter and year, and per year over all regions: bitmap states of the
    days, merged upwards; the stays are read once."""
    wh = BoundWarehouse(spark, sf_dir)
    place = wh.dim_etablissement().select("sk_etablissement", "region")
    stays = wh.fait_hospitalisation().join(place, "sk_etablissement").select(
        (F.col("sk_temps") / 100).cast("int").alias("ym"), "sk_temps", "region", "sk_patient")
    days = pin(distinct.distinct_state(stays, ["sk_temps", "ym", "region"], "sk_patient"), "day-states")
    ym = F.col("ym")
    months = distinct.roll_up(days, ["ym", "region"]).withColumns({
        "annee": F.floor(ym / 100).cast("int"), "mois": (ym % 100).cast("int"), "trimestre": F.floor((ym % 100 + 2) / 3).cast("int")})
    months = pin(months, "month-states")
    quarters = distinct.roll_up(months, ["annee", "trimestre", "region"])
    years = distinct.roll_up(quarters, ["annee", "region"])
    levels = [("mois", months, ["annee", "trimestre", "mois", "region"]), ("trimestre", quarters, ["annee", "trimestre", "region"]),
              ("annee", years, ["annee", "region"]), ("total", distinct.roll_up(years, ["annee"]), ["annee"])]
    out = None
    for name, state, keys in levels:
        counted = distinct.count_members(state, keys, "nb_patients_uniques").select(F.lit(name).alias("niveau"), *[
            (F.col(c) if c in keys else F.lit(None)).cast("string" if c == "region" else "int").alias(c)
            for c in ("annee", "trimestre", "mois", "region")], "nb_patients_uniques")
        out = counted if out is None else out.unionByName(counted)
    return out


_UNIQUE_PATIENTS_ROLLUP = """
WITH s AS (SELECT year(l_shipdate)::INTEGER AS annee, quarter(l_shipdate)::INTEGER AS trimestre, month(l_shipdate)::INTEGER AS mois,
                  r_name AS region, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT CASE WHEN grouping(mois) = 0 THEN 'mois' WHEN grouping(trimestre) = 0 THEN 'trimestre' WHEN grouping(region) = 0 THEN 'annee'
            ELSE 'total' END AS niveau, annee, trimestre, mois, region, count(DISTINCT o_custkey)::BIGINT AS nb_patients_uniques
FROM s GROUP BY GROUPING SETS ((annee, trimestre, mois, region), (annee, trimestre, region), (annee, region), (annee))"""


def percentiles_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles and 90th percentile of prices per return flag: three groups that hold all rows."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return measures.exact_percentiles(li, ["l_returnflag"], "l_extendedprice", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9})


_PERCENTILES_PRICE = "SELECT l_returnflag, " + ", ".join(
    f"quantile_cont(l_extendedprice::DOUBLE, {p / 100}) AS p{p}" for p in (25, 50, 75, 90)) + " FROM lineitem GROUP BY l_returnflag"


def containment_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needles that resolve in each of the three columns and in none: 9-digit codes, short codes, hyphenated codes, the empty
    needle and NULL."""
    s = table(spark, sf_dir, "supplier")
    k, secondary, legal = F.col("s_suppkey"), (F.col("s_suppkey") * 7919).cast("string"), F.concat_ws(
        "-", F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string"))
    dim = with_surrogate_key(s.select("s_name", secondary.alias("code_secondaire"), legal.alias("code_juridique"), "s_suppkey"),
                             "sk_etablissement", ["s_name"])
    needles = s.select(F.explode(F.array(F.lpad(k.cast("string"), 9, "0"), secondary, legal, F.concat(F.lit("#"), k.cast("string")),
                                         F.concat(legal, F.lit("-x")), F.lit(""), F.lit(None))).alias("finess")).distinct()
    return containment_lookup(needles, "finess", dim, ["s_name", "code_secondaire", "code_juridique"], "sk_etablissement",
                              with_step=True).withColumnRenamed("step", "etape")


_CONTAINMENT_PRIORITIES = """
WITH d AS (SELECT row_number() OVER (ORDER BY s_name) AS sk, s_name AS c1, (s_suppkey * 7919)::VARCHAR AS c2,
                  s_nationkey::VARCHAR || '-' || s_suppkey::VARCHAR AS c3, s_suppkey AS k FROM supplier),
n AS (SELECT DISTINCT unnest([lpad(k::VARCHAR, 9, '0'), c2, c3, '#' || k::VARCHAR, c3 || '-x', '', NULL]) AS finess FROM d),
h AS (SELECT sk, 1 AS etape, c1 AS c FROM d UNION ALL SELECT sk, 2, c2 FROM d UNION ALL SELECT sk, 3, c3 FROM d),
m AS (SELECT finess, min((etape, sk)) AS b FROM n JOIN h ON contains(h.c, n.finess) GROUP BY finess)
SELECT n.finess, coalesce(m.b[2], -1)::BIGINT AS sk_etablissement, coalesce(m.b[1], -1)::INTEGER AS etape
FROM n LEFT JOIN m ON n.finess = m.finess"""


# --- declared checks -------------------------------------------------------------------------------

def _planted(spark, sf_dir) -> dict[str, DataFrame]:
    """Test tables with failures of every kind: NULLs, repeated keys, orphans, values and ranges, two current versions."""
    c, o, li = (table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem"))
    k, ok = F.col("c_custkey"), F.col("o_orderkey")
    clients = c.select(F.when(k % 97 != 5, k).alias("c_custkey"), F.when(k % 10 == 3, F.lit("Customer#000000001")).otherwise(F.col("c_name")).alias("c_name"),
                       "c_mktsegment", "c_nationkey", F.floor(k / 2).alias("paire"), (k % 3 != 0).alias("est_actuel"))
    orders = o.select(ok, F.when(ok % 50 == 1, F.col("o_custkey") + 10000000).otherwise(F.col("o_custkey")).alias("o_custkey"), "o_totalprice")
    lines = li.select("l_orderkey", F.when(F.col("l_linenumber") == 7, 6).otherwise(F.col("l_linenumber")).alias("l_linenumber"), "l_returnflag",
                      "l_quantity", "l_discount", "l_tax", F.when(F.col("l_suppkey") % 9 != 0, F.col("l_suppkey")).alias("l_suppkey"))
    return {"customer": clients, "orders": orders, "lineitem": lines, "supplier": table(spark, sf_dir, "supplier").where("s_suppkey % 10 <> 4"),
            "nation": table(spark, sf_dir, "nation")}


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks of five tables in one pass each, with planted failures."""
    return suite.run(_planted(spark, sf_dir), [
        suite.not_null("customer", "c_custkey", "c_name", "c_mktsegment"), suite.not_null("lineitem", "l_orderkey", "l_suppkey"),
        suite.unique("customer", "c_custkey"), suite.unique("customer", "c_name"), suite.unique("orders", "o_orderkey"),
        suite.unique("lineitem", "l_orderkey", "l_linenumber"), suite.one_current("customer", "paire"),
        suite.accepted_values("lineitem", "l_returnflag", ["A", "N"]), suite.in_range("lineitem", "l_quantity", 2, 45),
        suite.holds("lineitem", "tax_le_discount", lambda: F.col("l_tax") <= F.col("l_discount")),
        suite.relationship("orders", "o_custkey", "customer", "c_custkey"), suite.relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
        suite.relationship("lineitem", "l_suppkey", "supplier", "s_suppkey"), suite.relationship("customer", "c_nationkey", "nation", "n_nationkey")])


_DQ_SUITE = """
WITH customer_ AS (SELECT CASE WHEN c_custkey % 97 <> 5 THEN c_custkey END AS c_custkey,
                          CASE WHEN c_custkey % 10 = 3 THEN 'Customer#000000001' ELSE c_name END AS c_name, c_mktsegment, c_nationkey,
                          floor(c_custkey / 2) AS paire, c_custkey % 3 <> 0 AS est_actuel FROM customer),
orders_ AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 1 THEN o_custkey + 10000000 ELSE o_custkey END AS o_custkey FROM orders),
lineitem_ AS (SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN 6 ELSE l_linenumber END AS l_linenumber, l_returnflag, l_quantity, l_discount,
                     l_tax, CASE WHEN l_suppkey % 9 <> 0 THEN l_suppkey END AS l_suppkey FROM lineitem),
supplier_ AS (SELECT * FROM supplier WHERE s_suppkey % 10 <> 4),
f(check_name, table_name, column_name, failures) AS (
  SELECT 'not_null', 'customer', 'c_custkey', (SELECT count(*) FROM customer_ WHERE c_custkey IS NULL)
  UNION ALL SELECT 'not_null', 'customer', 'c_name', (SELECT count(*) FROM customer_ WHERE c_name IS NULL)
  UNION ALL SELECT 'not_null', 'customer', 'c_mktsegment', (SELECT count(*) FROM customer_ WHERE c_mktsegment IS NULL)
  UNION ALL SELECT 'not_null', 'lineitem', 'l_orderkey', (SELECT count(*) FROM lineitem_ WHERE l_orderkey IS NULL)
  UNION ALL SELECT 'not_null', 'lineitem', 'l_suppkey', (SELECT count(*) FROM lineitem_ WHERE l_suppkey IS NULL)
  UNION ALL SELECT 'unique', 'customer', 'c_custkey', (SELECT count(*) FROM (SELECT c_custkey FROM customer_ WHERE c_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'unique', 'customer', 'c_name', (SELECT count(*) FROM (SELECT c_name FROM customer_ GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'unique', 'orders', 'o_orderkey', (SELECT count(*) FROM (SELECT o_orderkey FROM orders_ GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'unique_combination', 'lineitem', 'l_orderkey,l_linenumber', (SELECT count(*) FROM (SELECT 1 FROM lineitem_ GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
  UNION ALL SELECT 'one_current_version', 'customer', 'paire', (SELECT count(*) FROM (SELECT paire FROM customer_ WHERE est_actuel GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'accepted_values', 'lineitem', 'l_returnflag', (SELECT count(*) FROM lineitem_ WHERE l_returnflag NOT IN ('A', 'N'))
  UNION ALL SELECT 'accepted_range', 'lineitem', 'l_quantity', (SELECT count(*) FROM lineitem_ WHERE l_quantity < 2 OR l_quantity > 45)
  UNION ALL SELECT 'holds:tax_le_discount', 'lineitem', NULL, (SELECT count(*) FROM lineitem_ WHERE NOT l_tax <= l_discount)
  UNION ALL SELECT 'relationship', 'orders', 'o_custkey', (SELECT count(*) FROM orders_ WHERE o_custkey NOT IN (SELECT c_custkey FROM customer_ WHERE c_custkey IS NOT NULL))
  UNION ALL SELECT 'relationship', 'lineitem', 'l_orderkey', (SELECT count(*) FROM lineitem_ WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders_))
  UNION ALL SELECT 'relationship', 'lineitem', 'l_suppkey', (SELECT count(*) FROM lineitem_ WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier_))
  UNION ALL SELECT 'relationship', 'customer', 'c_nationkey', (SELECT count(*) FROM customer_ WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)))
SELECT *, failures = 0 AS passed FROM f"""


def lookup_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three lookups do: misses and NULL keys, a dimension with duplicate keys, a filtered dimension."""
    t = _planted(spark, sf_dir)
    twice = t["nation"].unionByName(t["nation"].where("n_nationkey % 5 = 2"))
    return (lookup_report("orders -> customer", t["orders"], t["customer"], [("o_custkey", "c_custkey")])
            .unionByName(lookup_report("lineitem -> supplier", t["lineitem"], t["supplier"], [("l_suppkey", "s_suppkey")],
                                       right_filter=F.col("s_acctbal") > 0))
            .unionByName(lookup_report("customer -> nation", t["customer"], twice, [("c_nationkey", "n_nationkey")])))


_LOOKUP_REPORTS = """
WITH o AS (SELECT CASE WHEN o_orderkey % 50 = 1 THEN o_custkey + 10000000 ELSE o_custkey END AS k FROM orders),
c AS (SELECT c_custkey AS k, count(*) AS n FROM customer WHERE c_custkey % 97 <> 5 GROUP BY 1),
l AS (SELECT CASE WHEN l_suppkey % 9 <> 0 THEN l_suppkey END AS k FROM lineitem),
s AS (SELECT s_suppkey AS k, count(*) AS n FROM supplier WHERE s_suppkey % 10 <> 4 AND s_acctbal > 0 GROUP BY 1),
p AS (SELECT c_nationkey AS k FROM customer),
d AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 5 = 2 THEN 2 ELSE 1 END AS n FROM nation),
j AS (SELECT 'orders -> customer' AS lookup, o.k, coalesce(n, 0) AS n FROM o LEFT JOIN c ON o.k = c.k
      UNION ALL SELECT 'lineitem -> supplier', l.k, coalesce(n, 0) FROM l LEFT JOIN s ON l.k = s.k
      UNION ALL SELECT 'customer -> nation', p.k, coalesce(n, 0) FROM p LEFT JOIN d ON p.k = d.k)
SELECT lookup, count(*) AS fact_rows, count(*) FILTER (n > 0) AS matched, count(*) FILTER (n = 0) AS missed, count(*) FILTER (k IS NULL) AS null_keys,
       count(*) FILTER (n > 1) AS multiplied, coalesce(sum(n - 1) FILTER (n > 1), 0)::BIGINT AS extra_rows,
       CASE WHEN lookup = 'customer -> nation' THEN (SELECT count(*) FROM d WHERE n > 1) ELSE 0 END AS duplicate_keys
FROM j GROUP BY lookup"""


# --- partitioned storage -----------------------------------------------------------------------------

def partitioned_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays stored by year and month, patients by sex and age band, read back: the stays through a star join
    that prunes their partitions at run time (the calendar's second quarter), the patients by one folder of each level."""
    root = scratch_path(spark, f"layers-{uuid.uuid4().hex}")
    li = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    stays = li.select("l_orderkey", "l_quantity", day.alias("jour"), F.year(day).alias("annee"), F.month(day).alias("mois"))
    write_layer(stays, root, "dwh", "stays", partition_by=["annee", "mois"], sort_within=["jour"])
    k = F.col("c_custkey")
    people = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 2 == 0, "M").otherwise("F").alias("sexe"),
                                                     F.concat(F.lit("b"), (k % 5).cast("string")).alias("bande"))
    write_layer(people, root, "dwh", "people", partition_by=["sexe", "bande"])
    stored = read_layer(spark, root, "dwh", "stays")
    months = (table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("annee"), F.month("o_orderdate").alias("mois"),
                                                    F.quarter("o_orderdate").alias("trimestre")).where("trimestre = 2")
              .groupBy("annee", "mois").agg(F.max("trimestre").alias("trimestre")))
    q2 = (stored.join(months, ["annee", "mois"]).groupBy("annee", "mois")
          .agg(F.count(F.lit(1)).alias("nb"), F.sum("l_quantity").cast("bigint").alias("total"))
          .select(F.lit("stays").alias("table_name"), F.col("annee").cast("string").alias("niveau_1"), F.col("mois").cast("string").alias("niveau_2"), "nb", "total"))
    p = (read_layer(spark, root, "dwh", "people").where("sexe = 'M'").groupBy("sexe", "bande")
         .agg(F.count(F.lit(1)).alias("nb"), F.sum("c_custkey").cast("bigint").alias("total"))
         .select(F.lit("people").alias("table_name"), F.col("sexe").alias("niveau_1"), F.col("bande").alias("niveau_2"), "nb", "total"))
    return q2.unionByName(p)


_PARTITIONED_STORAGE = """
SELECT 'stays' AS table_name, year(l_shipdate)::VARCHAR AS niveau_1, month(l_shipdate)::VARCHAR AS niveau_2, count(*) AS nb, sum(l_quantity)::BIGINT AS total
FROM lineitem WHERE (year(l_shipdate), month(l_shipdate)) IN (SELECT (year(o_orderdate), month(o_orderdate)) FROM orders WHERE quarter(o_orderdate) = 2)
GROUP BY 2, 3
UNION ALL SELECT 'people', 'M', 'b' || (c_custkey % 5)::VARCHAR, count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_custkey % 2 = 0 GROUP BY 3"""


def incremental_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D08 by file index: orders before 1998 are appended; then a batch brings 1998 and replays late 1997 under the next
    year, and a stream replays everything under another year. Every key stays where it came first."""
    root = scratch_path(spark, f"indexed-{uuid.uuid4().hex}")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("jour"), F.year("o_orderdate").alias("annee"))
    fact = IndexedTable(spark, f"{root}/fait", ["o_orderkey"], ["annee"])
    fact.append_new(o.where(F.col("jour") < F.lit(dt.date(1998, 1, 1))))
    late = o.where((F.col("jour") >= F.lit(dt.date(1997, 7, 1))) & (F.col("jour") < F.lit(dt.date(1998, 1, 1))))
    fact.append_new(late.withColumn("annee", F.col("annee") + 1).unionByName(o.where(F.col("jour") >= F.lit(dt.date(1998, 1, 1)))))
    o.withColumn("annee", F.col("annee") + 1).write.parquet(f"{root}/src/again")
    incremental_fact_load(spark, f"{root}/src/*", o.schema, f"{root}/fait", ["o_orderkey"], "annee", checkpoint=f"{root}/ckpt")
    return spark.read.parquet(f"{root}/fait").select("o_orderkey", "jour", F.col("annee").cast("int").alias("annee"))


_INCREMENTAL_MOVED_KEYS = "SELECT o_orderkey, o_orderdate::DATE AS jour, year(o_orderdate)::INTEGER AS annee FROM orders"


QUERIES = {f.__name__: f for f in (bucketed_scd2, bucketed_upsert, unique_patients_rollup, percentiles_price, containment_priorities,
                                   dq_suite, lookup_reports, partitioned_storage, incremental_moved_keys)}
ORACLES = {"bucketed_scd2": _BUCKETED_SCD2, "bucketed_upsert": _BUCKETED_UPSERT, "unique_patients_rollup": _UNIQUE_PATIENTS_ROLLUP,
           "percentiles_price": _PERCENTILES_PRICE, "containment_priorities": _CONTAINMENT_PRIORITIES, "dq_suite": _DQ_SUITE,
           "lookup_reports": _LOOKUP_REPORTS, "partitioned_storage": _PARTITIONED_STORAGE, "incremental_moved_keys": _INCREMENTAL_MOVED_KEYS}
DOUBLE_COLUMNS = {"percentiles_price": ["p25", "p50", "p75", "p90"]}
