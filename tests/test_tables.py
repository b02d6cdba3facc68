"""Bucketed copy-on-write tables, exact percentiles by counting, grain totals, bitmap states, the gram index."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.operators import distinct, history, measures
from carelake.operators.match import containment_lookup
from carelake.sources.bucketed import BucketedTable

SCHEMA = "a int, b string, v string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files_of(table):
    return {b: sorted(os.listdir(f)) for b, f in table.manifest().items()}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- bucketed tables -----------------------------------------------------------------------------

def base_rows():
    return [(i if i % 7 else None, f"k{i}", "v") for i in range(200)] + [(1000, None, "v")]


def test_bucketed_upsert_keeps_untouched_buckets_and_null_keys(spark, tmp_root):
    t = BucketedTable(spark, tmp_root, "dwh", "t", ["a", "b"], buckets=32)
    report = t.create(spark.createDataFrame(base_rows(), SCHEMA))
    assert len(report.written) == 32 and t.versions() == [1]
    before, folders = files_of(t), t.manifest()
    batch = [(None, "k7", "new"), (1000, None, "new"), (5, "k5", "new"), (7777, "fresh", "new")]
    report = t.upsert(spark.createDataFrame(batch, "a long, b string, v string"))  # another integer type finds the same buckets
    want = {(a, b): v for a, b, v in base_rows()} | {(a, b): v for a, b, v in batch}
    assert rows_of(t.read()) == sorted(((a, b, v) for (a, b), v in want.items()), key=str)
    assert 1 <= len(report.read) <= 4 and set(report.written) == set(report.read)
    for b in set(before) - set(report.written):
        assert t.manifest()[b] == folders[b] and files_of(t)[b] == before[b]
    assert all(t.manifest()[b] != folders[b] for b in report.written)
    # one bucket's rows come from its folder alone
    one = t.read([report.written[0]])
    assert len({f.rsplit("/", 1)[0] for f in one.inputFiles()}) == 1


def test_bucketed_merge_that_fails_leaves_the_table(spark, tmp_root):
    t = BucketedTable(spark, tmp_root, "dwh", "t", ["a", "b"], buckets=8)
    t.create(spark.createDataFrame(base_rows(), SCHEMA))
    before = rows_of(t.read())
    with pytest.raises(Exception):
        t.merge(spark.createDataFrame([(1, "k1", "x")], SCHEMA),
                lambda now, new: now.unionByName(new.withColumn("v", F.raise_error(F.lit("broken")))))
    assert t.versions() == [1] and rows_of(t.read()) == before


def test_bucketed_empty_table_empty_batch_and_emptied_bucket(spark, tmp_root):
    t = BucketedTable(spark, tmp_root, "dwh", "t", ["a", "b"], buckets=8)
    none = spark.createDataFrame([], SCHEMA)
    t.create(none)
    assert t.read() is None and t.upsert(none).version is None
    t.upsert(spark.createDataFrame([(1, "x", "v"), (None, None, "v")], SCHEMA))
    assert rows_of(t.read()) == sorted([(1, "x", "v"), (None, None, "v")], key=str)
    t.merge(spark.createDataFrame([(1, "x", "v")], SCHEMA), lambda now, new: now.join(new, ["a", "b"], "left_anti"))
    assert rows_of(t.read()) == [(None, None, "v")]


def test_bucketed_scd2_rewrites_buckets_of_changed_keys_only(spark, tmp_root):
    t = BucketedTable(spark, tmp_root, "dwh", "d", ["a", "b"], buckets=64)
    snapshot = spark.createDataFrame(base_rows(), SCHEMA)
    t.scd2_merge(snapshot, ["v"], dt.date(2024, 1, 1))  # first load of a table without a version
    assert t.read().count() == 201
    second = snapshot.withColumn("v", F.when(F.col("b").isin("k14", "k20"), "w").otherwise(F.col("v")))  # k14 has a NULL part
    report = t.scd2_merge(second, ["v"], dt.date(2025, 1, 1))
    assert len(report.written) <= 2 < 64
    got = {(r.a, r.b, r.v, r.est_actuel, r.numero_version, r.date_fin_validite) for r in t.read().collect() if r.b in ("k14", "k20")}
    end = dt.date(2024, 12, 31)
    assert got == {(None, "k14", "v", False, 1, end), (None, "k14", "w", True, 2, None), (20, "k20", "v", False, 1, end), (20, "k20", "w", True, 2, None)}
    assert t.read().count() == 203
    assert t.scd2_merge(second, ["v"], dt.date(2026, 1, 1)).version is None  # nothing new: nothing written
    # the same as a merge of the whole table
    whole = history.scd2_merge(history.scd2_init(snapshot, dt.date(2024, 1, 1)), second, ["a", "b"], ["v"], dt.date(2025, 1, 1))
    assert rows_of(whole.select("a", "b", "v", "est_actuel", "numero_version")) == rows_of(t.read().select("a", "b", "v", "est_actuel", "numero_version"))


# --- percentiles ----------------------------------------------------------------------------------

def test_exact_percentiles_match_the_sorting_definition(spark):
    r = random.Random(4)
    rows = [("hot", float(r.randrange(10**6))) for _ in range(3000)] + [("tied", 5.0)] * 400 + [(None, float(i)) for i in range(11)]
    rows += [("one", 2.5), ("nulls", None), ("mixed", None), ("mixed", -1.0), ("mixed", 4.0)]
    ps = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r["g"]: r for r in measures.exact_percentiles(df, ["g"], "x", ps, ranges=16).collect()}
    groups = {g: [x for h, x in rows if h == g and x is not None] for g in {g for g, _ in rows}}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        for name, p in ps.items():
            assert got[g][name] is None if not xs else got[g][name] == pytest.approx(np.percentile(xs, 100 * p), abs=1e-9), (g, name)
    assert measures.exact_percentiles(df.where("false"), ["g"], "x", ps).count() == 0


def test_a_hot_group_is_spread_over_ranges(spark, monkeypatch):
    seen = {}
    keep = measures.pin
    monkeypatch.setattr(measures, "pin", lambda df, name: seen.setdefault(name, keep(df, name)))
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.col("id").alias("x"))
    out = measures.exact_percentiles(df, ["g"], "x", {"p50": 0.5}, ranges=20)
    assert out.where("g = 'hot'").first()["p50"] == 9999.0
    per_range = [r["n"] for r in seen["histogram"].where("__g0 = 'hot'").groupBy("__range").agg(F.count("*").alias("n")).collect()]
    assert len(per_range) >= 8 and max(per_range) < 2500
    assert "percentile" not in physical(out).lower() and "collect_list" not in physical(out)


# --- grains and states ----------------------------------------------------------------------------

def test_grain_totals_use_one_aggregate_and_keep_null_keys_apart(spark, monkeypatch):
    seen = {}
    keep = measures.pin
    monkeypatch.setattr(measures, "pin", lambda df, name: (seen.update({name: df}), keep(df, name))[1])
    df = spark.createDataFrame([(1, "x", None, 7, 2), (1, "x", "d", 7, 3), (1, None, "d", 8, 4), (2, "x", "d", 7, 5)],
                               "day int, site string, diag string, patient int, n int")
    g = measures.grain_totals(df, {"site": ["day", "site"], "diag": ["day", "diag"], "day": ["day"]},
                              [F.sum("n").alias("n"), F.count_distinct("patient").alias("p")])
    assert rows_of(g["site"]) == sorted([(1, "x", 5, 1), (1, None, 4, 1), (2, "x", 5, 1)], key=str)
    assert rows_of(g["diag"]) == sorted([(1, None, 2, 1), (1, "d", 7, 2), (2, "d", 5, 1)], key=str)
    assert rows_of(g["day"]) == [(1, 9, 2), (2, 5, 1)]
    plan = physical(seen["grains"])
    assert plan.count("Expand") == 1 and plan.count("Scan") <= 1
    assert plan.count("Exchange hashpartitioning") == 2  # (grain, keys, patient), then (grain, keys)


@pytest.mark.parametrize("mart, grains", [("dm_hospitalisations_agregees", 4), ("dm_consultations_agregees", 4)])
def test_marts_take_all_grains_from_one_shuffle_of_the_rows(spark, monkeypatch, mart, grains):
    from carelake.plans import marts
    from carelake.plans.bound import AS_OF, BoundWarehouse
    from conftest import SF001
    seen = []
    keep = measures.pin
    monkeypatch.setattr(measures, "pin", lambda df, name: (seen.append((name, physical(df))), keep(df, name))[1])
    wh = BoundWarehouse(spark, SF001)
    dims = [wh.dim_temps(), wh.dim_etablissement(), wh.dim_diagnostic()]
    if mart == "dm_hospitalisations_agregees":
        marts.dm_hospitalisations_agregees(wh.fait_hospitalisation(), *dims, wh.dim_patient(), AS_OF)
    else:
        marts.dm_consultations_agregees(wh.fait_consultation(), *dims, wh.dim_professionnel(), wh.dim_specialite(), wh.dim_patient(), AS_OF)
    plans = [p for name, p in seen if name == "grains"]
    assert len(plans) == 1
    plan = plans[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert "libelle_diagnostic" not in plan and "nom_etablissement" not in plan  # keys and measures only


def test_distinct_states_roll_up_exactly(spark):
    r = random.Random(9)
    rows = [(d, d // 10, r.choice("ns"), r.choice([r.randrange(1, 50), r.randrange(1, 200000)])) for d in range(30) for _ in range(60)]
    rows += [(5, 0, "n", None), (6, 0, None, 3), (7, 0, "n", -1)]
    df = spark.createDataFrame(rows, "day int, dec int, side string, who long")
    days = distinct.distinct_state(df, ["day", "dec", "side"], "who")
    up = distinct.roll_up(distinct.roll_up(days, ["dec", "side"]), ["dec"])
    for state, keys in ((days, ["day", "side"]), (distinct.roll_up(days, ["dec", "side"]), ["dec", "side"]), (up, ["dec"])):
        want = df.where("who is not null").groupBy(*keys).agg(F.count_distinct("who").alias("n"))
        assert rows_of(distinct.count_members(state, keys, "n")) == rows_of(want)


# --- containment ----------------------------------------------------------------------------------

def test_containment_priorities_from_one_index(spark):
    r = random.Random(2)
    text = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    dim = [(i, text(9), text(14) if i % 5 else None, text(r.randrange(0, 20))) for i in range(60)]
    needles = [x[j][1:1 + n] for x in dim for j in (1, 2, 3) if x[j] for n in (1, 4, 8, 9)] + ["", "x", "123456789", None]
    needles += [x[2][:9] for x in dim if x[2]] + [x[3] for x in dim]
    d = spark.createDataFrame(dim, "sk int, a string, b string, c string")
    out = containment_lookup(spark.createDataFrame([(n,) for n in needles], "n string"), "n", d, ["a", "b", "c"], "sk", with_step=True)
    got = {x["n"]: (x["sk"], x["step"]) for x in out.collect()}
    want = {}
    for n in needles:
        hits = [(j, x[0]) for x in dim for j in (1, 2, 3) if n is not None and x[j] is not None and n in x[j]]
        want[n] = (min(hits)[1], min(hits)[0]) if hits else (-1, -1)
    assert got == want and {s for _, s in want.values()} == {-1, 1, 2, 3}
    plan = physical(out).split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") < 15 and "NestedLoop" not in plan and "Cartesian" not in plan


# --- check suite, lookups, clustered writes ----------------------------------------------------------

def test_suite_counts_planted_failures_with_one_scan_per_table(spark, tmp_root):
    from carelake.operators import suite
    child = [(1, "a", 5, True), (2, "a", 5, False), (2, None, 99, True), (None, "b", None, True), (2, "c", 7, True)]
    spark.createDataFrame(child, "id int, v string, p int, cur boolean").write.parquet(f"{tmp_root}/child")
    spark.createDataFrame([(5,), (7,), (7,), (None,)], "p int").write.parquet(f"{tmp_root}/parent")
    t = {n: spark.read.parquet(f"{tmp_root}/{n}") for n in ("child", "parent")}
    out = suite.run(t, [suite.not_null("child", "id", "v", "p"), suite.unique("child", "id"), suite.unique("child", "id", "v"),
                        suite.unique("parent", "p"), suite.one_current("child", "id", flag="cur"),
                        suite.accepted_values("child", "v", ["a", "b"]), suite.in_range("child", "p", 5, 50),
                        suite.holds("child", "id_lt_p", lambda: F.col("id") < F.col("p")),
                        suite.relationship("child", "p", "parent", "p"), suite.not_null("parent", "p")])
    got = [(r.check_name, r.table_name, r.column_name, r.failures, r.passed) for r in out.collect()]
    assert sorted(got, key=str) == sorted([
        ("not_null", "child", "id", 1, False), ("not_null", "child", "v", 1, False), ("not_null", "child", "p", 1, False),
        ("unique", "child", "id", 1, False), ("unique_combination", "child", "id,v", 0, True), ("unique", "parent", "p", 1, False),
        ("one_current_version", "child", "id", 1, False), ("accepted_values", "child", "v", 1, False),
        ("accepted_range", "child", "p", 1, False), ("holds:id_lt_p", "child", None, 0, True),
        ("relationship", "child", "p", 1, False), ("not_null", "parent", "p", 1, False)], key=str)
    plan = physical(out).split("== Initial Plan ==")[-1]
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") <= 2
    empty = suite.run({n: d.where("false") for n, d in t.items()}, [suite.unique("child", "id"), suite.relationship("child", "p", "parent", "p")])
    assert [r.failures for r in empty.collect()] == [0, 0]
    with pytest.raises(ValueError, match="not given"):
        suite.run(t, [suite.unique("nowhere", "id")])


def test_lookup_report_strict_failure_and_observation(spark):
    from carelake.operators.keys import lookup, lookup_report, observed_lookup
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (3, "w"), (None, "n")], "k int, v string")
    dim = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (9, 90), (9, 91), (None, 0)], "k int, sk int")
    r = lookup_report("f", fact, dim, ["k"]).first()
    assert r.asDict() == {"lookup": "f", "fact_rows": 5, "matched": 3, "missed": 2, "null_keys": 1, "multiplied": 2, "extra_rows": 2, "duplicate_keys": 2}
    assert lookup_report("e", fact.where("false"), dim.where("false"), ["k"]).first()["fact_rows"] == 0
    with pytest.raises(Exception, match="duplicate dimension key: 2"):
        lookup(fact, dim, ["k"], "sk", required=False, strict="fail").collect()
    fine = lookup(fact.where("k <> 2"), dim, ["k"], "sk", required=False, strict="fail").collect()  # no fact asks for key 9
    assert sorted((x.v, x.sk) for x in fine) == [("w", -1), ("x", 10)]
    out, obs = observed_lookup(fact, dim, ["k"], "sk", "seen")
    assert len(out.collect()) == 7 and obs.get == {"rows_out": 7, "matched": 5, "missed": 2}


def test_partitioned_writes_are_clustered_and_star_joins_prune(spark, tmp_root):
    from carelake.sources.io import read_layer, write_layer
    df = spark.range(4000).select("id", (F.col("id") % 6 + 2000).cast("int").alias("annee"), (F.col("id") % 12).cast("int").alias("mois")).repartition(16)
    path = write_layer(df, tmp_root, "dwh", "t", partition_by=["annee", "mois"], sort_within=["id"])
    counts = [len([f for f in fs if f.endswith(".parquet")]) for d, _, fs in os.walk(path) if "mois=" in d]
    assert len(counts) == 12 and max(counts) == 1  # not one file per task and partition
    t = read_layer(spark, tmp_root, "dwh", "t")
    spark.range(2000, 2006).selectExpr("cast(id as int) annee", "id % 3 as q").write.parquet(f"{tmp_root}/years")
    dim = spark.read.parquet(f"{tmp_root}/years").where("q = 0")
    joined = t.join(F.broadcast(dim), "annee").groupBy("annee").count()
    assert "dynamicpruning" in physical(joined)
    assert {r.annee: r["count"] for r in joined.collect()} == {2001: 667, 2004: 666}
