"""Filters (F01-F12), join shapes (J02-J16) and contracts."""

import pytest
from pyspark.sql import functions as F

from carelake.functions import filters as fl
from carelake.operators import joins
from carelake.operators.contract import conform, contract_violations, widen


def test_filters(spark):
    df = spark.createDataFrame([(1, "A00", 2019, "x"), (None, "B20", 2020, "Non renseigne"), (3, None, 2021, None)],
                               "k int, code string, annee int, region string")
    assert fl.require_keys(df, "k").count() == 2
    assert fl.drop_null(df, "code").count() == 2
    assert fl.in_years(df, "annee", 2019).count() == 1 and fl.in_years(df, "annee", 2019, 2020).count() == 2
    assert fl.known_only(df, "region").count() == 1
    assert df.where(fl.differs("region", "x")).count() == 1  # NULL does not pass '!='
    assert df.where(fl.contains_ci("code", "a0")).count() == 1
    assert df.where(fl.isin("annee", [2020, 2021])).count() == 2
    assert df.where(fl.between_str("code", "A00", "B99")).count() == 2
    assert df.where(fl.between("annee", 2020, 2021)).count() == 2
    assert df.where(fl.matches("code", r"^[A-Z]\d{2}$")).count() == 2
    assert fl.plausible(df, "annee", 2020, 2100).count() == 2
    cur = spark.createDataFrame([(1, True), (2, False)], "k int, est_actuel boolean")
    assert fl.current_only(cur).count() == 1


def test_join_shapes(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "pid int, sk int")
    pat = spark.createDataFrame([(1, "a"), (2, "b")], "pid int, nom string")
    link = spark.createDataFrame([(1, 100), (1, 101)], "pid int, mut int")
    mut = spark.createDataFrame([(100, "M1"), (101, "M2")], "mut int, lib string")
    e = joins.enrich(fact, pat, [("pid", "pid")], ["nom"])
    assert sorted((r.pid, r.nom) for r in e.collect()) == [(1, "a"), (2, "b"), (3, None)]
    b = joins.bridge(pat, link, mut, ("pid", "pid"), ("mut", "mut"), ["lib"])
    assert sorted((r.pid, r.lib) for r in b.collect()) == [(1, "M1"), (1, "M2"), (2, None)]  # fan-out kept
    grains = spark.createDataFrame([(10, 5)], "sk int, total int")
    t = joins.attach_totals(fact, grains, ["sk"], ["total"])
    assert sorted((r.pid, r.total) for r in t.collect()) == [(1, 5), (2, 0), (3, 0)]  # NULL key gets 0 (T33)
    a = spark.createDataFrame([("r1", 1), ("r2", 2)], "region string, n_a int")
    c = spark.createDataFrame([("r2", 7), ("r3", 9)], "reg string, n_b int")
    m = joins.full_merge(a, c, [("region", "reg")])
    assert sorted(tuple(r) for r in m.collect()) == [("r1", 1, 0), ("r2", 2, 7), ("r3", 0, 9)]
    g = joins.enrich_grouped(pat, link, ("pid", "pid"), [F.count_distinct("mut").alias("nb")])
    assert sorted((r.pid, r.nb) for r in g.collect()) == [(1, 2), (2, None)]
    dims = joins.denormalize(fact, [(spark.createDataFrame([(10, "x")], "sk int, lbl string"), "sk", ["lbl"])])
    assert dims.where("lbl = 'x'").count() == 1
    spec = spark.createDataFrame([(7, "cardio")], "sk_specialite int, specialite string")
    pro = spark.createDataFrame([(10, 7)], "sk int, fk_specialite int")
    w = joins.walk(fact, pro, ("sk", "sk"), spec, ("fk_specialite", "sk_specialite"), [], ["specialite"])
    assert sorted((r.pid, r.specialite) for r in w.collect()) == [(1, "cardio"), (2, None), (3, None)]


def test_contract_and_widen(spark):
    df = spark.createDataFrame([(1, "abcdef"), (2, "ab")], "k int, name string")
    spec = [("k", "bigint", None), ("name", "string", 4), ("missing", "string", 3)]
    with pytest.raises(ValueError):
        conform(df, spec)
    out = conform(df, spec[:2])
    assert [f.dataType.typeName() for f in out.schema] == ["long", "string"]
    v = sorted((r.column_name, r.failures) for r in contract_violations(df, spec, "t").collect())
    assert v == [("missing", -1), ("name", 1)]
    assert widen(df, {"k": "bigint"}).schema["k"].dataType.typeName() == "long"


def test_length_contract_and_max_length_scan_the_table_once(spark):
    from carelake.operators import quality
    from conftest import SF001
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    spec = [("c_name", "string", 17), ("c_mktsegment", "string", 5), ("c_acctbal", "string", 6), ("nope", "string", 3)]
    for df in (contract_violations(c, spec, "customer"),
               quality.max_length(c, {"c_name": 17, "c_mktsegment": 5, "c_acctbal": 6}, "customer",
                                  exact={"c_mktsegment": 10})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1, plan
    got = {r.column_name: r.failures for r in contract_violations(c, spec, "customer").collect()}
    assert got["nope"] == -1 and set(got) == {"c_name", "c_mktsegment", "c_acctbal", "nope"}
