"""Totals of the marts' grains: one trip of the rows for a distinct count, and totals beside the rows."""
from pyspark.sql import functions as F

from carelake.operators import measures
from carelake.operators.joins import attach_totals

ROWS = [(1, "x", "d", 7, 2), (1, "x", "d", 7, 3), (1, "x", "d", 8, 1), (1, "x", "e", None, 4), (1, None, "d", 8, 4),
        (2, "x", "d", 7, None), (2, "x", "d", None, 5), (None, "x", "d", 7, 6)]
GRAINS = {"site": ["day", "site"], "diag": ["day", "diag"], "day": ["day"]}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_distinct_marks_count_as_count_distinct_with_rows_dealt_once(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, "day int, site string, diag string, patient int, n int")
    seen = {}
    keep = measures.pin
    monkeypatch.setattr(measures, "pin", lambda d, name: (seen.update({name: d}), keep(d, name))[1])
    got = measures.grain_totals(df, GRAINS, [F.sum("n").alias("n")], ("patient", "p"))
    plan = seen["grains"]._jdf.queryExecution().executedPlan().toString()
    want = measures.grain_totals(df, GRAINS, [F.sum("n").alias("n"), F.count_distinct("patient").alias("p")])
    for g in GRAINS:
        assert got[g].schema.simpleString() == want[g].schema.simpleString() and rows_of(got[g]) == rows_of(want[g])
    # the rows are dealt before they are repeated for each grain
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("Exchange hashpartitioning(day")


def test_totals_beside_rows_equal_attached_totals(spark):
    df = spark.createDataFrame(ROWS, "day int, site string, diag string, patient int, n int")
    keys = ["day", "site", "diag"]
    totals = df.groupBy(*keys).agg(F.sum("n").alias("s"), F.count("n").alias("c"), F.count_distinct("patient").alias("p"))
    want = attach_totals(df, totals, keys, ["s", "c", "p"])
    got = measures.totals_beside(df, keys, {"s": F.sum("n"), "c": F.count("n")}, ("patient", "p"))
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_marts_carry_no_labels_through_the_grains(spark, monkeypatch):
    from carelake.plans import marts
    from carelake.plans.bound import AS_OF, BoundWarehouse
    from conftest import SF001
    seen = []
    keep = marts.pin
    monkeypatch.setattr(marts, "pin", lambda d, name: (seen.append(d.columns), keep(d, name))[1])
    wh = BoundWarehouse(spark, SF001)
    dims = [wh.dim_temps(), wh.dim_etablissement(), wh.dim_diagnostic()]
    marts.dm_hospitalisations_agregees(wh.fait_hospitalisation(), *dims, wh.dim_patient(), AS_OF)
    marts.dm_consultations_agregees(wh.fait_consultation(), *dims, wh.dim_professionnel(), wh.dim_specialite(), wh.dim_patient(), AS_OF)
    assert len(seen) == 2
    for cols in seen:
        assert not {"libelle_diagnostic", "nom_etablissement", "date_complete", "nom_professionnel"} & set(cols)


def test_stored_dimensions_are_small_to_the_planner(spark):
    from carelake.plans.bound import BoundWarehouse
    from conftest import SF001
    wh = BoundWarehouse(spark, SF001)
    for dim in (wh.dim_patient(), wh.dim_etablissement(), wh.dim_diagnostic(), wh.dim_professionnel()):
        assert int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 10 << 20
