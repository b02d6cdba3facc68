"""Benchmark: the warehouse workflow at one scale factor, one JSON line out.

Stages (mirroring the reference's pipeline and its published timings):
  dwh_build   dimensions + facts from the test tables, written as Parquet
  marts_build the 7 marts from the written warehouse, written as Parquet
              (partitioned by year, so KPI year filters prune files)
  kpi1..kpi11 the KPI queries on the written marts / warehouse
  op_*        operator queries end to end from the raw tables

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""
from __future__ import annotations

import json
import os
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from carelake.plans import kpi, marts  # noqa: E402
from carelake.plans.bindings import QUERIES  # noqa: E402
from carelake.plans.bound import AS_OF, BoundWarehouse  # noqa: E402
from carelake.session import get_spark, scratch_path  # noqa: E402
from carelake.sources.io import read_layer, write_layer  # noqa: E402

OPERATOR_QUERIES = ["sk_two_key", "containment_cascade", "lookup_required", "pseudonym_match",
                    "scd2_history", "scd2_merge", "moving_avg", "median_stay", "date_parse_multi",
                    "rule_classify_part", "duration_minutes", "dq_profile"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": "16g"})
    root = scratch_path(spark, f"bench-{uuid.uuid4().hex}")
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    # warm-up on the smallest scale (JIT, class loading); not reported
    QUERIES["kpi5"](spark, "/root/testdata/sf0.001").collect()

    wh = BoundWarehouse(spark, sf_dir)
    timed("dwh_build", lambda: wh.materialize(root))

    def build_marts():
        m = {
            "dm_consultations_analysis": marts.dm_consultations_analysis(
                wh.fait_consultation(), wh.dim_temps(), wh.dim_etablissement(), wh.dim_diagnostic(),
                wh.dim_professionnel(), wh.dim_specialite(), AS_OF),
            "dm_hospitalisations_analysis": marts.dm_hospitalisations_analysis(
                wh.fait_hospitalisation(), wh.dim_temps(), wh.dim_etablissement(), wh.dim_diagnostic(),
                wh.dim_patient(), AS_OF),
            "dm_deces_analysis": marts.dm_deces_analysis(wh.fait_deces(), wh.dim_temps(), wh.dim_localisation(),
                                                         AS_OF, year=2024),
            "dm_satisfaction_analysis": marts.dm_satisfaction_analysis(wh.fait_satisfaction(),
                                                                       wh.dim_etablissement(), AS_OF, year=1998),
            "dm_consultations_agregees": marts.dm_consultations_agregees(
                wh.fait_consultation(), wh.dim_temps(), wh.dim_etablissement(), wh.dim_diagnostic(),
                wh.dim_professionnel(), wh.dim_specialite(), wh.dim_patient(), AS_OF),
            "dm_hospitalisations_agregees": marts.dm_hospitalisations_agregees(
                wh.fait_hospitalisation(), wh.dim_temps(), wh.dim_etablissement(), wh.dim_diagnostic(),
                wh.dim_patient(), AS_OF),
            "dm_analyse_territoriale": marts.dm_analyse_territoriale(
                wh.fait_deces(), wh.fait_satisfaction(), wh.dim_temps(), wh.dim_localisation(), wh.dim_patient(),
                wh.dim_etablissement(), AS_OF),
        }
        # the marts are independent: submit their writes as concurrent jobs
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(lambda kv: write_layer(kv[1], root, "datamart", kv[0], partition_by=("annee",)),
                          m.items()))
        return {name: read_layer(spark, root, "datamart", name) for name in m}

    dm = timed("marts_build", build_marts)
    cm, hm = dm["dm_consultations_analysis"], dm["dm_hospitalisations_analysis"]
    kpis = {
        "kpi1": lambda: kpi.kpi1(cm, year=1998),
        "kpi2": lambda: kpi.kpi2(cm, 1996, 1998),
        "kpi3": lambda: kpi.kpi3(hm, since=1998),
        "kpi4": lambda: kpi.kpi4(hm, year=1997),
        "kpi5": lambda: kpi.kpi5(hm, year=1998),
        "kpi6": lambda: kpi.kpi6(cm, year=1998),
        "kpi7": lambda: kpi.kpi7(dm["dm_deces_analysis"], year=2024),
        "kpi8": lambda: kpi.kpi8(dm["dm_satisfaction_analysis"], year=1998),
        "kpi9": lambda: kpi.kpi9(wh.fait_consultation(), wh.dim_professionnel(), wh.dim_specialite()),
        "kpi10": lambda: kpi.kpi10(wh.fait_hospitalisation(), wh.fait_satisfaction(), wh.dim_etablissement()),
        "kpi11": lambda: kpi.kpi11(wh.fait_satisfaction(), wh.dim_temps()),
    }
    for name, q in kpis.items():
        timed(name, lambda q=q: q().collect())

    for name in OPERATOR_QUERIES:
        timed(f"op_{name}", lambda name=name: QUERIES[name](spark, sf_dir)
              .write.format("noop").mode("overwrite").save())

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "warehouse_pipeline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
