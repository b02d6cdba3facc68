"""Driver contract: every registered query equals its DuckDB oracle (sf0.001 here,
sf0.01 in the driver's check and in ``tools/check_oracles.py``)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from carelake.plans import bindings, raw_tables, tables
from carelake.plans.registry import Pipeline
from conftest import SF001, SF01

QUERIES = bindings.QUERIES | tables.QUERIES
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
        return round(float(v), 6)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, type(x).__name__, x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) | set(raw_tables.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(raw_tables.QUERIES) == 39
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    compare(E.queries()[name](spark, SF001), duck, name)


@pytest.fixture(scope="module")
def graph(spark):
    """One pipeline for all models: the registered queries build one each."""
    return Pipeline(spark, raw_tables.raw_tables(spark, SF001), raw_tables.AS_OF, calendar_bounds=raw_tables.CALENDAR)


@pytest.mark.parametrize("model", raw_tables.models())
def test_model_matches_oracle(graph, duck, model):
    compare(raw_tables._comparable(graph.get(model)), duck, f"m_{model}")


def compare(sdf, duck, name):
    s_cols, s_rows = sdf.columns, sdf.collect()
    rel = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    d_types = {r[0]: r[1] for r in duck.execute("DESCRIBE " + E.oracle_sql()[name]).fetchall()}
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    assert s_types == d_types
    assert len(s_rows) == len(d_rows)
    assert canon(s_cols, s_rows) == canon(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "pourcentage_total" in df.columns


def test_the_projections_reach_every_branch(duck):
    """Labels, misses, fan-outs and NULLs that the models treat specially all occur in the oracles' results (sf0.01)."""
    con = duckdb.connect()
    for t in raw_tables.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    ask = lambda model, what: con.execute(f"SELECT {what} FROM ({E.ORACLES['m_' + model]})").fetchall()
    labels = lambda model, col: {r[0] for r in ask(model, f"DISTINCT {col}")}
    assert len(labels("stg_specialites", "categorie")) == 35 and len(labels("dim_diagnostic", "chapitre_cim10")) == 22
    assert len(labels("dim_etablissement", "type_etablissement")) == 12 and len(labels("dim_etablissement", "categorie")) == 4
    assert labels("stg_mutuelle", "type_mutuelle") == {"CMU", "Assurance", "Mutuelle"}
    assert labels("ods_professionnel_complet", "mode_exercice") == {"Libéral", "Salarié", "Mixte", "Non renseigné"}
    assert labels("ods_consultation_enrichie", "duree_categorie") == {"COURTE", "NORMALE", "LONGUE", "NON_RENSEIGNEE"}
    assert len(labels("ods_deces_enrichi", "tranche_age_deces")) >= 5 and len(labels("dim_localisation", "region")) == 15
    for fact, keys in (("fait_hospitalisation", ["sk_etablissement", "sk_diagnostic", "sk_localisation"]), ("fait_consultation", ["sk_mutuelle", "sk_etablissement"]),
                       ("fait_deces", ["sk_patient", "sk_localisation"]), ("fait_satisfaction", ["sk_etablissement"]), ("fait_qualite_soins", ["sk_etablissement"])):
        for k in keys:
            missed, found = ask(fact, f"count(*) FILTER ({k} = -1), count(*) FILTER ({k} > 0)")[0]
            assert missed and found, (fact, k)
