"""Sources and sinks: CSV tree ingest, JDBC publish/read, layers, streaming incremental load.

The JDBC tests use an in-memory Derby database embedded in the test JVM (no
port, no server). Such a database is visible to the local process only, so it
exercises the Spark JDBC code path but not a multi-executor deployment.
"""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.quality import load_summary
from carelake.sources import io
from carelake.sources.schemas import mapped_type, schema_from_types
from carelake.streaming.incremental import incremental_fact_load

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_tree_ingest_names_audit_and_malformed_rows(spark, tmp_root):
    src = os.path.join(tmp_root, "csv")
    write_text(os.path.join(src, "DECES EN FRANCE", "deces.csv"), "a,b\n1,x\n2,y\n")
    write_text(os.path.join(src, "top.csv"), "A,B\n1,2\nbad,3\n4,5\n")
    write_text(os.path.join(src, "DECES EN FRANCE", "~$deces.csv"), "lock file")
    schemas = {"top": T.StructType([T.StructField("A", T.IntegerType()), T.StructField("B", T.IntegerType())])}
    audit = io.ingest_csv_tree(spark, src, os.path.join(tmp_root, "raw"), schemas, load_id=7,
                               as_of="2025-01-01 00:00:00", audit_path=os.path.join(tmp_root, "audit"))
    got = sorted((r.table_name, r.nb_lignes, r.statut) for r in audit.collect())
    # the malformed row is dropped and the count comes from the written table
    assert got == [("deces_en_france_deces", 2, "SUCCESS"), ("top", 2, "SUCCESS")]
    raw = spark.read.parquet(os.path.join(tmp_root, "raw", "top"))
    assert sorted(tuple(r) for r in raw.collect()) == [(1, 2), (4, 5)]
    summary = load_summary(spark.read.parquet(os.path.join(tmp_root, "audit"))).first()
    assert (summary.load_id, summary.nb_tables, summary.nb_lignes_total, summary.nb_succes) == (7, 2, 4, 2)


def test_spark_written_csv_folder_is_one_table(spark, tmp_root):
    src = os.path.join(tmp_root, "csv")
    spark.range(100).repartition(3).write.option("header", True).csv(os.path.join(src, "Ventes", "orders export.csv"))
    audit = io.ingest_csv_tree(spark, src, os.path.join(tmp_root, "raw"), as_of="2025-01-01 00:00:00")
    assert [(r.table_name, r.nb_lignes) for r in audit.collect()] == [("ventes_orders_export", 100)]


def test_jdbc_publish_truncate_and_partitioned_read(spark):
    url = "jdbc:derby:memory:carelake_t1;create=true"
    df = spark.range(1, 101).select(F.col("id").cast("int").alias("sk_patient"),
                                    F.concat(F.lit("n"), F.col("id").cast("string")).alias("nom"))
    io.publish(df, url, "DIM_PATIENT", mode="overwrite", properties=DERBY, batchsize=10)
    back = io.read_jdbc_table(spark, url, "DIM_PATIENT", DERBY, partition_column="SK_PATIENT",
                              lower_bound=1, upper_bound=100, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 100
    # truncate-and-load keeps the table, replaces the rows, keeps the unknown member
    io.publish_dimension(df.where("sk_patient <= 10"), "sk_patient", url, "DIM_PATIENT",
                         defaults={"nom": "Inconnu"}, properties=DERBY)
    again = io.read_jdbc_table(spark, url, "DIM_PATIENT", DERBY)
    assert again.count() == 11 and again.where("sk_patient = -1").first()["nom"] == "Inconnu"


def test_type_map_and_empty_table(spark):
    assert mapped_type("double precision") == T.DoubleType() and mapped_type("geometry") == T.StringType()
    empty = io.empty_like(spark, [("id", "integer"), ("payload", "jsonb"), ("at", "timestamp with time zone")])
    assert empty.count() == 0 and [f.dataType for f in empty.schema] == [
        T.IntegerType(), T.StringType(), T.TimestampType()]
    assert schema_from_types([("x", "uuid")]).fields[0].dataType == T.StringType()


def test_narrow_integral_and_observed_write(spark, tmp_root):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None)], "a double, b double")
    out = io.narrow_integral(df)
    assert [f.dataType for f in out.schema] == [T.LongType(), T.DoubleType()]
    assert io.observed_write(out, os.path.join(tmp_root, "t"), "w1") == 2


def test_layers_partitioned_write_and_inventory(spark, tmp_root):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("annee"))
    io.write_layer(df, tmp_root, "dwh", "fait", partition_by=("annee",), sort_within=("id",))
    back = io.read_layer(spark, tmp_root, "dwh", "fait")
    assert back.where("annee = 1").count() == 5
    inv = io.layer_inventory({"fait": back}).first()
    assert (inv.table_name, inv.nb_lignes, inv.nb_colonnes) == ("fait", 10, 2)


def test_streaming_incremental_load_is_idempotent(spark, tmp_root):
    schema = T.StructType([T.StructField("num", T.LongType()), T.StructField("jour", T.StringType()),
                           T.StructField("v", T.IntegerType())])
    src, target = os.path.join(tmp_root, "src"), os.path.join(tmp_root, "fait")
    ckpt = os.path.join(tmp_root, "ckpt")
    spark.createDataFrame([(1, "2020-01-01", 1), (2, "2020-01-01", 2)], schema).write.parquet(src + "/f1")
    s1 = incremental_fact_load(spark, src + "/*", schema, target, ["num"], "jour", checkpoint=ckpt)
    assert s1["rows_written"] == 2
    # new file with one old key and one new key; the old one must not be appended again
    spark.createDataFrame([(2, "2020-01-01", 2), (3, "2020-01-02", 3)], schema).write.parquet(src + "/f2")
    s2 = incremental_fact_load(spark, src + "/*", schema, target, ["num"], "jour", checkpoint=ckpt)
    assert s2["rows_written"] == 1
    assert sorted(r.num for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_jdbc_list_tables(spark):
    url = "jdbc:derby:memory:carelake_t2;create=true"
    io.publish(spark.range(3), url, "SRC_A", properties=DERBY)
    io.publish(spark.range(2), url, "SRC_B", properties=DERBY)
    q = "select tablename as table_name from sys.systables where tabletype = 'T'"
    names = sorted(r.TABLE_NAME for r in io.list_jdbc_tables(spark, url, DERBY, query=q).collect())
    assert names == ["SRC_A", "SRC_B"]


def test_versioned_scd2_merge_reads_and_rewrites_the_same_table(spark, tmp_root):
    import datetime as dt

    from carelake.operators import history
    snap1 = spark.createDataFrame([(1, "A"), (2, "B")], "k int, v string")
    snap2 = spark.createDataFrame([(1, "A"), (2, "C"), (3, "D")], "k int, v string")
    assert io.read_current(spark, tmp_root, "dwh", "dim_x") is None

    def merge_with(snap, day):
        def run(current):
            if current is None:
                return history.scd2_init(snap, day)
            return history.scd2_merge(current, snap, ["k"], ["v"], day)
        return run

    p1 = io.merge_version(spark, tmp_root, "dwh", "dim_x", merge_with(snap1, dt.date(2024, 1, 1)))
    p2 = io.merge_version(spark, tmp_root, "dwh", "dim_x", merge_with(snap2, dt.date(2025, 1, 1)))
    assert p1.endswith("v=1") and p2.endswith("v=2")
    cur = io.read_current(spark, tmp_root, "dwh", "dim_x")
    rows = sorted((r.k, r.v, r.est_actuel) for r in cur.collect())
    assert rows == [(1, "A", True), (2, "B", False), (2, "C", True), (3, "D", True)]
    # an uncommitted attempt (no _SUCCESS marker) is never read and its number is skipped
    broken = os.path.join(tmp_root, "dwh", "dim_x", "v=3")
    snap1.write.parquet(broken)
    os.remove(os.path.join(broken, "_SUCCESS"))
    assert io.committed_versions(spark, tmp_root, "dwh", "dim_x") == [1, 2]
    assert io.read_current(spark, tmp_root, "dwh", "dim_x").count() == 4
    p4 = io.write_version(cur, tmp_root, "dwh", "dim_x")
    assert p4.endswith("v=4") and io.committed_versions(spark, tmp_root, "dwh", "dim_x") == [1, 2, 4]
