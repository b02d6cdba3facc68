"""Appends through the file index: which files are read, keys that change partition, NULL keys, repairs."""

import os

from pyspark.sql import functions as F

from carelake.sources.fileindex import IndexedTable, _plain


def _batch(spark, low, high, year):
    return spark.range(low, high).select(F.col("id").alias("num"), F.lit(year).alias("annee"), (F.col("id") * 2).alias("v"))


def test_only_files_of_the_batch_are_read(spark, tmp_root):
    t = IndexedTable(spark, os.path.join(tmp_root, "fait"), ["num"], ["annee"])
    for i in range(4):
        done = t.append_new(_batch(spark, 1000 * i, 1000 * i + 1000, 2020 + i))
        assert (done.rows, done.files_read) == (1000, 0)
    # known keys under another year, and some new ones
    done = t.append_new(_batch(spark, 2100, 2300, 1999).unionByName(_batch(spark, 9000, 9010, 2020)))
    assert done.rows == 10 and 0 < done.files_read < done.files  # a range of the batch may span a gap
    rows = spark.read.parquet(t.path)
    assert rows.count() == 4010 and rows.where("annee = 1999").count() == 0
    uris, files = t.candidates(_batch(spark, 2100, 2300, 1999))
    assert files == len(t.data_files()) and all("annee=2022" in u for u in uris)
    held = t._held(_batch(spark, 2100, 2300, 1999), uris)
    assert sorted(map(_plain, held.inputFiles())) == sorted(map(_plain, uris))
    assert "ReadSchema: struct<num:bigint>" in held._jdf.queryExecution().toString()


def test_few_keys_are_pushed_to_bloom_filters(spark, tmp_root):
    t = IndexedTable(spark, os.path.join(tmp_root, "fait"), ["num"])
    t.append_new(_batch(spark, 0, 4000, 2020).withColumn("num", F.col("num") * 7))
    uris, _ = t.candidates(_batch(spark, 70, 73, 2020))
    held = t._held(_batch(spark, 70, 73, 2020), uris)
    assert "In(num" in held._jdf.queryExecution().toString().replace("PushedFilters: [", "")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(uris[0]), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        chunk = next(c for c in reader.getFooter().getBlocks().get(0).getColumns() if c.getPath().toDotString() == "num")
        assert chunk.getBloomFilterOffset() > 0
    finally:
        reader.close()


def test_null_keys_repeats_and_lost_index(spark, tmp_root):
    t = IndexedTable(spark, os.path.join(tmp_root, "fait"), ["a", "b"])
    first = spark.createDataFrame([(1, "x", 1), (1, "x", 1), (None, "x", 2), (2, None, 3)], "a int, b string, v int")
    assert t.append_new(first).rows == 3
    again = spark.createDataFrame([(None, "x", 9), (2, None, 9), (2, "y", 4), (None, None, 5)], "a int, b string, v int")
    # files that another writer added, unknown to the index
    spark.createDataFrame([(7, "q", 7)], "a int, b string, v int").write.mode("append").parquet(t.path)
    assert t.append_new(again.union(spark.createDataFrame([(7, "q", 8)], "a int, b string, v int"))).rows == 2
    assert sorted(r.v for r in spark.read.parquet(t.path).collect()) == [1, 2, 3, 4, 5, 7]
    assert t.append_new(again.where("v > 100")).rows == 0  # an empty batch
    assert t.append_new(first).rows == 0


def test_string_keys(spark, tmp_root):
    t = IndexedTable(spark, os.path.join(tmp_root, "fait"), ["k"])
    data = spark.createDataFrame([("é%02d" % i, i) for i in range(40)] + [("日", 1), ("", 2)], "k string, v int")
    assert t.append_new(data).rows == 42
    assert t.append_new(data.withColumn("v", F.lit(0))).rows == 0
