"""Writers and readers that need a path."""

import os
import time

import pytest
from pyspark.sql import functions as F

from opslens.sources import sinks


def folders(path):
    return sorted(p for p in os.listdir(path) if "=" in p)


def test_processed_layout_is_the_same_at_every_size(spark, tmp_path):
    for name, n in (("small", 10), ("large", 20_000)):
        df = spark.range(n).select((F.col("id") % 500).alias("k"), "id")
        sinks.write_processed(df, str(tmp_path / name), "k", buckets=8)
        assert all(f.startswith("key_bucket=") for f in folders(tmp_path / name))
        assert len(folders(tmp_path / name)) <= 8
        back = sinks.read_processed(spark, str(tmp_path / name))
        assert back.columns == ["k", "id"] and back.exceptAll(df).count() == 0 == df.exceptAll(back).count()


def test_bucket_of_a_key_prunes(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_processed(spark.range(1000).select((F.col("id") % 50).alias("k"), "id"), path, "k")
    bucket = spark.range(1).select(F.lit(7).cast("bigint").alias("k")).select(sinks.key_bucket("k")).first()[0]
    hit = spark.read.parquet(path).where((F.col("k") == 7) & (F.col(sinks.BUCKET_COLUMN) == bucket))
    assert hit.count() == 20
    assert "PartitionFilters: [isnotnull" in hit._jdf.queryExecution().executedPlan().toString()


def test_hot_and_null_keys_are_kept_and_split(spark, tmp_path):
    """A bucket that one key fills is written by several tasks."""
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5)
                                      .cast("bigint").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        sinks.write_processed(rows.repartition(16), str(tmp_path / "p"), "k", buckets=4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    back = sinks.read_processed(spark, str(tmp_path / "p"))
    assert back.count() == 60_000 and back.where("k is null").count() == 20_000
    files = [len([x for x in os.listdir(tmp_path / "p" / f) if x.endswith(".parquet")]) for f in folders(tmp_path / "p")]
    assert max(files) > 1


def test_rollup_sink_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5), path)
    sinks.write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_latest_summary(spark, tmp_path):
    path = str(tmp_path / "summary")
    assert sinks.latest_summary(spark, path, "n long").count() == 0
    sinks.write_summary(spark.createDataFrame([(1,)], "n long"), path)
    time.sleep(0.05)
    sinks.write_summary(spark.createDataFrame([(2,)], "n long"), path)
    row = sinks.latest_summary(spark, path, "n long, timestamp double").first()
    assert row.n == 2 and row.timestamp > 1.6e9
    assert sinks.latest_summary(spark, path, "n long").columns == ["n"]


def test_latest_summary_ties(spark, tmp_path):
    """Equal modification times: the newer own timestamp wins, then the lowest path."""
    path = tmp_path / "ties"
    for name, n, t in (("b", 2, 5.0), ("a", 1, 5.0), ("c", 3, 4.0), ("d", 4, None)):
        spark.createDataFrame([(n, t)], "n long, timestamp double").coalesce(1).write.json(str(path / name))
    for f in path.glob("*/part-*.json"):
        os.utime(f, (1_700_000_000, 1_700_000_000))
    assert sinks.latest_summary(spark, f"{path}/*", "n long").first().n == 1


def test_latest_summary_reads_only_the_newest_file(spark, tmp_path):
    path = tmp_path / "s"
    sinks.write_summary(spark.createDataFrame([(7,)], "n long"), str(path))
    (path / "old.json").write_text("this is not json")
    os.utime(path / "old.json", (1, 1))
    df = sinks.latest_summary(spark, str(path), "n long")
    assert df.first().n == 7 and len(df.inputFiles()) == 1


def test_an_unknown_file_system_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)scheme|filesystem|file system"):
        sinks.latest_summary(spark, "nosuchfs://host/summary", "n long").count()


CELLS = [("1", '  a "quoted" x ', "$1,234.50"), ("2", "line one\nline two", None), ("3", '"', " "), ("4", "a,b\r\nc", "\\"),
         ("5", "\\\"q", "'")]


def test_csv_round_trip_keeps_every_cell(spark, tmp_path):
    df = spark.createDataFrame(CELLS, "id string, note string, amount string")
    sinks.write_csv(df, str(tmp_path / "c"))
    back = sinks.read_raw_csv(spark, str(tmp_path / "c"))
    assert [t for _, t in back.dtypes] == ["string", "string", "string", "timestamp"]
    assert {r.id: (r.note, r.amount) for r in back.collect()} == {i: (n, a) for i, n, a in CELLS}
    assert back.where("ingest_timestamp is null").count() == 0


def test_csv_from_python_reads_exactly(spark, tmp_path):
    import csv
    (tmp_path / "p").mkdir()
    with open(tmp_path / "p" / "a.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["id", "note"])
        w.writerows([["1", 'a ""quoted"" x'], ["2", "two\nlines"], ["3", " blanks "]])
    got = {r.id: r.note for r in sinks.read_raw_csv(spark, str(tmp_path / "p")).collect()}
    assert got == {"1": 'a ""quoted"" x', "2": "two\nlines", "3": " blanks "}


def test_mixed_header_orders_fail(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "m" / "b.csv").write_text("v,id\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        sinks.read_raw_csv(spark, str(tmp_path / "m"), ["id", "v"]).collect()


def test_raw_csv_streaming_form(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string").write.option("header", True).csv(path)
    stream = sinks.read_raw_csv(spark, path, ["id", "v"], streaming=True)
    assert stream.isStreaming
    q = stream.writeStream.format("memory").queryName("raw_csv_stream").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select id, v, ingest_timestamp is not null as stamped from raw_csv_stream").collect()
    assert sorted((r.id, r.v, r.stamped) for r in got) == [("1", "a", True), ("2", "b", True)]


def test_bucketed_table_needs_no_shuffle_and_loses_no_column(spark, tmp_path):
    import uuid

    from opslens.operators.rollup import customer_rollup
    df = spark.range(5000).selectExpr("id % 97 AS customer_id", "id * 1.0D AS cleaned_purchase_amount",
                                      "id % 5 * 1.0D AS customer_satisfaction", "1.0D AS product_rating",
                                      "id AS key_bucket").union(spark.range(3).selectExpr("null", "1D", "1D", "1D", "-1"))
    with pytest.raises(ValueError):
        sinks.write_processed(df, str(tmp_path / "p"), "customer_id")
    table = f"processed_{uuid.uuid4().hex[:8]}"
    stored = sinks.write_bucketed(df, table, "customer_id", path=str(tmp_path / "b"), buckets=4)
    try:
        assert stored.columns == df.columns and stored.exceptAll(df).count() == 0 == df.exceptAll(stored).count()
        rolled = customer_rollup(stored)
        assert "Exchange" not in rolled._jdf.queryExecution().executedPlan().toString()
        want = {r.customer_id: r.total_purchase_amount for r in customer_rollup(df).collect()}
        assert {r.customer_id: r.total_purchase_amount for r in rolled.collect()} == want
        assert stored.where("customer_id = 7").count() == df.where("customer_id = 7").count()
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_bucketed_table_splits_a_hot_key(spark, tmp_path):
    import uuid
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
                                      F.md5(F.col("id").cast("string")).alias("v"))
    table, old = f"hot_{uuid.uuid4().hex[:8]}", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")
    try:
        assert sinks.write_bucketed(rows.repartition(16), table, "k", path=str(tmp_path / "h"), buckets=4).count() == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
        spark.sql(f"DROP TABLE {table}")
    assert len([f for f in os.listdir(tmp_path / "h") if f.endswith(".parquet")]) > 8
