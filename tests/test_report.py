"""E3 end to end through storage: both ETL jobs, summaries (S12), latest (S13), insight."""

import json

import pytest

from conftest import SF_SMALL
from opslens.operators import ecommerce as ecom_ops
from opslens.operators import insight, summary
from opslens.plans import cross_domain, ecommerce, manufacturing
from opslens.sources import fixtures


def test_report_run_matches_in_memory(spark, tmp_path):
    mfg_tables = fixtures.mfg_tables(spark, SF_SMALL)
    ecom_tables = {"ecommerce": fixtures.ecommerce_processed(spark, SF_SMALL)}
    records = fixtures.ecommerce_records(spark, SF_SMALL)
    cross_domain.run(spark, str(tmp_path), mfg_tables, ecom_tables, records, time_col="ts")

    docs = [json.loads(line) for p in (tmp_path / "integrated").glob("part-*.json") for line in p.open()]
    assert len(docs) == 1
    doc = docs[0]
    assert set(doc) == {"timestamp", "manufacturing_metrics", "ecommerce_metrics", "cross_domain_insights"}

    mfg = summary.machine_summary(manufacturing.build(spark, mfg_tables).conformed, time_col="ts")
    erun = ecommerce.build(spark, ecom_tables)
    ecom = summary.customer_summary(erun.processed, ecom_ops.score_customer_records(ecom_ops.as_record(records)))
    expected = insight.cross_domain(spark, mfg, ecom).first().asDict()
    assert doc["cross_domain_insights"] == pytest.approx(expected)
    assert doc["manufacturing_metrics"]["total_machines_analyzed"] == mfg.first().total_machines_analyzed
    assert (tmp_path / "manufacturing" / "machine_aggregations").is_dir()
    assert (tmp_path / "ecommerce" / "customer_aggregations").is_dir()


def test_cli_manufacturing_etl_discovers_database(spark, tmp_path):
    import uuid

    from opslens import cli

    db = f"cli_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/db'")
    for name, df in fixtures.mfg_tables(spark, SF_SMALL).items():
        df.write.saveAsTable(f"{db}.{name}")
    cli.main(["manufacturing-etl", "--database", db, "--target", str(tmp_path / "out"), "--buckets", "16"])
    agg = spark.read.parquet(str(tmp_path / "out" / "machine_aggregations"))
    assert agg.agg({"total_records": "sum"}).first()[0] == fixtures.machine_readings(spark, SF_SMALL) \
        .where("energy_consumption is not null and not (line_no = 5 and order_key % 10 = 0)").count()
    assert 1 < len([p for p in (tmp_path / "out" / "processed").iterdir() if p.name.startswith("key_bucket=")]) <= 16


def test_produce_then_stream(spark, tmp_path):
    """Raw CSV (S1) -> keyed envelopes (S2) -> customer stream (T2): every row arrives."""
    from opslens import cli
    from opslens.streaming import processors

    raw = str(tmp_path / "raw")
    recs = fixtures.ecommerce_records(spark, SF_SMALL)
    recs.write.option("header", True).csv(raw)
    cli.main(["produce", "--csv", raw, "--key", "customer_id", "--out", str(tmp_path / "landing")])
    cli.main(["stream", "--domain", "ecommerce", "--source", str(tmp_path / "landing"), "--out",
              str(tmp_path / "out"), "--checkpoint", str(tmp_path / "ckpt"), "--available-now"])
    got = processors.read_records(spark, str(tmp_path / "out"), "ecommerce")
    assert got.count() == recs.count()
    assert got.where("customer_segment = 'ERROR'").count() > 0  # the 'n/a' and comma rows


def test_cli_report_discovers_both_databases(spark, tmp_path):
    import uuid

    from opslens import cli

    mfg_db, shop_db = f"mfg_{uuid.uuid4().hex[:8]}", f"shop_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {mfg_db} LOCATION '{tmp_path}/mfg_db'")
    spark.sql(f"CREATE DATABASE {shop_db} LOCATION '{tmp_path}/shop_db'")
    for name, df in fixtures.mfg_tables(spark, SF_SMALL).items():
        df.write.saveAsTable(f"{mfg_db}.{name}")
    fixtures.ecommerce_processed(spark, SF_SMALL).write.saveAsTable(f"{shop_db}.ecommerce")
    fixtures.ecommerce_records(spark, SF_SMALL).write.saveAsTable(f"{shop_db}.records")
    cli.main(["report", "--target", str(tmp_path / "out"), "--manufacturing-database", mfg_db,
              "--ecommerce-database", shop_db, "--records-table", f"{shop_db}.records", "--time-column", "ts"])
    docs = [json.loads(line) for p in (tmp_path / "out" / "integrated").glob("part-*.json") for line in p.open()]
    assert len(docs) == 1
    insights = docs[0]["cross_domain_insights"]
    assert 0.0 < insights["data_quality_composite"] <= 1.0
    assert docs[0]["ecommerce_metrics"]["total_customers_analyzed"] == \
        fixtures.ecommerce_processed(spark, SF_SMALL).select("customer_id").distinct().count()


def test_reference_shaped_tables(spark, tmp_path):
    """Tables with the documented columns only: text time column, no category, no channel, text measures, a bad table."""
    readings = spark.createDataFrame(
        [("m1", "2024-01-01T00:00:00", "90", "9", "1", "1", "2", "4"), ("m1", "2024-01-02T00:00:00", "1", "-1", "0", "0", "2", "4"),
         ("m2", "2024-01-01T00:00:00", "95", "9.5", "1", "0.9", "n/a", "4"), ("m3", None, "nan", "1", "1", "0", "0", "1")],
        "machine_id string, timestamp string, temperature string, vibration string, anomaly_flag string, "
        "downtime_risk string, energy_consumption string, predicted_remaining_life string")
    other = spark.createDataFrame([("m4", 3, 2.0, 8.0)], "machine_id string, err int, energy_consumption double, predicted_remaining_life double")
    more = spark.createDataFrame([("m4", "E7", 2.0, 8.0)], "machine_id string, err string, energy_consumption double, predicted_remaining_life double")
    shop = spark.createDataFrame([("c1", "$1,000", "9", "4", "2"), ("c1", "bad", "0.4", "5", None), (None, "$5", "0.9", "1", "1")],
                                 "customer_id string, purchase_amount string, customer_satisfaction string, "
                                 "product_rating string, time_to_decision string")
    records = spark.createDataFrame([("c1", "$10", "1", "1", "1")], "Customer_ID string, Purchase_Amount string, "
                                    "Frequency_of_Purchase string, Brand_Loyalty string, Customer_Satisfaction string")
    tables = {"a": readings, "b": other, "c": more, "d": spark.range(1).withColumnRenamed("id", "x")}
    run = manufacturing.run(spark, str(tmp_path / "mfg"), tables)
    assert set(run.skipped) == {"d"} and run.negative_vibration_rows == 1
    rolled = {r.machine_id: r for r in run.rollup.collect()}
    assert rolled["m1"].total_records == 2 and rolled["m4"].source_tables_count == 2 and "m2" not in rolled
    with pytest.raises(LookupError):
        manufacturing.build(spark, tables, strict=True)
    out = cross_domain.run(spark, str(tmp_path / "all"), tables, {"ecommerce": shop}, records).first()
    mfg, ecom = out.manufacturing_metrics, out.ecommerce_metrics
    assert (mfg.total_machines_analyzed, mfg.high_risk_machines, mfg.predicted_maintenance_events) == (4, 1, 2)
    assert (ecom.total_customers_analyzed, ecom.high_value_customers, ecom.most_popular_category) == (1, 1, None)
    assert mfg.timestamp > 1.6e9 and ecom.timestamp > 1.6e9 and out.timestamp > 1.6e9


def test_branches_run_side_by_side(spark):
    import threading
    both = threading.Barrier(2, timeout=60)

    def branch(n):
        def work():
            both.wait()   # passes only when the other branch runs too
            return spark.range(n).count(), spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return work

    assert cross_domain.in_parallel(spark, {"one": branch(5), "two": branch(7)}) == {"one": (5, "one"), "two": (7, "two")}


def test_a_failed_branch_cancels_the_other(spark):
    import threading
    import time
    started = threading.Event()

    def slow():
        started.set()
        return spark.range(0, 8, 1, 8).selectExpr("reflect('java.lang.Thread', 'sleep', 20000L)").collect()

    def fails():
        started.wait(30)
        time.sleep(2)
        raise LookupError("no tables")

    begin = time.time()
    with pytest.raises(LookupError):
        cross_domain.in_parallel(spark, {"slow": slow, "fails": fails})
    assert time.time() - begin < 15
    assert spark.range(3).count() == 3
