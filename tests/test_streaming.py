"""Stream processors: stream = batch, replay idempotence, union-header CSV."""

import csv
import glob

from pyspark.sql import functions as F

from conftest import SF_SMALL
from opslens.operators import ecommerce, machine
from opslens.plans import catalogue
from opslens.sources import envelopes, fixtures
from opslens.streaming import processors


COLUMNS = {"manufacturing": ("event_id", "machine_id", "ts", "temperature", "vibration", "anomaly_flag", "downtime_risk"),
           "ecommerce": ("order_key", "customer_id")}


def _run(spark, tmp_path, domain, lines, **more):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    lines.select("value").repartition(3).write.text(src)
    q = processors.start(spark, src, out, str(tmp_path / "ckpt"), domain, max_files_per_trigger=1,
                         columns=COLUMNS[domain], **more, **({"time_key": "ts"} if domain == "manufacturing" else {}))
    q.awaitTermination()
    assert q.exception() is None
    return out


def test_machine_stream_equals_batch(spark, tmp_path):
    lines = fixtures.machine_envelopes(spark, SF_SMALL)
    out = _run(spark, tmp_path, "manufacturing", lines)
    key = [F.col("record").getItem("event_id").alias("event_id"), F.col(machine.SCORE)]
    streamed = processors.read_records(spark, out, "manufacturing", COLUMNS["manufacturing"]).select(
        "event_id", F.col(machine.SCORE).cast("double").alias(machine.SCORE))
    batch = machine.score_machine_records(envelopes.decode_envelopes(lines, allow_bare=True)) \
        .where("keep").select(*key)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    stats = processors.read_stats(spark, out).agg(F.sum("total_records"), F.sum("processed_count")).first()
    assert stats[0] == lines.count() and stats[1] == batch.count()
    assert processors.read_stats(spark, out).count() == 3  # one micro-batch per file


def test_union_header_csv(spark, tmp_path):
    out = _run(spark, tmp_path, "manufacturing", fixtures.machine_envelopes(spark, SF_SMALL), union_header=True)
    first = sorted(glob.glob(f"{out}/csv/batch=*/part-*.csv"))[0]
    with open(first, newline="") as fh:
        header = next(csv.reader(fh))
    assert header == sorted(header)
    assert {"batch_id", "processing_timestamp", "maintenance_priority_score", "machine_id"} <= set(header)


def test_replayed_batch_is_idempotent(spark, tmp_path):
    lines = fixtures.customer_envelopes(spark, SF_SMALL).select("value")
    out = str(tmp_path / "out")
    keep = {"columns": COLUMNS["ecommerce"]}
    processors.process_customer_batch(lines, 7, out, **keep)
    first = processors.read_records(spark, out, "ecommerce", **keep).count()
    processors.process_customer_batch(lines, 7, out, **keep)
    assert processors.read_records(spark, out, "ecommerce", **keep).count() == first == lines.count() - \
        fixtures.customer_envelopes(spark, SF_SMALL).where(fixtures.spoiled(F.col("id"))).count()
    stats = processors.read_stats(spark, out).first()
    assert stats.failed_records == stats.total_records - stats.processed_count


def test_empty_outputs_read_as_empty(spark, tmp_path):
    out = str(tmp_path / "nothing")
    assert processors.read_records(spark, out, "manufacturing").count() == 0
    assert processors.read_alerts(spark, out).count() == 0
    assert processors.read_stats(spark, out).count() == 0


def test_restart_from_checkpoint_processes_only_new_files(spark, tmp_path):
    """A stopped query resumes from its checkpoint: nothing is lost or processed twice."""
    lines = fixtures.customer_envelopes(spark, SF_SMALL).select("value")
    first, second = lines.randomSplit([0.5, 0.5], seed=7)
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    first.coalesce(2).write.text(f"{src}/a")
    kwargs = {"available_now": False, "processing_time": "1 second"}

    q = processors.start(spark, f"{src}/*", out, ckpt, "ecommerce", **kwargs)
    q.processAllAvailable()
    q.stop()
    after_first = processors.read_stats(spark, out).agg(F.sum("total_records")).first()[0]

    second.coalesce(2).write.text(f"{src}/b")
    q = processors.start(spark, f"{src}/*", out, ckpt, "ecommerce", **kwargs)
    q.processAllAvailable()
    q.stop()
    stats = processors.read_stats(spark, out).agg(F.sum("total_records"), F.sum("processed_count")).first()
    assert after_first == first.count()
    assert stats[0] == lines.count()
    assert processors.read_records(spark, out, "ecommerce").count() == stats[1]


def test_other_fields_and_hostile_cells_survive(spark, tmp_path):
    """Undeclared fields are kept as JSON; quotes, blanks and line breaks come back as sent."""
    import base64
    import json
    recs = [{"customer_id": "1", "purchase_amount": ' "x"\n', "colour": "red, \"dark\""}, {"customer_id": " 2 "}]
    lines = [(json.dumps({"kinesis": {"data": base64.b64encode(json.dumps(r).encode()).decode()}}),) for r in recs]
    out = str(tmp_path / "o")
    processors.process_customer_batch(spark.createDataFrame(lines, "value string"), 0, out, columns=("customer_id", "purchase_amount"))
    got = {r.customer_id: r for r in processors.read_records(spark, out, "ecommerce", ("customer_id", "purchase_amount")).collect()}
    assert got["1"].purchase_amount == ' "x"\n' and json.loads(got["1"].other_fields) == {"colour": 'red, "dark"'}
    assert got[" 2 "].other_fields is None and got[" 2 "].purchase_amount is None


def test_a_backlog_is_never_one_batch(spark, tmp_path, monkeypatch):
    """Without a rate option the micro-batch is limited by bytes."""
    monkeypatch.setattr(processors, "MAX_BYTES_PER_TRIGGER", 1)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    fixtures.customer_envelopes(spark, SF_SMALL).select("value").repartition(3).write.text(src)
    q = processors.start(spark, src, out, str(tmp_path / "ckpt"), "ecommerce")
    q.awaitTermination()
    assert processors.read_stats(spark, out).count() == 3


def test_number_tokens_and_nan(spark, tmp_path):
    """A JSON number flag counts as its whole part, the same text does not; NaN raises no alert."""
    base = '{"machine_id":"%s","temperature":"%s","vibration":"1","anomaly_flag":%s}'
    lines = [(base % ("a", "9000", "1.0"),), (base % ("b", "9000", '"1.0"'),), (base % ("c", "nan", "1"),), (base % ("d", "9000", "true"),)]
    out = str(tmp_path / "o")
    processors.process_machine_batch(spark.createDataFrame(lines, "value string"), 0, out)
    kept = {r.machine_id for r in processors.read_records(spark, out, "manufacturing").collect()}
    assert kept == {"a", "c"} and [r.machine_id for r in processors.read_alerts(spark, out).collect()] == ["a"]


def test_a_half_written_batch_is_never_seen(spark, tmp_path, monkeypatch):
    """A batch killed between its sinks is invisible, first time or replayed, until it is written whole."""
    import pytest
    base = '{"machine_id":"%s","temperature":"9000","vibration":"1","anomaly_flag":1}'
    first = spark.createDataFrame([(base % "a",), (base % "b",)], "value string")
    out, write = str(tmp_path / "o"), processors._write_stats

    def seen():
        return (sorted(r.machine_id for r in processors.read_records(spark, out, "manufacturing").collect()),
                sorted(r.machine_id for r in processors.read_alerts(spark, out).collect()), processors.read_stats(spark, out).count())

    def killed(*args):
        raise RuntimeError("killed before the commit")

    for epoch in (0, 1):
        monkeypatch.setattr(processors, "_write_stats", killed)
        before = seen()
        with pytest.raises(RuntimeError):
            processors.process_machine_batch(first, epoch, out)
        assert seen() == before
        monkeypatch.setattr(processors, "_write_stats", write)
        processors.process_machine_batch(first, epoch, out)
        assert seen() == (sorted("ab" * (epoch + 1)), sorted("ab" * (epoch + 1)), epoch + 1)
    monkeypatch.setattr(processors, "_write_stats", killed)   # a replay of a committed batch
    with pytest.raises(RuntimeError):
        processors.process_machine_batch(first, 0, out)
    assert seen() == (["a", "b"], ["a", "b"], 1)


def test_union_header_is_bounded(spark, tmp_path, monkeypatch):
    import csv as csv_module
    import json
    monkeypatch.setattr(processors, "UNION_FIELDS", 3)
    lines = [(json.dumps({"machine_id": "m", "k": str(i), f"rare{i}": "x", "z": "1"}),) for i in range(40)]
    out = str(tmp_path / "o")
    processors.process_machine_batch(spark.createDataFrame(lines, "value string"), 0, out, union_header=True)
    rows = []
    for f in glob.glob(f"{out}/csv/batch=0/part-*.csv"):
        with open(f, newline="") as fh:
            rows += list(csv_module.DictReader(fh))
    assert len(rows) == 40 and {"machine_id", "k", "z", processors.OTHER_FIELDS} <= set(rows[0])
    assert not any(c.startswith("rare") for c in rows[0])
    assert sorted(next(iter(json.loads(r[processors.OTHER_FIELDS]))) for r in rows) == sorted(f"rare{i}" for i in range(40))


def test_stream_query_runs_only_its_own_stream(spark, tmp_path):
    """A table set without events serves the customer stream, which stores compressed files only."""
    rows = [(k, 1 + k % 7, 1000.5 * k) for k in range(1, 200)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double").write.parquet(
        str(tmp_path / "orders.parquet"))
    got = catalogue.QUERIES["stream_customers"](spark, str(tmp_path))
    scored = ecommerce.score_customer_records(ecommerce.as_record(fixtures.ecommerce_records(spark, str(tmp_path))))
    want = scored.where(~fixtures.spoiled(F.col("order_key"))).select(*got.columns)
    assert sorted(got.collect()) == sorted(want.collect())
    [base] = catalogue.stream_run(spark, str(tmp_path), "ecommerce")
    files = [f for s in ("source", "out/csv/batch=*") for f in glob.glob(f"{base.removeprefix('file:')}/{s}/part-*")]
    assert files and all(f.endswith(".gz") for f in files)
    assert glob.glob(f"{base.removeprefix('file:').rsplit('/', 1)[0]}/*") == [base.removeprefix("file:")]


def test_compressed_sink_reads_as_plain(spark, tmp_path):
    lines = fixtures.customer_envelopes(spark, SF_SMALL).select("value")
    keep = {"columns": COLUMNS["ecommerce"]}
    for name, more in (("plain", {}), ("packed", {"compression": "gzip"})):
        processors.process_customer_batch(lines, 0, str(tmp_path / name), **keep, **more)
    plain, packed = (processors.read_records(spark, str(tmp_path / n), "ecommerce", **keep).drop("processing_timestamp")
                     for n in ("plain", "packed"))
    assert sorted(plain.collect(), key=str) == sorted(packed.collect(), key=str) != []
    assert glob.glob(f"{tmp_path}/packed/csv/batch=0/part-*.csv.gz") and not glob.glob(f"{tmp_path}/plain/csv/batch=0/*.gz")


def test_committed_records_are_not_shuffled(spark, tmp_path):
    """The marks are broadcast whatever the session's limit for broadcasts."""
    out = str(tmp_path / "out")
    processors.process_customer_batch(fixtures.customer_envelopes(spark, SF_SMALL).select("value"), 0, out)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = processors.read_records(spark, out, "ecommerce")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
