"""The machine and customer stream processors.

Each processor is a ``foreachBatch`` body over a stream of envelope lines. A
micro-batch is decoded and scored by narrow transforms and written to

* ``csv/batch=<epoch>``      the processed records (S4/S5): declared columns, added
                             fields, and one JSON column for any other field
* ``alerts/batch=<epoch>``   machine alerts as JSON, only when there are any (S6)
* ``stats/batch=<epoch>``    per-batch counts (A5), observed while the records are written

The layout is fixed by the declared columns, so nothing about a batch's
fields has to reach the driver. ``union_header`` asks for a header made of
the batch's own fields instead: its UNION_FIELDS most frequent ones, the rest
in the JSON column, so a bounded number of names is collected.

Outputs are keyed by the micro-batch id and written with overwrite, so a
batch replayed after a failure replaces its own output instead of adding a
second copy. The statistics are written last and taken away first: they mark a
batch as committed, and the readers see records and alerts of committed
batches only, so a half-written batch is never visible. Records are
independent: there is no state, watermark or shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opslens.functions.numeric import above
from opslens.functions.scores import ALERT_THRESHOLD
from opslens.operators.ecommerce import score_customer_records
from opslens.operators.machine import JSON_TEXT, RAW_SCORE, SCORE, record_alerts, score_machine_records
from opslens.sources.envelopes import add_record_metadata, decode_envelopes
from opslens.sources.sinks import read_csv, write_csv

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ALERT_SCHEMA = ("machine_id string, alert_type string, score double, timestamp string, "
                "recommended_action string")
STATS_SCHEMA = ("epoch long, total_records long, processed_count long, failed_records long, "
                "alert_count long")
# The record fields of the two domains, and the fields a processor adds.
RECORD_COLUMNS = {
    "manufacturing": ("machine_id", "timestamp", "temperature", "vibration", "anomaly_flag", "downtime_risk",
                      "energy_consumption", "predicted_remaining_life", "ingest_timestamp"),
    "ecommerce": ("Customer_ID", "Purchase_Amount", "Frequency_of_Purchase", "Brand_Loyalty", "Customer_Satisfaction",
                  "ingest_timestamp"),
}
ADDED_COLUMNS = {
    "manufacturing": ("processing_timestamp", "batch_id", SCORE),
    "ecommerce": ("processing_timestamp", "customer_value_score", "customer_segment"),
}
OTHER_FIELDS = "other_fields"
# Most fields of a batch that ``union_header`` gives columns of their own.
UNION_FIELDS = 500
# Default size of a micro-batch, by bytes for file sources and by messages for Kafka.
MAX_BYTES_PER_TRIGGER = 1 << 30
MAX_OFFSETS_PER_TRIGGER = 5_000_000
RATE_OPTIONS = ("maxFilesPerTrigger", "maxBytesPerTrigger", "maxOffsetsPerTrigger")


def _batch_path(out: str, sink: str, epoch_id: int) -> str:
    return f"{out.rstrip('/')}/{sink}/batch={epoch_id}"


def csv_columns(domain: str, columns: Sequence[str] | None = None) -> list[str]:
    """Columns of the record sink in order."""
    return [*(columns or RECORD_COLUMNS[domain]), *ADDED_COLUMNS[domain], OTHER_FIELDS]


def declared_layout(columns: Sequence[str], added: dict[str, Column], record_col: str = "record") -> list[Column]:
    """Declared fields, added fields, and the rest of the record as one JSON object (null when there is none)."""
    rec = F.col(record_col)
    rest = F.map_filter(rec, lambda k, _: ~k.isin(*columns, *added))
    return [*[rec.getItem(c).alias(c) for c in columns], *[v.alias(k) for k, v in added.items()],
            F.when(F.size(rest) > 0, F.to_json(rest)).alias(OTHER_FIELDS)]


def union_layout(records: DataFrame, added: dict[str, Column], record_col: str = "record") -> list[Column]:
    """Sorted union of the batch's record fields and the added ones.

    Beyond UNION_FIELDS names the most frequent ones (ties by name) are
    columns and the others go to the JSON column, which only then exists.
    """
    names = (records.select(F.explode(F.map_keys(record_col)).alias("k")).groupBy("k").count()
             .orderBy(F.desc("count"), "k").limit(UNION_FIELDS + 1).collect())
    keys = {r["k"] for r in names[:UNION_FIELDS]}
    rec = F.col(record_col)
    columns = [(added[k] if k in added else rec.getItem(k)).alias(k) for k in sorted(keys | set(added))]
    if len(names) <= UNION_FIELDS:
        return columns
    rest = F.map_filter(rec, lambda k, _: ~k.isin(*keys, *added))
    return [*columns, F.when(F.size(rest) > 0, F.to_json(rest)).alias(OTHER_FIELDS)]


def _write_stats(spark: SparkSession, out: str, epoch_id: int, total: int, processed: int, alerts: int | None) -> None:
    """A5, written last: the batch is committed by it."""
    row = spark.createDataFrame([(epoch_id, total, processed, total - processed, alerts)], STATS_SCHEMA)
    row.coalesce(1).write.mode("overwrite").json(_batch_path(out, "stats", epoch_id))


def _begin(spark: SparkSession, out: str, epoch_id: int) -> None:
    """Take the commit mark of a replayed batch away before its sinks are overwritten."""
    path = _batch_path(out, "stats", epoch_id)
    try:
        spark.read.schema(STATS_SCHEMA).json(path)   # resolves the folder, runs nothing
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return
        raise
    spark.createDataFrame([], STATS_SCHEMA).write.mode("overwrite").json(path)


def process_machine_batch(batch: DataFrame, epoch_id: int, out: str, *, columns: Sequence[str] | None = None,
                          union_header: bool = False, time_key: str = "timestamp",
                          compression: str | None = None) -> None:
    """T1 on one micro-batch: D1-D4, F1-F3, P5, P7, P9, P15 -> records, alerts, stats.

    ``compression`` is the codec of the record files (plain CSV by default).
    """
    _begin(batch.sparkSession, out, epoch_id)
    staged = score_machine_records(add_record_metadata(
        decode_envelopes(batch, allow_bare=True, keep_failed=True, json_col=JSON_TEXT))).drop(JSON_TEXT)
    staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
    good = F.col("decoded") & F.col("keep")
    try:
        seen = Observation()
        records = staged.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(good).alias("processed"),
                                 F.count_if(good & above(F.col(RAW_SCORE), ALERT_THRESHOLD)).alias("alerts")).where(good)
        added = {"processing_timestamp": F.date_format("processing_timestamp", ISO_FORMAT),
                 "batch_id": F.col("batch_id"), SCORE: F.col(SCORE)}
        layout = (union_layout(staged.where(good), added) if union_header
                  else declared_layout(columns or RECORD_COLUMNS["manufacturing"], added))
        write_csv(records.select(*layout), _batch_path(out, "csv", epoch_id), compression)
        counts = seen.get
        if counts["alerts"]:
            (record_alerts(staged.where(good), time_key=time_key).write.mode("overwrite")
             .json(_batch_path(out, "alerts", epoch_id)))
        _write_stats(batch.sparkSession, out, epoch_id, counts["total"], counts["processed"], counts["alerts"])
    finally:
        staged.unpersist()


def process_customer_batch(batch: DataFrame, epoch_id: int, out: str, *, columns: Sequence[str] | None = None,
                           union_header: bool = False, compression: str | None = None) -> None:
    """T2 on one micro-batch: D1, D3, D4, P1, P2, P4, P8-P11 -> records, stats.

    An undecodable envelope is dropped (counted as failed); a decoded record
    whose fields do not parse is kept with the ``ERROR`` segment.
    ``compression`` is the codec of the record files (plain CSV by default).
    """
    _begin(batch.sparkSession, out, epoch_id)
    staged = score_customer_records(decode_envelopes(batch, allow_bare=False, keep_failed=True))
    seen = Observation()
    records = staged.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if("decoded").alias("processed")).where("decoded")
    added = {"processing_timestamp": F.date_format("processing_timestamp", ISO_FORMAT),
             "customer_value_score": F.col("customer_value_score"), "customer_segment": F.col("customer_segment")}
    layout = (union_layout(staged.where("decoded"), added) if union_header
              else declared_layout(columns or RECORD_COLUMNS["ecommerce"], added))
    write_csv(records.select(*layout), _batch_path(out, "csv", epoch_id), compression)
    counts = seen.get
    _write_stats(batch.sparkSession, out, epoch_id, counts["total"], counts["processed"], None)


def start(spark: SparkSession, source_dir: str, out: str, checkpoint: str, domain: str, *,
          max_files_per_trigger: int | None = None, available_now: bool = True,
          processing_time: str | None = None, source_format: str = "text",
          source_options: dict[str, str] | None = None, **kwargs) -> StreamingQuery:
    """S3: stream envelope lines through a processor.

    The default source is text files under ``source_dir`` (one envelope per
    line). Any streaming source with a ``value`` column works the same way,
    e.g. ``source_format="kafka"`` with its options, whose binary ``value`` is
    read as UTF-8 text. A micro-batch is limited by size (bytes of files, or
    Kafka messages) unless a rate option is given, so a backlog is never one
    batch. ``available_now`` drains what is there in as many micro-batches as
    that gives and stops; otherwise the query runs on ``processing_time``. The
    checkpoint records source offsets, so a restarted query resumes from the
    last committed micro-batch and replays it into the same output folder.
    """
    body = {"manufacturing": process_machine_batch, "ecommerce": process_customer_batch}[domain]
    options = dict(source_options or {})
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if not any(o in options for o in RATE_OPTIONS):
        if source_format == "kafka":
            options["maxOffsetsPerTrigger"] = str(MAX_OFFSETS_PER_TRIGGER)
        else:
            options["maxBytesPerTrigger"] = str(MAX_BYTES_PER_TRIGGER)
    reader = spark.readStream.format(source_format).options(**options)
    stream = reader.load(source_dir) if source_dir else reader.load()
    stream = stream.select(F.col("value").cast("string").alias("value"))
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch_id: body(df, epoch_id, out, **kwargs))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time or "10 seconds")
    return writer.start()


def _read_sink(spark: SparkSession, out: str, sink: str, schema: str) -> DataFrame:
    """A JSON sink folder with its batch numbers; empty when no micro-batch has written to it yet."""
    try:
        return spark.read.schema(f"{schema}, batch long").json(f"{out.rstrip('/')}/{sink}")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], f"{schema}, batch long")
        raise


def committed(df: DataFrame, out: str) -> DataFrame:
    """The rows of committed batches; ``df`` has the column ``batch`` of a sink folder.

    The marks, one number per batch, are broadcast, so no record is shuffled.
    """
    marks = _read_sink(df.sparkSession, out, "stats", STATS_SCHEMA).select("batch").distinct()
    return df.join(F.broadcast(marks), "batch", "left_semi")


def read_records(spark: SparkSession, out: str, domain: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Processed records of every committed micro-batch as text columns (empty when there is none)."""
    names = csv_columns(domain, columns)
    try:
        return committed(read_csv(spark, f"{out.rstrip('/')}/csv", names), out).select(*names)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in names))
        raise


def read_alerts(spark: SparkSession, out: str) -> DataFrame:
    """Alerts of every committed micro-batch."""
    return committed(_read_sink(spark, out, "alerts", ALERT_SCHEMA), out).drop("batch")


def read_stats(spark: SparkSession, out: str) -> DataFrame:
    """Statistics of every committed micro-batch."""
    return _read_sink(spark, out, "stats", STATS_SCHEMA).drop("batch")
