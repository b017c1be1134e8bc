"""The query catalogue: one callable per operator group, ``(spark, sf_dir) -> DataFrame``.

Each query reads whole tables through the fixtures and returns a lazy
DataFrame whose column names match the oracle SQL. Integer outputs are
BIGINT, fractional outputs DOUBLE, so schemas line up across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.functions.numeric import round_half_up
from opslens.operators import ecommerce, insight, machine, rollup, summary
from opslens.plans import cross_domain as cross_domain_plan
from opslens.plans import ecommerce as ecommerce_plan
from opslens.plans import manufacturing
from opslens.session import scratch_path
from opslens.sources import catalog, envelopes, fixtures, sinks
from opslens.streaming import processors

Query = Callable[[SparkSession, str], DataFrame]
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Decimals to which sums and averages are compared: double sums depend on the
# order of the rows, so their last bits differ between engines.
COMPARED_DECIMALS = 6


def _compared(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: round_half_up(F.col(c), COMPARED_DECIMALS) for c in cols})


def _kind(score) -> F.Column:
    """finite, nan, inf or none: what a comparison of hashes cannot be trusted with."""
    return (F.when(score.isNull(), "none").when(F.isnan(score), "nan").when(F.abs(score) == float("inf"), "inf")
            .otherwise("finite"))


def _finite(score) -> F.Column:
    return F.when(_kind(score) == "finite", score)


@register
def machine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = machine.score_readings(fixtures.machine_readings(spark, sf_dir))
    return scored.select("machine_id", "order_key", F.col("line_no").cast("bigint").alias("line_no"),
                         machine.RAW_SCORE, machine.SCORE)


@register
def machine_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = machine.score_readings(fixtures.machine_readings(spark, sf_dir))
    return machine.high_priority_alerts(scored)


@register
def machine_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = machine.drop_incomplete(machine.with_efficiency(fixtures.machine_readings(spark, sf_dir)))
    return df.select("machine_id", "order_key", F.col("line_no").cast("bigint").alias("line_no"),
                     "machine_efficiency")


@register
def negative_vibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machine.negative_vibration_count(fixtures.machine_readings(spark, sf_dir))


# --- manufacturing batch (E1) ----------------------------------------------

def _bigint(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols if c in df.columns})


@register
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = manufacturing.build(spark, fixtures.mfg_tables(spark, sf_dir))
    return _bigint(run.conformed, "line_no")


@register
def machine_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = manufacturing.build(spark, fixtures.mfg_tables(spark, sf_dir)).rollup
    return _compared(rolled, *[c for c in rolled.columns if c.startswith("avg_")])


@register
def etl_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 as run: the counts observed during the one scan of the source, beside those of the stored tables."""
    run = manufacturing.run(spark, scratch_path(spark, "mfg-run"), fixtures.mfg_tables(spark, sf_dir))
    seen = {c: F.lit(getattr(run, c)).cast("bigint").alias(c)
            for c in ("negative_vibration_rows", "total_rows", "complete_rows")}
    return run.rollup.agg(F.sum("total_records").alias("stored_rows"), F.sum("total_anomalies").alias("anomalies")).select(
        *seen.values(), "stored_rows", "anomalies")


@contextmanager
def _mfg_database(spark: SparkSession, sf_dir: str) -> Iterator[str]:
    """A scratch database with the manufacturing tables as Parquet files, and one table whose file is none.

    It is dropped again; the tables are external, so plans over them go on.
    """
    db = f"opslens_{uuid.uuid4().hex[:10]}"
    files = scratch_path(spark, f"{db}-files")   # outside the database's own folder, which goes with it
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    try:
        for name, df in fixtures.mfg_tables(spark, sf_dir).items():
            df.write.option("path", f"{files}/{name}").saveAsTable(f"{db}.{name}")
        spark.range(1).select(F.lit("not a table file").alias("value")).write.text(f"{files}/mfg_broken")
        spark.sql(f"CREATE TABLE {db}.mfg_broken (machine_id BIGINT, energy_consumption DOUBLE, predicted_remaining_life DOUBLE) "
                  f"USING parquet LOCATION '{files}/mfg_broken'")
        yield db
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


@register
def skipped_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with an unreadable file and one without the essential columns are skipped, the others read."""
    with _mfg_database(spark, sf_dir) as db:
        run = manufacturing.build(spark, database=db)
        used = run.conformed.groupBy(F.col("source_table").alias("table_name")).agg(
            F.lit("read").alias("status"), F.count(F.lit(1)).alias("rows"))
        rows = [(name, "cannot be read" if reason.startswith("cannot be read") else "missing essential columns", None)
                for name, reason in run.skipped.items()]
        return used.unionByName(spark.createDataFrame(rows, "table_name string, status string, rows bigint"))


@register
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 over stored tables: which columns have a value, from the file footers."""
    with _mfg_database(spark, sf_dir) as db:
        names = [t for t in catalog.discover_tables(spark, db) if t != "orders"]
        tables = catalog.load_tagged(spark, names, database=db)
        present = catalog.non_null_columns_by_table(tables)
        rows = [(name, c, c in present[name]) for name, df in tables.items() for c in df.columns]
        return spark.createDataFrame(rows, "table_name string, column_name string, present boolean")


# --- ecommerce stream scoring and batch (E2) -------------------------------

@register
def customer_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = ecommerce.as_record(fixtures.odd_amounts(fixtures.ecommerce_records(spark, sf_dir)))
    score = F.col("customer_value_score")
    return ecommerce.score_customer_records(recs).select(
        "order_key", "customer_id", _finite(score).alias("customer_value_score"), _kind(score).alias("score_kind"),
        "customer_segment")


@register
def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (customer_scores(spark, sf_dir).groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("records")))


@register
def purchase_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ecommerce.clean_purchases(fixtures.ecommerce_processed(spark, sf_dir)).select(
        "order_key", "customer_id", "cleaned_purchase_amount", "cleaned_time_to_decision",
        "purchase_efficiency")


@register
def customer_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {ecommerce_plan.DEFAULT_TABLE: fixtures.ecommerce_processed(spark, sf_dir)}
    return _compared(ecommerce_plan.build(spark, tables).rollup, "total_purchase_amount", "avg_purchase_amount",
                     "avg_satisfaction", "avg_product_rating")


@register
def bucketed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 + A1: the processed table as a bucketed catalog table; its rollup needs no shuffle."""
    db = f"opslens_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    try:
        tables = {ecommerce_plan.DEFAULT_TABLE: fixtures.ecommerce_processed(spark, sf_dir)}
        stored = sinks.write_bucketed(ecommerce_plan.build(spark, tables).processed, f"{db}.processed", "customer_id",
                                      path=scratch_path(spark, f"{db}-files"), buckets=8)
        return _compared(rollup.customer_rollup(stored), "total_purchase_amount", "avg_purchase_amount",
                         "avg_satisfaction", "avg_product_rating")
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


@register
def purchase_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {ecommerce_plan.DEFAULT_TABLE: fixtures.ecommerce_processed(spark, sf_dir)}
    return ecommerce_plan.build(spark, tables).sample


# --- decoding and streaming (D1-D4, T1, T2, S3-S6, A5) ----------------------

EVENT_TYPES = {"event_id": "bigint", "machine_id": "bigint", "ts": "timestamp_ntz", "temperature": "double",
               "vibration": "double", "anomaly_flag": "bigint", "downtime_risk": "double"}


def _typed_machine(record_col: str = "record") -> list:
    return [F.col(record_col).getItem(c).try_cast(t).alias(c) for c, t in EVENT_TYPES.items()]


@register
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.machine_envelopes(spark, sf_dir)
    decoded = envelopes.decode_envelopes(lines, allow_bare=True)
    return decoded.select("key", *_typed_machine())


@register
def record_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.machine_envelopes(spark, sf_dir)
    meta = envelopes.add_record_metadata(envelopes.decode_envelopes(lines, allow_bare=True))
    # well-formedness per record instead of a distinct count, which would
    # shuffle every id of the stream just to re-check uuid() uniqueness
    return meta.agg(F.count(F.lit(1)).alias("records"),
                    F.count_if(F.col("batch_id").rlike(UUID_PATTERN)).alias("uuid_records"),
                    F.count("processing_timestamp").alias("stamped_records"))


@register
def unscorable_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.perturbed_machine_envelopes(spark, sf_dir)
    decoded = envelopes.decode_envelopes(lines, allow_bare=True, json_col=machine.JSON_TEXT)
    scored = machine.score_machine_records(decoded).where("keep")
    score = F.col(machine.SCORE)
    return scored.select(F.col("record").getItem("event_id").try_cast("bigint").alias("event_id"), "scorable",
                         _finite(score).alias(machine.SCORE), _kind(score).alias("score_kind"))


STREAM_DOMAINS = ("manufacturing", "ecommerce")
# Fields of the records that the streams carry here.
STREAM_COLUMNS = {"manufacturing": tuple(EVENT_TYPES),
                  "ecommerce": ("order_key", "customer_id", "purchase_amount", "frequency_of_purchase", "brand_loyalty",
                                "customer_satisfaction")}
# Lines per source file: the number of files, and so a batch's parallelism, follows the data.
LINES_PER_FILE = 25_000
# Codec of the source files and of the CSV sink; JSON in base64 shrinks to a fraction.
STREAM_CODEC = "gzip"
# Bytes of compressed files in a micro-batch: gzip shrank these lines about 12-fold, so it is the default size unpacked.
STREAM_BATCH_BYTES = processors.MAX_BYTES_PER_TRIGGER // 12
_STREAM_RUNS: dict[tuple[str, str, str], str] = {}


def write_stream_sources(spark: SparkSession, sf_dir: str, base: str, domains: Sequence[str] = STREAM_DOMAINS) -> None:
    """Envelope lines derived from the tables, as compressed text files."""
    lines = {"manufacturing": fixtures.machine_envelopes, "ecommerce": fixtures.customer_envelopes}
    for domain in domains:
        (lines[domain](spark, sf_dir).select("value").write.mode("overwrite").option("maxRecordsPerFile", LINES_PER_FILE)
         .option("compression", STREAM_CODEC).text(f"{base}/{domain}/source"))


def process_streams(spark: SparkSession, base: str, domains: Sequence[str] = STREAM_DOMAINS) -> None:
    """Drain the sources with an available-now trigger; the streams run concurrently, as one query each."""
    started = [processors.start(spark, f"{base}/{d}/source", f"{base}/{d}/out", f"{base}/{d}/checkpoint", d,
                                source_options={"maxBytesPerTrigger": str(STREAM_BATCH_BYTES)},
                                columns=STREAM_COLUMNS[d], compression=STREAM_CODEC,
                                **({"time_key": "ts"} if d == "manufacturing" else {}))
               for d in domains]
    for q in started:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def stream_run(spark: SparkSession, sf_dir: str, *domains: str) -> list[str]:
    """The folders of the domains' stream processors over envelope files derived from the tables.

    A query names the streams whose output it reads and only those run, each
    once per application and scale: the stream queries share the runs.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    missing = [d for d in domains if (*key, d) not in _STREAM_RUNS]
    if missing:
        base = scratch_path(spark, "streams")
        write_stream_sources(spark, sf_dir, base, missing)
        process_streams(spark, base, missing)
        _STREAM_RUNS.update({(*key, d): f"{base}/{d}" for d in missing})
    return [_STREAM_RUNS[(*key, d)] for d in domains]


def _stream_records(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    """The CSV record sink of one stream (S4, S5), read back."""
    [base] = stream_run(spark, sf_dir, domain)
    return processors.read_records(spark, f"{base}/out", domain, STREAM_COLUMNS[domain])


@register
def stream_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _stream_records(spark, sf_dir, "manufacturing")
    return recs.select(*[F.col(c).try_cast(t).alias(c) for c, t in EVENT_TYPES.items()],
                       F.col(machine.SCORE).try_cast("double").alias(machine.SCORE))


@register
def stream_machines_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the machine stream's CSV output, and that the added cells are filled."""
    recs = _stream_records(spark, sf_dir, "manufacturing")
    return recs.select(*[F.col(c) for c in ("event_id", "machine_id", "anomaly_flag", processors.OTHER_FIELDS)],
                       F.col("batch_id").rlike(UUID_PATTERN).alias("has_batch_id"),
                       F.col("processing_timestamp").try_cast("timestamp").isNotNull().alias("has_time"),
                       F.round(F.col("temperature").cast("double"), 6).alias("temperature"))


@register
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    [base] = stream_run(spark, sf_dir, "manufacturing")
    alerts = processors.read_alerts(spark, f"{base}/out")
    return alerts.select(F.col("machine_id").try_cast("bigint").alias("machine_id"), "alert_type", "score",
                         F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp"), "recommended_action")


@register
def stream_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _stream_records(spark, sf_dir, "ecommerce")
    return recs.select(*[F.col(c).try_cast("bigint").alias(c) for c in ("order_key", "customer_id")],
                       F.col("customer_value_score").try_cast("double").alias("customer_value_score"), "customer_segment")


@register
def stream_customers_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the customer stream's CSV output; amounts hold ``$`` and commas."""
    recs = _stream_records(spark, sf_dir, "ecommerce")
    return recs.select(*STREAM_COLUMNS["ecommerce"], "customer_segment", processors.OTHER_FIELDS,
                       F.col("processing_timestamp").try_cast("timestamp").isNotNull().alias("has_time"))


@register
def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [processors.read_stats(spark, f"{base}/out").withColumn("stream", F.lit(d))
             for d, base in zip(STREAM_DOMAINS, stream_run(spark, sf_dir, *STREAM_DOMAINS), strict=True)]
    counts = ("total_records", "processed_count", "failed_records", "alert_count")
    return reduce(DataFrame.unionByName, parts).groupBy("stream").agg(*[F.sum(c).alias(c) for c in counts])


# --- sinks and sources that need a path (S1, S10-S13, A6) -------------------

@register
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 over cells with quotes, blanks, commas and line breaks."""
    path = scratch_path(spark, "raw-csv")
    key = F.col("order_key")
    note = (F.when(key % 3 == 0, F.concat(F.lit('  said "'), key, F.lit('", twice "" ')))
            .when(key % 3 == 1, F.concat(F.lit("one,\ntwo "), key)))
    recs = fixtures.ecommerce_records(spark, sf_dir).withColumn("note", note)
    sinks.write_csv(recs, path)
    raw = sinks.read_raw_csv(spark, path)
    return raw.select(*recs.columns, F.col("ingest_timestamp").isNotNull().alias("stamped"))


@register
def rollup_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer-aggregations")
    sinks.write_table(customer_rollup(spark, sf_dir), path)
    return spark.read.parquet(path)


@register
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the processed machine table, written in buckets and read back."""
    path = scratch_path(spark, "machines-processed")
    sinks.write_processed(machine.drop_incomplete(machine.with_efficiency(fixtures.machine_readings(spark, sf_dir))),
                          path, "machine_id")
    return _bigint(sinks.read_processed(spark, path), "line_no", "anomaly_flag")


@register
def table_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7/S8 over a scratch database of external tables on the test files.

    The database is dropped again: the plans already know their files, and
    dropping an external table leaves them.
    """
    db = f"opslens_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    try:
        for name, source in (("ecommerce", "orders"), ("ecommerce_events", "events"), ("machines", "lineitem")):
            spark.catalog.createTable(f"{db}.{name}", path=f"{sf_dir.rstrip('/')}/{source}.parquet", source="parquet")
        found = {"all": catalog.discover_tables(spark, db),
                 "prefix": catalog.discover_tables(spark, db, pattern="ecommerce*", fallback=["ecommerce"])}
        parts = [df.agg(F.lit(mode).alias("discovery"), F.lit(name).alias("table_name"),
                        F.count(F.lit(1)).alias("rows"))
                 for mode, names in found.items()
                 for name, df in catalog.load_tagged(spark, names, database=db).items()]
        return reduce(DataFrame.unionByName, parts)
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


# --- summaries and the cross-domain report (N1-N11, S12, S13, J1, X1-X4, E3) -

def _ecommerce_inputs(spark: SparkSession, sf_dir: str):
    return ({ecommerce_plan.DEFAULT_TABLE: fixtures.ecommerce_processed(spark, sf_dir)},
            fixtures.ecommerce_records(spark, sf_dir))


MFG_MEANS = ("average_machine_efficiency", "data_quality_score")
ECOM_MEANS = ("average_purchase_amount", "customer_satisfaction_index", "data_quality_score")
SCORES = ("operational_excellence_score", "business_health_index", "data_quality_composite")


@register
def machine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(summary.machine_summary(fixtures.machine_readings(spark, sf_dir)), *MFG_MEANS)


@register
def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, records = _ecommerce_inputs(spark, sf_dir)
    run = ecommerce_plan.build(spark, tables)
    scored = ecommerce.score_customer_records(ecommerce.as_record(records))
    return _compared(summary.customer_summary(run.processed, scored), *ECOM_MEANS)


@register
def latest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 twice (a partial summary, then the full one), S13 picks the newer."""
    path = scratch_path(spark, "mfg-summary")
    readings = fixtures.machine_readings(spark, sf_dir)
    sinks.write_summary(summary.machine_summary(readings.where(F.col("line_no") <= 3)), path)
    sinks.write_summary(summary.machine_summary(readings), path)
    return _compared(sinks.latest_summary(spark, path, insight.MFG_SUMMARY_SCHEMA).drop("timestamp"), *MFG_MEANS)


@register
def cross_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, records = _ecommerce_inputs(spark, sf_dir)
    mfg, ecom = cross_domain_plan.summaries(spark, fixtures.machine_readings(spark, sf_dir), tables, records,
                                            time_col="ts")
    return _compared(insight.cross_domain(spark, mfg, ecom), *SCORES)


@register
def integrated_insight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 as a chain: both ETL jobs and their writes, summaries through storage (S12, S13), J1, X1-X4."""
    tables, records = _ecommerce_inputs(spark, sf_dir)
    whole = cross_domain_plan.run(spark, scratch_path(spark, "insight"), fixtures.mfg_tables(spark, sf_dir), tables,
                                  records, time_col="ts")
    stamped = [F.col(c).isNotNull().alias(f"has_{n}") for n, c in (
        ("timestamp", "timestamp"), ("mfg_timestamp", "manufacturing_metrics.timestamp"),
        ("ecom_timestamp", "ecommerce_metrics.timestamp"))]
    flat = whole.select(
        *stamped, "cross_domain_insights.*",
        *[F.col(f"manufacturing_metrics.{f}").alias(f"mfg_{f}") for f in insight.MFG_SUMMARY_SCHEMA.fieldNames() if f != "timestamp"],
        *[F.col(f"ecommerce_metrics.{f}").alias(f"ecom_{f}") for f in insight.ECOM_SUMMARY_SCHEMA.fieldNames() if f != "timestamp"])
    return _compared(flat, *SCORES, *[f"mfg_{c}" for c in MFG_MEANS], *[f"ecom_{c}" for c in ECOM_MEANS])
