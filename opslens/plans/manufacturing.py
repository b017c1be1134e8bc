"""The manufacturing batch job as one lazy DataFrame chain.

discover (S7) -> tagged scans (S9) -> profile/skip/conform/union (F6, F7, U1)
-> efficiency (P14) -> drop incomplete (F4) -> processed table (S11) -> rollup
(A2-A4) from it -> rollup write (S10). ``run`` scans the source once: the
negative-vibration report (F5) and the row counts (N5) are observed while the
processed table is written, and the rollup reads that table.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opslens.operators.machine import ESSENTIALS, complete, drop_incomplete, negative_vibration_count, with_efficiency
from opslens.operators.rollup import machine_rollup
from opslens.sources.catalog import conform, discover_tables, load_tagged
from opslens.sources.sinks import BUCKETS, read_processed, write_processed, write_table

log = logging.getLogger(__name__)

# Domain types of the known measures; tables may store them as text or other numbers.
TYPES = {"temperature": "double", "vibration": "double", "anomaly_flag": "double", "downtime_risk": "double",
         "energy_consumption": "double", "predicted_remaining_life": "double"}


@dataclass
class ManufacturingRun:
    """A run's frames; after ``run`` also the counts taken while the processed table was written."""
    conformed: DataFrame
    processed: DataFrame
    rollup: DataFrame
    negative_vibration: DataFrame
    skipped: dict[str, str] = field(default_factory=dict)
    tables: list[str] = field(default_factory=list)
    negative_vibration_rows: int | None = None
    total_rows: int | None = None
    complete_rows: int | None = None


def build(spark: SparkSession, tables: Iterable[str] | Mapping[str, DataFrame] | None = None, *,
          database: str | None = None, prune_all_null: bool = True, strict: bool = False) -> ManufacturingRun:
    """The lazy E1 plan over ``tables`` (names or frames), or every table of ``database``.

    ``skipped`` of the result names the tables left out and why; with
    ``strict`` such a table fails the job.
    """
    if tables is None:
        tables = discover_tables(spark, database)
    skipped: dict[str, str] = {}
    loaded = load_tagged(spark, tables, database=database, skipped=skipped)
    if strict and skipped:
        raise LookupError(f"tables cannot be read: {skipped}")
    conformed = conform(loaded, essentials=ESSENTIALS, prune_all_null=prune_all_null, types=TYPES, strict=strict,
                        skipped=skipped)
    processed = drop_incomplete(with_efficiency(conformed))
    used = [name for name in loaded if name not in skipped]
    return ManufacturingRun(conformed, processed, machine_rollup(processed, tables=used),
                            negative_vibration_count(conformed), skipped, used)


def run(spark: SparkSession, target: str, tables: Iterable[str] | Mapping[str, DataFrame] | None = None, *,
        database: str | None = None, buckets: int = BUCKETS, strict: bool = False) -> ManufacturingRun:
    """Build and write: ``<target>/machine_aggregations`` and ``<target>/processed``.

    The returned run's ``processed`` and ``rollup`` are the stored tables;
    ``negative_vibration_rows`` is the reported count (null without the
    column), ``total_rows`` and ``complete_rows`` count the readings before
    and after incomplete ones are dropped.
    """
    plan = build(spark, tables, database=database, strict=strict)
    base = target.rstrip("/")
    seen = Observation()
    below = F.count_if(F.col("vibration") < 0) if "vibration" in plan.conformed.columns else F.lit(None).cast("bigint")
    watched = with_efficiency(plan.conformed).observe(
        seen, F.count(F.lit(1)).alias("total"), F.count_if(complete()).alias("complete"), below.alias("negative"))
    write_processed(drop_incomplete(watched), f"{base}/processed", "machine_id", buckets=buckets)
    counts = seen.get
    stored = read_processed(spark, f"{base}/processed")
    write_table(machine_rollup(stored, tables=plan.tables), f"{base}/machine_aggregations")
    log.info("readings with negative vibration: %s", counts["negative"])
    return replace(plan, processed=stored, rollup=spark.read.parquet(f"{base}/machine_aggregations"),
                   negative_vibration_rows=counts["negative"], total_rows=counts["total"], complete_rows=counts["complete"])
