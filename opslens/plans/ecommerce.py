"""The ecommerce batch job as one lazy DataFrame chain.

discover ``ecommerce*`` (S8) -> tagged scans (S9) -> union (U1) -> clean
(P3, P6) -> efficiency (P13) -> processed table (S11) -> rollup + segment
(A1, P12) and sample (S14) from it -> rollup write (S10).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from opslens.operators.ecommerce import clean_purchases, purchase_sample
from opslens.operators.rollup import customer_rollup
from opslens.sources.catalog import conform, discover_tables, load_tagged
from opslens.sources.sinks import BUCKETS, read_processed, write_processed, write_table

DEFAULT_TABLE = "ecommerce"
# Domain types of the known measures; the two text columns are parsed by the cleaning rules.
TYPES = {"purchase_amount": "string", "time_to_decision": "string", "customer_satisfaction": "double",
         "product_rating": "double"}


@dataclass
class EcommerceRun:
    processed: DataFrame
    rollup: DataFrame
    sample: DataFrame
    skipped: dict[str, str] = field(default_factory=dict)


def build(spark: SparkSession, tables: Iterable[str] | Mapping[str, DataFrame] | None = None, *,
          database: str | None = None, strict: bool = False) -> EcommerceRun:
    """The lazy E2 plan; ``skipped`` names tables that cannot be read (an error with ``strict``)."""
    if tables is None:
        tables = discover_tables(spark, database, pattern=f"{DEFAULT_TABLE}*", fallback=[DEFAULT_TABLE])
    skipped: dict[str, str] = {}
    loaded = load_tagged(spark, tables, database=database, skipped=skipped)
    if strict and skipped:
        raise LookupError(f"tables cannot be read: {skipped}")
    processed = clean_purchases(conform(loaded, types=TYPES))
    return EcommerceRun(processed, customer_rollup(processed), purchase_sample(processed), skipped)


def run(spark: SparkSession, target: str, tables: Iterable[str] | Mapping[str, DataFrame] | None = None, *,
        database: str | None = None, buckets: int = BUCKETS, strict: bool = False) -> EcommerceRun:
    """Build and write: ``<target>/processed``, and ``<target>/customer_aggregations`` from it.

    The returned run holds the stored tables, so later steps read those
    instead of the source.
    """
    plan = build(spark, tables, database=database, strict=strict)
    base = target.rstrip("/")
    write_processed(plan.processed, f"{base}/processed", "customer_id", buckets=buckets)
    processed = read_processed(spark, f"{base}/processed")
    write_table(customer_rollup(processed), f"{base}/customer_aggregations")
    return EcommerceRun(processed, spark.read.parquet(f"{base}/customer_aggregations"), purchase_sample(processed),
                        plan.skipped)
