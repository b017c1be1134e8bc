"""Cross-domain insight.

Both summaries are optional single rows. They are paired as two scalar
subqueries on a one-row anchor; a missing summary becomes a struct of nulls
(written as an empty object), and Spark itself enforces that each side has
at most one row. The formulas follow the source's operator order exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# Defaults used when a summary (or a field of it) is missing.
DEFAULT_TOTAL_MACHINES = 100
DEFAULT_TOTAL_CUSTOMERS = 1000
# Weights and divisor of the three scores.
EFFICIENCY_WEIGHT, SATISFACTION_WEIGHT, SATISFACTION_SCALE = 0.6, 0.4, 10
MACHINE_WEIGHT, CUSTOMER_WEIGHT = 0.5, 0.5
# The summary fields (source output contract).
MFG_SUMMARY_SCHEMA = StructType([
    StructField("total_machines_analyzed", LongType()), StructField("high_risk_machines", LongType()),
    StructField("medium_risk_machines", LongType()), StructField("low_risk_machines", LongType()),
    StructField("predicted_maintenance_events", LongType()),
    StructField("average_machine_efficiency", DoubleType()), StructField("data_quality_score", DoubleType()),
    StructField("timestamp", DoubleType())])
ECOM_SUMMARY_SCHEMA = StructType([
    StructField("total_customers_analyzed", LongType()), StructField("high_value_customers", LongType()),
    StructField("medium_value_customers", LongType()), StructField("standard_customers", LongType()),
    StructField("average_purchase_amount", DoubleType()), StructField("most_popular_category", StringType()),
    StructField("highest_roi_marketing_channel", StringType()),
    StructField("customer_satisfaction_index", DoubleType()), StructField("data_quality_score", DoubleType()),
    StructField("timestamp", DoubleType())])


def cross_domain_scores(pair: DataFrame) -> list[Column]:
    """X1-X3 over a row with struct columns ``mfg`` and ``ecom``.

    A field missing from a summary (or a missing summary) takes its default.
    """
    present = {side: set(pair.schema[side].dataType.fieldNames()) for side in ("mfg", "ecom")}

    def get(side: str, field: str, default) -> Column:
        value = F.col(f"{side}.{field}") if field in present[side] else F.lit(None)
        return F.coalesce(value, F.lit(default))

    opex = (get("mfg", "average_machine_efficiency", 0.0) * EFFICIENCY_WEIGHT
            + get("ecom", "customer_satisfaction_index", 0.0) / SATISFACTION_SCALE * SATISFACTION_WEIGHT)
    # plain ANSI division: a zero total raises, as the source's division does
    at_risk = get("mfg", "high_risk_machines", 0) / get("mfg", "total_machines_analyzed", DEFAULT_TOTAL_MACHINES)
    valued = get("ecom", "high_value_customers", 0) / get("ecom", "total_customers_analyzed", DEFAULT_TOTAL_CUSTOMERS)
    health = (F.lit(1) - at_risk) * MACHINE_WEIGHT + valued * CUSTOMER_WEIGHT
    quality = (get("mfg", "data_quality_score", 0.0) * MACHINE_WEIGHT
               + get("ecom", "data_quality_score", 0.0) * CUSTOMER_WEIGHT)
    return [opex.cast("double").alias("operational_excellence_score"),
            health.cast("double").alias("business_health_index"),
            quality.cast("double").alias("data_quality_composite")]


def _empty(schema: StructType) -> Column:
    """A struct whose fields are all null: serialised as ``{}``, the empty object."""
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def pair_summaries(spark: SparkSession, mfg: DataFrame | None, ecom: DataFrame | None) -> DataFrame:
    """One row with struct columns ``mfg`` and ``ecom``; a missing or empty summary is ``{}``."""
    def side(df: DataFrame | None, name: str, schema: StructType) -> Column:
        if df is None:
            return _empty(schema).alias(name)
        row = df.select(F.struct("*")).scalar()
        return F.coalesce(row, _empty(StructType(df.schema.fields))).alias(name)
    return spark.range(1).select(side(mfg, "mfg", MFG_SUMMARY_SCHEMA), side(ecom, "ecom", ECOM_SUMMARY_SCHEMA))


def integrate(spark: SparkSession, mfg: DataFrame | None, ecom: DataFrame | None) -> DataFrame:
    """``timestamp``, both summaries nested, and ``cross_domain_insights``.

    A missing summary is written as an empty object; the scores use defaults.
    """
    pair = pair_summaries(spark, mfg, ecom)
    return pair.select(
        (F.unix_micros(F.current_timestamp()) / 1e6).alias("timestamp"),
        F.col("mfg").alias("manufacturing_metrics"),
        F.col("ecom").alias("ecommerce_metrics"),
        F.struct(*cross_domain_scores(pair)).alias("cross_domain_insights"))


def cross_domain(spark: SparkSession, mfg: DataFrame | None, ecom: DataFrame | None) -> DataFrame:
    """X1-X3 as flat columns."""
    pair = pair_summaries(spark, mfg, ecom)
    return pair.select(*cross_domain_scores(pair))
