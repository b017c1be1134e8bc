"""Domain summaries (N1-N11): one-row DataFrames computed from the data.

The source's summary functions return fixed sample numbers; only the output
contract is fixed there, so the definitions below are ours (SURVEY 2.7).
Each summary is built from grouped partial aggregates (skew-safe, one
shuffle per grouping) and single-row scalar subqueries, so nothing larger
than one row per group ever meets another row in a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampType

from opslens.functions.numeric import above, safe_ratio
from opslens.functions.scores import ALERT_THRESHOLD, EFFICIENCY_CAP, ERROR_SEGMENT, RISK_THRESHOLDS, etl_segment
from opslens.operators.machine import ESSENTIALS, RAW_SCORE, score_readings, with_efficiency


def _time_micros(dtype: DataType, ts: F.Column) -> F.Column:
    """Microseconds since the epoch, independent of the session time zone."""
    if isinstance(dtype, TimestampType):
        return F.unix_micros(ts)
    if isinstance(dtype, StringType):
        ts = ts.try_cast("timestamp_ntz")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))


def _one_row(spark, **fields: DataFrame) -> DataFrame:
    """Single-row DataFrame whose struct columns are scalar subqueries (<= 1 row each)."""
    return spark.range(1).select(*[df.select(F.struct("*")).scalar().alias(name) for name, df in fields.items()])


def machine_summary(readings: DataFrame, *, key: str = "machine_id", time_col: str = "ts") -> DataFrame:
    """N1-N5 over typed machine readings.

    * machines analysed: distinct non-null machines
    * high / medium / low risk: tier of each machine's latest unrounded score
      (latest by time, ties to the higher score): > 0.7, > 0.4, else low.
      Readings without a time do not count as latest.
    * predicted maintenance events: readings above the alert threshold
    * average machine efficiency: mean efficiency of complete readings / 500
    * data quality: complete readings / all readings
    """
    high, mid = RISK_THRESHOLDS
    scored = score_readings(with_efficiency(readings))
    # The latest reading's tier as one BIGINT, time * 4 + tier: the maximum is the
    # latest reading, and on a time tie the higher tier (the tier grows with the
    # score). A plain max over a long keeps the aggregate hash-based; ordering by a
    # (time, score) struct would force a sort-based aggregate over all rows.
    raw = F.col(RAW_SCORE)
    tier_code = F.when(above(raw, high), 2).when(above(raw, mid), 1).otherwise(0)
    latest_key = _time_micros(scored.schema[time_col].dataType, F.col(time_col)) * 4 + tier_code
    complete = F.lit(True)
    for c in ESSENTIALS:
        complete = complete & F.col(c).isNotNull()
    efficiency = F.when(complete, F.col("machine_efficiency"))
    per_machine = scored.groupBy(key).agg(
        F.max(latest_key).alias("latest_key"),
        F.count_if(above(F.col(RAW_SCORE), ALERT_THRESHOLD)).alias("alerts"),
        F.count(F.lit(1)).alias("readings"),
        F.count_if(complete).alias("complete"),
        F.sum(efficiency).alias("eff_sum"),
        F.count(efficiency).alias("eff_n"),
    )
    known = F.col(key).isNotNull()
    latest_tier = F.coalesce(F.pmod(F.col("latest_key"), F.lit(4)), F.lit(0))
    return per_machine.agg(
        F.count_if(known).alias("total_machines_analyzed"),
        F.count_if(known & (latest_tier == 2)).alias("high_risk_machines"),
        F.count_if(known & (latest_tier == 1)).alias("medium_risk_machines"),
        F.count_if(known & (latest_tier == 0)).alias("low_risk_machines"),
        F.sum("alerts").alias("predicted_maintenance_events"),
        (safe_ratio(F.sum("eff_sum"), F.sum("eff_n")) / EFFICIENCY_CAP).alias("average_machine_efficiency"),
        safe_ratio(F.sum("complete"), F.sum("readings")).alias("data_quality_score"),
    )


def customer_summary(processed: DataFrame, scored_records: DataFrame, *, key: str = "customer_id",
                     category_col: str = "purchase_category",
                     channel_col: str = "marketing_channel") -> DataFrame:
    """N6-N11.

    ``processed`` is the cleaned ETL table, ``scored_records`` the
    stream-scored records.

    * customers analysed and the three segment counts: each customer's ETL
      segment (P12 on the maximum satisfaction, as in the rollup A1)
    * average purchase amount and satisfaction index: over processed rows
    * most popular category: most rows, ties to the smallest name
    * highest-ROI channel: no cost data exists, so the channel with the
      highest average amount per row, ties to the smallest name
    * data quality: scored records whose segment is not ``ERROR`` / all

    A table without a category or channel column has no top category or
    channel. Rows without a customer count for the means, not as a customer.

    Two aggregates read the processed table, each with one shuffle of
    pre-aggregated rows: one by customer for the segments, and one by
    (category, channel), whose few cells grouping sets turn into categories,
    channels and the whole. The top category and channel are picked with
    ``min_by`` on (-measure, name), which breaks ties to the smallest name.
    """
    spark = processed.sparkSession

    def column(name: str) -> F.Column:
        return F.col(name) if name in processed.columns else F.lit(None).cast("string")

    amount, satisfaction = F.col("cleaned_purchase_amount"), F.col("customer_satisfaction").try_cast("double")
    cells = processed.groupBy(column(category_col).alias("cat"), column(channel_col).alias("chan")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(amount).alias("a_sum"), F.count(amount).alias("a_n"),
        F.sum(satisfaction).alias("s_sum"), F.count(satisfaction).alias("s_n"))
    sets = (cells.groupingSets([["cat"], ["chan"], []], "cat", "chan")
            .agg(F.grouping_id().alias("gid"), *[F.sum(c).alias(c) for c in ("rows", "a_sum", "a_n", "s_sum", "s_n")]))
    # grouping_id bits, in column order: category 2, channel 1 (set when rolled up)
    gid, cat, chan = F.col("gid"), F.col("cat"), F.col("chan")
    by_category, by_channel, overall = (gid == 1) & cat.isNotNull(), (gid == 2) & chan.isNotNull(), gid == 3
    channel_avg = safe_ratio(F.col("a_sum"), F.col("a_n"))

    def overall_mean(prefix: str) -> F.Column:
        return safe_ratio(F.sum(F.when(overall, F.col(f"{prefix}_sum"))), F.sum(F.when(overall, F.col(f"{prefix}_n"))))

    means = sets.agg(
        overall_mean("a").alias("average_purchase_amount"),
        F.min_by(cat, F.when(by_category, F.struct(-F.col("rows"), cat))).alias("most_popular_category"),
        F.min_by(chan, F.when(by_channel, F.struct(channel_avg.isNull(), -channel_avg, chan)))
        .alias("highest_roi_marketing_channel"),
        overall_mean("s").alias("customer_satisfaction_index"))
    segment = etl_segment(F.col("max_sat"))
    customers = (processed.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(satisfaction).alias("max_sat"))
                 .agg(F.count(F.lit(1)).alias("total_customers_analyzed"),
                      F.count_if(segment == "HIGH_VALUE").alias("high_value_customers"),
                      F.count_if(segment == "MEDIUM_VALUE").alias("medium_value_customers"),
                      F.count_if(segment == "STANDARD").alias("standard_customers")))
    quality = scored_records.agg(
        safe_ratio(F.count_if(F.col("customer_segment") != ERROR_SEGMENT), F.count(F.lit(1)))
        .alias("data_quality_score"))
    row = _one_row(spark, m=means, c=customers, q=quality)
    return row.select("c.*", "m.*", "q.data_quality_score")


__all__ = ["customer_summary", "machine_summary"]
