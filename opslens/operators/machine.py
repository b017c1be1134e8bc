"""Machine telemetry operators (typed tables and decoded stream records).

Every function is a narrow (per-row) transform or a single filter, so a chain
of them compiles into one whole-stage-codegen span over the scan, with
filters pushed into the Parquet reader where they touch stored columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.functions.numeric import above, round_half_up
from opslens.functions.parse import has_key, json_number, parse_double, parse_int
from opslens.functions.scores import (ALERT_ACTION, ALERT_THRESHOLD, ALERT_TYPE,
                                      machine_efficiency, maintenance_priority)

SCORE = "maintenance_priority_score"
RAW_SCORE = "priority_raw"
ESSENTIALS = ("machine_id", "energy_consumption", "predicted_remaining_life")
# The column of ``decode_envelopes`` that holds a record's own JSON text.
JSON_TEXT = "record_json"
SCORING_KEYS = ("temperature", "vibration", "anomaly_flag")


def score_readings(df: DataFrame, *, raw_col: str = RAW_SCORE, score_col: str = SCORE) -> DataFrame:
    """Maintenance priority on a typed table.

    ``downtime_risk`` defaults to 0 when the column does not exist. The
    stored score is rounded to 2 decimals; ``raw_col`` keeps the unrounded
    value that thresholds are applied to.
    """
    risk = F.col("downtime_risk") if "downtime_risk" in df.columns else F.lit(0.0)
    raw = maintenance_priority(F.col("temperature"), F.col("vibration"),
                               F.col("anomaly_flag"), risk)
    return df.withColumn(raw_col, raw).withColumn(score_col, round_half_up(F.col(raw_col), 2))


def alert_projection(machine_id: Column, score: Column, timestamp: Column) -> list[Column]:
    """The five alert fields (P15); ``score`` is the unrounded priority."""
    return [machine_id.alias("machine_id"),
            F.lit(ALERT_TYPE).alias("alert_type"),
            score.alias("score"),
            timestamp.alias("timestamp"),
            F.lit(ALERT_ACTION).alias("recommended_action")]


def high_priority_alerts(scored: DataFrame, *, raw_col: str = RAW_SCORE,
                         time_col: str = "ts", threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Alerts for rows whose unrounded score exceeds the threshold (F3, P15); a NaN score does not."""
    return (scored.where(above(F.col(raw_col), threshold))
            .select(*alert_projection(F.col("machine_id"), F.col(raw_col), F.col(time_col))))


def with_efficiency(df: DataFrame, *, out: str = "machine_efficiency") -> DataFrame:
    """Machine efficiency (P14): 0 for energy <= 0, else life/energy in [0, 500]."""
    return df.withColumn(out, machine_efficiency(F.col("predicted_remaining_life"),
                                                 F.col("energy_consumption")))


def complete(essentials: tuple[str, ...] = ESSENTIALS) -> Column:
    """Whether all essential columns have a value."""
    cond = F.lit(True)
    for c in essentials:
        cond = cond & F.col(c).isNotNull()
    return cond


def drop_incomplete(df: DataFrame, essentials: tuple[str, ...] = ESSENTIALS) -> DataFrame:
    """Keep rows whose essential columns are all non-null."""
    return df.where(complete(essentials))


def negative_vibration_count(df: DataFrame, column: str = "vibration") -> DataFrame:
    """One-row count of readings below zero (F5); null when the column is absent.

    Reporting only: nothing is removed. Runs as a partial + final aggregate,
    so it is one scan of one column.
    """
    if column not in df.columns:
        return df.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("negative_vibration_count"))
    return df.agg(F.count_if(F.col(column) < 0).alias("negative_vibration_count"))


def score_machine_records(decoded: DataFrame, record_col: str = "record") -> DataFrame:
    """Score decoded stream records held as ``map<string,string>``.

    Adds ``scorable`` (the three scoring keys are present), the parsed
    readings, ``priority_raw``, the rounded score (null when not scorable) and
    ``keep``: false for a scorable record whose readings do not parse, which
    the processor drops, while an unscorable record passes through unscored.
    """
    rec = F.col(record_col)
    scorable = has_key(rec, "temperature") & has_key(rec, "vibration") & has_key(rec, "anomaly_flag")
    risk = F.when(has_key(rec, "downtime_risk"), parse_double(rec.getItem("downtime_risk"))).otherwise(F.lit(0.0))
    temperature = parse_double(rec.getItem("temperature"))
    vibration = parse_double(rec.getItem("vibration"))
    flag = rec.getItem("anomaly_flag")
    anomaly = parse_int(flag)
    if JSON_TEXT in decoded.columns:  # a JSON number such as 1.0 counts as its whole part, the text "1.0" does not
        number = json_number(F.col(JSON_TEXT), "anomaly_flag")
        anomaly = F.when(anomaly.isNull() & flag.try_cast("double").isNotNull(), number.try_cast("bigint")).otherwise(anomaly)
    raw = F.when(scorable, maintenance_priority(temperature, vibration, anomaly, risk))
    return (decoded
            .withColumn("scorable", scorable)
            .withColumn(RAW_SCORE, raw)
            .withColumn(SCORE, round_half_up(F.col(RAW_SCORE), 2))
            .withColumn("keep", ~F.col("scorable") | F.col(RAW_SCORE).isNotNull()))


def record_alerts(scored_records: DataFrame, record_col: str = "record",
                  time_key: str = "timestamp", threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Alerts of scored stream records (F3, P15); fields come from the record map."""
    rec = F.col(record_col)
    return (scored_records.where(F.col("keep") & above(F.col(RAW_SCORE), threshold))
            .select(*alert_projection(rec.getItem("machine_id"), F.col(RAW_SCORE), rec.getItem(time_key))))
