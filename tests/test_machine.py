"""Machine operators on literal rows."""

import pytest
from decimal import ROUND_HALF_UP, Decimal
from pyspark.sql import functions as F

from opslens.operators import machine

ROWS = [  # machine_id, ts, temperature, vibration, anomaly_flag, downtime_risk, energy, life
    (1, "2024-01-01 00:00:00", 80.0, 5.0, 1, 0.9, 10.0, 100.0),
    (1, "2024-01-02 00:00:00", 20.0, -1.0, 0, 0.0, 0.0, 100.0),
    (2, "2024-01-01 00:00:00", 50.0, 2.0, 0, 0.1, None, 5.0),
]
SCHEMA = ("machine_id bigint, ts string, temperature double, vibration double, anomaly_flag int, "
          "downtime_risk double, energy_consumption double, predicted_remaining_life double")


def half_up(x, places):
    """The library's rule: half-up to 10 places, then half-up to ``places``."""
    ten = Decimal(repr(x)).quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP)
    return float(ten.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def python_priority(t, v, a, d):
    return (0.3 * t / 100) + (0.25 * v / 10) + (0.15 * a) + (0.3 * d)


def test_score_and_alerts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    scored = machine.score_readings(df).orderBy("machine_id", "ts").collect()
    for row, src in zip(scored, ROWS):
        assert row[machine.RAW_SCORE] == python_priority(*src[2:6])
        assert row[machine.SCORE] == (half_up(python_priority(*src[2:6]), 2))
    alerts = machine.high_priority_alerts(machine.score_readings(df)).collect()
    assert [(a.machine_id, a.alert_type, a.recommended_action) for a in alerts] == [
        (1, "HIGH_MAINTENANCE_PRIORITY", "Schedule immediate maintenance")]
    assert alerts[0].score == python_priority(80.0, 5.0, 1, 0.9)


def test_missing_downtime_risk_defaults_to_zero(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).drop("downtime_risk")
    row = machine.score_readings(df).orderBy("machine_id", "ts").first()
    assert row[machine.RAW_SCORE] == python_priority(80.0, 5.0, 1, 0)


def test_efficiency_then_drop_incomplete(spark):
    df = machine.drop_incomplete(machine.with_efficiency(spark.createDataFrame(ROWS, SCHEMA)))
    got = sorted((r.machine_id, r.machine_efficiency) for r in df.collect())
    assert got == [(1, 0.0), (1, 10.0)]


def test_negative_vibration(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert machine.negative_vibration_count(df).first()[0] == 1
    assert machine.negative_vibration_count(df.drop("vibration")).first()[0] is None


def test_stream_record_routing(spark):
    recs = spark.createDataFrame([
        ({"machine_id": "1", "temperature": "80", "vibration": "5", "anomaly_flag": "1", "downtime_risk": "0.9"},),
        ({"machine_id": "2", "temperature": "80", "vibration": "5"},),                       # unscorable: kept
        ({"machine_id": "3", "temperature": "hot", "vibration": "5", "anomaly_flag": "0"},),   # unparsable: dropped
        ({"machine_id": "4", "temperature": "80", "vibration": "5", "anomaly_flag": None},),   # null: dropped
        ({"machine_id": "5", "temperature": "80", "vibration": "5", "anomaly_flag": "1.0"},),  # not an int: dropped
        ({"machine_id": "6", "temperature": "10", "vibration": "1", "anomaly_flag": "0"},),    # risk absent -> 0
    ], "record map<string,string>")
    out = machine.score_machine_records(recs)
    got = {r.record["machine_id"]: (r.keep, r.scorable, r[machine.RAW_SCORE]) for r in out.collect()}
    assert got["1"] == (True, True, python_priority(80, 5, 1, 0.9))
    assert got["2"] == (True, False, None)
    assert got["3"][0] is False and got["4"][0] is False and got["5"][0] is False
    assert got["6"] == (True, True, python_priority(10, 1, 0, 0))
    alerts = machine.record_alerts(out).collect()
    assert [a.machine_id for a in alerts] == ["1"]


@pytest.mark.parametrize("ts_type", ["timestamp", "timestamp_ntz"])
def test_machine_summary_latest_tier(spark, ts_type):
    from opslens.operators.summary import machine_summary

    rows = [  # machine, ts, temperature, vibration, anomaly, risk, energy, life
        (1, "2024-01-02 00:00:00", 10.0, 1.0, 0, 0.0, 1.0, 1.0),   # latest, low score
        (1, "2024-01-02 00:00:00", 90.0, 9.0, 1, 0.9, 1.0, 1.0),   # latest too, high score: wins the tie
        (2, "2024-01-01 00:00:00", 90.0, 9.0, 1, 0.9, 1.0, 1.0),   # earlier, high
        (2, "2024-01-03 00:00:00", 10.0, 1.0, 0, 0.0, None, 1.0),  # latest, low
        (3, "2024-01-01 00:00:00", 50.0, 2.0, 0, 0.9, 1.0, 1.0),   # medium (0.15 + 0.05 + 0.27)
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast(ts_type))
    row = machine_summary(df).first()
    assert (row.total_machines_analyzed, row.high_risk_machines, row.medium_risk_machines,
            row.low_risk_machines) == (3, 1, 1, 1)
    assert row.predicted_maintenance_events == 2
    assert row.data_quality_score == pytest.approx(4 / 5)
