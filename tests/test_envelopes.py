"""Keyed records, envelopes and decoding."""

import base64
import json

from pyspark.sql import functions as F

from opslens.sources import envelopes


def env(payload: bytes | str) -> str:
    data = payload if isinstance(payload, str) else base64.b64encode(payload).decode()
    return json.dumps({"kinesis": {"data": data}})


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_keyed_records(spark):
    df = spark.createDataFrame([("7", "1.5", None), (None, "2", "x")], "machine_id string, t string, n string")
    got = envelopes.encode_keyed_records(df, "machine_id").collect()
    assert [r.key for r in got] == ["7", "default"]
    assert json.loads(got[0].value) == {"machine_id": "7", "t": "1.5", "n": None}
    assert [r.key for r in envelopes.encode_keyed_records(df, "absent").collect()] == ["default", "default"]


def test_decode_good_and_bad(spark):
    good = {"machine_id": "1", "temperature": "20"}
    long = {"machine_id": "2", "note": "x" * 300}
    vals = [
        env(json.dumps(good).encode()),            # good
        env("%%%"),                                 # bad base64
        env(b"{bad"),                               # bad JSON
        env(b"\xff"),                               # bad UTF-8
        env(b"[1, 2]"),                             # JSON but not an object
        json.dumps(good),                           # bare record
        "not json",                                 # not an object at all
        env(base64.encodebytes(json.dumps(long).encode()).decode()),  # base64 wrapped every 76 chars
    ]
    kept = envelopes.decode_envelopes(lines(spark, vals), allow_bare=True, keep_failed=True).collect()
    assert [r.decoded for r in kept] == [True, False, False, False, False, True, False, True]
    assert kept[0].record == good and kept[5].record == good and kept[7].record == long
    strict = envelopes.decode_envelopes(lines(spark, vals), allow_bare=False).collect()
    assert [r.record for r in strict] == [good, long]


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([("1", "héllo wörld")], "id string, text string")
    value = envelopes.record_json(df.columns)
    line = df.select(envelopes.envelope(envelopes.base64_text(value)).alias("value"))
    out = envelopes.decode_envelopes(line).first()
    assert out.record == {"id": "1", "text": "héllo wörld"}


def test_record_metadata(spark):
    df = envelopes.add_record_metadata(spark.range(50))
    row = df.agg(F.countDistinct("batch_id").alias("ids"), F.count("processing_timestamp").alias("ts")).first()
    assert row.ids == 50 and row.ts == 50
