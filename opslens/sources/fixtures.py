"""Domain views over the driver's test tables.

The reference ships no data, so each domain table is derived from the
TPC-H-like tables with plain DataFrame expressions (see FIXTURES.md section 2).
They are lazy DataFrames: nothing is materialised, and the scan prunes to the
columns each view needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.sources.envelopes import base64_text, encode_keyed_records, envelope


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def machine_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    return li.select(
        F.col("l_suppkey").alias("machine_id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("order_key"),
        line.alias("line_no"),
        (F.col("l_quantity") * 2).alias("temperature"),
        F.when(line == 1, F.lit(-1.0)).otherwise(F.col("l_discount") * 100).alias("vibration"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("anomaly_flag"),
        (F.col("l_tax") * 12.5).alias("downtime_risk"),
        F.when(line == 7, F.lit(None).cast("double")).otherwise(F.col("l_quantity") - 1).alias("energy_consumption"),
        (F.col("l_extendedprice") / 25).alias("predicted_remaining_life"),
    )


def mfg_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Four same-domain tables with drift, plus ``orders`` that must be skipped.

    ``mfg_b`` lacks a column and has fractional flags, ``mfg_c`` has a column
    without values and one of its own named like the tag, ``mfg_d`` stores
    its numbers as text, some of it not a number, and flags such as ``1.0``.
    """
    mr = machine_readings(spark, sf_dir)
    mfg_a = mr.where(F.col("line_no") <= 3)
    flag = F.col("anomaly_flag")
    mfg_b = mr.where(F.col("line_no") == 4).drop("vibration").withColumn("anomaly_flag", flag / 2.0)
    mfg_c = (mr.where(F.col("line_no") >= 6).withColumn("humidity", F.lit(None).cast("double"))
             .withColumn("source_table", F.lit("its own")))
    spelled = F.when(flag == 1, "1.0").when(F.col("order_key") % 4 == 0, "0.5").otherwise("0")
    energy = F.when(F.col("order_key") % 10 == 0, F.lit("n/a")).otherwise(F.col("energy_consumption").cast("string"))
    mfg_d = (mr.where(F.col("line_no") == 5).drop("vibration").withColumn("energy_consumption", energy)
             .withColumns({"predicted_remaining_life": F.col("predicted_remaining_life").cast("string"), "anomaly_flag": spelled}))
    return {"mfg_a": mfg_a, "mfg_b": mfg_b, "mfg_c": mfg_c, "mfg_d": mfg_d, "orders": table(spark, sf_dir, "orders")}


def _ecommerce_columns() -> list[Column]:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return [
        key.alias("order_key"),
        cust.alias("customer_id"),
        F.concat(F.lit("$"), F.format_number(F.col("o_totalprice") / 400, 2)).alias("purchase_amount"),
        F.when(key % 50 == 0, F.lit("n/a")).otherwise((1 + key % 10).cast("string")).alias("frequency_of_purchase"),
        (1 + cust % 10).cast("string").alias("brand_loyalty"),
        (cust % 11).cast("string").alias("customer_satisfaction"),
    ]


def ecommerce_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processor input: every measure is text; amounts carry ``$`` and commas."""
    return table(spark, sf_dir, "orders").select(*_ecommerce_columns())


def ecommerce_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ETL input: fractional satisfaction for every third customer, text decision time.

    Order status and priority come from the same ``orders`` row (the order
    key is unique), so the only join is to ``customer`` for the category: a
    sort-merge join on the customer key at scale, with AQE splitting a hot
    customer's partition.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    e = o.select(*_ecommerce_columns(), "o_orderstatus", "o_orderpriority")
    cust, key = F.col("customer_id"), F.col("order_key")
    return (e.join(c, cust == F.col("c_custkey"))
            .select(
                key, cust, "purchase_amount",
                F.when(cust % 3 == 0, (cust % 11) / F.lit(10.0))
                 .otherwise((cust % 11).cast("double")).alias("customer_satisfaction"),
                (1 + key % 5).cast("double").alias("product_rating"),
                F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
                 .when(key % 40 == 3, F.lit("soon"))
                 .otherwise((key % 8).cast("string")).alias("time_to_decision"),
                F.col("c_mktsegment").alias("purchase_category"),
                F.col("o_orderpriority").alias("marketing_channel")))


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine readings with real event time, from ``events``.

    ``ts`` stays TIMESTAMP_NTZ: no watermark is used, and a zone-less time
    compares equal across engines.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        (F.col("user_id") % 40).alias("machine_id"),
        "ts",
        (F.col("value") / 5).alias("temperature"),
        (F.get_json_object("props", "$.k").try_cast("double") / 10).alias("vibration"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("anomaly_flag"),
        ((F.col("user_id") % 10) / F.lit(10.0)).alias("downtime_risk"),
    )


# ---------------------------------------------------------------------------
# Stream envelopes. Spoiled rows are chosen by id so the oracle can exclude
# them: bad base64, base64 of broken JSON, base64 of a non-UTF-8 byte.

def spoiled(id_col: Column) -> Column:
    return (id_col % 97 == 0) | (id_col % 89 == 0) | (id_col % 83 == 0)


def spoil(envelope_data: Column, id_col: Column) -> Column:
    return (F.when(id_col % 97 == 0, F.lit("%%%"))
            .when(id_col % 89 == 0, F.base64(F.lit("{bad").cast("binary")))
            .when(id_col % 83 == 0, F.base64(F.unhex(F.lit("FF"))))
            .otherwise(envelope_data))


def _envelope_lines(df: DataFrame, id_col: str, key_field: str, bare: Column | None) -> DataFrame:
    # every value as text, the way a CSV row reaches the stream; null fields absent
    text = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("string").alias(c) for c in df.columns])
    keyed = encode_keyed_records(text, key_field, include_nulls=False, keep=("id",))
    return keyed.select("id", "key", _line(F.col("value"), F.col("id"), bare))


def _line(value: Column, rid: Column, bare: Column | None) -> Column:
    line = envelope(spoil(base64_text(value), rid))
    if bare is not None:
        line = F.when(bare & ~spoiled(rid), value).otherwise(line)
    return line.alias("value")


def machine_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope lines for the machine stream; every 5th event is sent bare."""
    return _envelope_lines(event_readings(spark, sf_dir), "event_id", "machine_id", bare=F.col("id") % 5 == 0)


def customer_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _envelope_lines(ecommerce_records(spark, sf_dir), "order_key", "customer_id", bare=None)


def odd_amounts(records: DataFrame) -> DataFrame:
    """Records with an amount of ``nan`` (key % 61) or ``$inf`` (key % 67)."""
    key = F.col("order_key")
    return records.withColumn("purchase_amount", F.when(key % 61 == 0, F.lit("nan")).when(key % 67 == 0, F.lit("$inf"))
                              .otherwise(F.col("purchase_amount")))


def perturbed_machine_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine envelopes with routing cases chosen by id.

    id % 7: ``vibration`` absent (unscorable, passes through); id % 13:
    ``downtime_risk`` absent (defaults to 0). ``temperature``: id % 11 is
    ``'hot'`` (scorable, unparsable, dropped), id % 19 ``'nan'``, id % 23
    ``'inf'``. ``anomaly_flag``: id % 17 is null (dropped), id % 31 the text
    ``'1.0'`` (dropped), id % 29 the JSON number 1.0 (counts as 1).
    """
    er = event_readings(spark, sf_dir)
    rid = F.col("event_id")
    pairs = []
    for c in er.columns:
        v = F.col(c).cast("string")
        if c == "temperature":
            v = F.when(rid % 11 == 0, F.lit("hot")).when(rid % 19 == 0, F.lit("nan")).when(rid % 23 == 0, F.lit("inf")).otherwise(v)
        if c == "anomaly_flag":
            v = (F.when(rid % 17 == 0, F.lit(None).cast("string")).when(rid % 31 == 0, F.lit("1.0"))
                 .when(rid % 29 == 0, F.lit("@number")).otherwise(v))
        pairs += [F.lit(c), v]
    rec = F.map_filter(F.create_map(*pairs),
                       lambda k, _: ~(((k == "vibration") & (rid % 7 == 0))
                                      | ((k == "downtime_risk") & (rid % 13 == 0))))
    text = F.replace(F.to_json(rec), F.lit('"@number"'), F.lit("1.0"))
    return er.select(rid.alias("id"), F.col("machine_id").cast("string").alias("key"), _line(text, rid, None))
