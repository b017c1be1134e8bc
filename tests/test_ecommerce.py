"""Customer scoring, cleaning and rollup on literal rows."""

from decimal import ROUND_HALF_UP, Decimal
from pyspark.sql import functions as F

from opslens.operators import ecommerce, rollup


def half_up(x, places):
    """The library's rule: half-up to 10 places, then half-up to ``places``."""
    ten = Decimal(repr(x)).quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP)
    return float(ten.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def py_score(a, f, l, s):
    return (0.4 * a / 1000) + (0.3 * f / 10) + (0.15 * l / 10) + (0.15 * s / 10)


def test_customer_scores_aliases_and_errors(spark):
    recs = spark.createDataFrame([
        ({"Purchase_Amount": "$950.00", "Frequency_of_Purchase": "9", "Brand_Loyalty": "8",
          "Customer_Satisfaction": "9"},),
        ({"PurchaseAmount": "$100", "frequency_of_purchase": "2", "BrandLoyalty": "3",
          "customer_satisfaction": "4"},),
        ({"purchase_amount": "$1,200.00", "frequency_of_purchase": "2", "brand_loyalty": "3",
          "customer_satisfaction": "4"},),                           # comma -> ERROR
        ({"purchase_amount": "$10", "frequency_of_purchase": "n/a"},),  # bad int -> ERROR
        ({},),                                                        # every field defaults to '0'
    ], "record map<string,string>")
    got = [(r.customer_value_score, r.customer_segment)
           for r in ecommerce.score_customer_records(recs).collect()]
    assert got[0] == ((half_up(py_score(950, 9, 8, 9), 2)), "HIGH_VALUE")
    assert got[1] == ((half_up(py_score(100, 2, 3, 4), 2)), "STANDARD")
    assert got[2] == (None, "ERROR")
    assert got[3] == (None, "ERROR")
    assert got[4] == (0.0, "STANDARD")


def test_clean_purchases(spark):
    df = spark.createDataFrame([("$1,200.00", "4"), ("$50", None), ("bad", "2"), ("$30", "soon"), ("$9", "-1")],
                               "purchase_amount string, time_to_decision string")
    got = [(r.cleaned_purchase_amount, r.cleaned_time_to_decision, r.purchase_efficiency)
           for r in ecommerce.clean_purchases(df).collect()]
    assert got == [(1200.0, 4.0, 300.0), (50.0, 0.0, 0.0), (None, 2.0, 0.0), (30.0, 0.0, 0.0), (9.0, -1.0, 0.0)]


def test_customer_rollup_casts_text_satisfaction(spark):
    df = spark.createDataFrame([(1, "$10", "5", "4"), (1, "$20", "10", "2"), (2, "$5", "0.6", None)],
                               "customer_id bigint, purchase_amount string, customer_satisfaction string, "
                               "product_rating string")
    df = ecommerce.clean_purchases(df.withColumn("time_to_decision", F.lit("1")))
    rows = {r.customer_id: r for r in rollup.customer_rollup(df).collect()}
    assert rows[1].customer_value_score == 10.0  # numeric max, not the text max '5'
    assert rows[1].total_purchase_amount == 30.0 and rows[1].purchase_count == 2
    assert rows[1].avg_satisfaction == 7.5 and rows[1].customer_segment == "HIGH_VALUE"
    assert rows[2].customer_segment == "MEDIUM_VALUE" and rows[2].avg_product_rating is None


def test_machine_rollup_without_anomaly_flag_counts_zero(spark):
    df = spark.createDataFrame([(1, 2.0, "t"), (1, 4.0, "u")], "machine_id bigint, temperature double, source_table string")
    row = rollup.machine_rollup(df).first()
    assert (row.total_anomalies, row.total_records, row.source_tables_count, row.avg_temperature) == (0, 2, 2, 3.0)


def test_sums_are_plain_sums(spark):
    """Tiny, huge and NaN amounts count as they are."""
    rows = [(1, 1e-7), (1, 3e-7), (2, 1e16), (2, 2.0), (3, float("nan")), (3, 2.0), (None, 4.0)]
    df = spark.createDataFrame([(k, v, 1.0, 1.0) for k, v in rows],
                               "customer_id bigint, cleaned_purchase_amount double, customer_satisfaction double, product_rating double")
    got = {r.customer_id: r for r in rollup.customer_rollup(df).collect()}
    assert got[1].avg_purchase_amount == 2e-7 and got[2].avg_purchase_amount == 5e15 + 1
    assert got[3].avg_purchase_amount != got[3].avg_purchase_amount and got[None].total_purchase_amount == 4.0


def test_epoch_microseconds_on_one_key(spark):
    """A bigint time column is averaged without overflow."""
    df = spark.range(6000).select(F.lit(1).alias("machine_id"), F.lit("t").alias("source_table"),
                                  (F.lit(1_700_000_000_000_000) + F.col("id")).alias("event_us"))
    row = rollup.machine_rollup(df, tables=["t", "u"]).first()
    assert abs(row.avg_event_us - (1_700_000_000_000_000 + 2999.5)) < 1 and row.source_tables_count == 1


def test_nan_amount_is_standard_not_high_value(spark):
    recs = spark.createDataFrame([({"purchase_amount": a, "frequency_of_purchase": "1"},) for a in ("nan", "$inf", "1e25")],
                                 "record map<string,string>")
    got = [(r.customer_value_score, r.customer_segment) for r in ecommerce.score_customer_records(recs).collect()]
    assert got[0][0] != got[0][0] and got[0][1] == "STANDARD"
    assert got[1] == (float("inf"), "HIGH_VALUE") and got[2][0] > 1e21 and got[2][1] == "HIGH_VALUE"


def test_clean_purchases_with_other_column_names(spark):
    df = spark.createDataFrame([("$6", "3")], "paid string, took string")
    assert ecommerce.clean_purchases(df, "paid", "took").first().purchase_efficiency == 2.0


def test_sample_needs_no_other_column(spark):
    df = spark.createDataFrame([(i % 3, f"${i}", str(i), float(i)) for i in range(9)],
                               "customer_id bigint, purchase_amount string, time_to_decision string, purchase_efficiency double")
    assert [r.customer_id for r in ecommerce.purchase_sample(df).collect()] == [0, 0, 0, 1, 1]
