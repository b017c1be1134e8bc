"""Shop-customer operators: stream scoring (P1, P2, P4, P8-P11) and ETL cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.functions.numeric import round_half_up, safe_ratio
from opslens.functions.parse import (double_or_zero, first_present, parse_int, parse_money_etl,
                                     parse_money_stream)
from opslens.functions.scores import ERROR_SEGMENT, customer_value, stream_segment

# Field spellings tried in order by the stream processor.
PURCHASE_AMOUNT_KEYS = ("Purchase_Amount", "purchase_amount", "PurchaseAmount")
FREQUENCY_KEYS = ("Frequency_of_Purchase", "frequency_of_purchase", "FrequencyOfPurchase")
LOYALTY_KEYS = ("Brand_Loyalty", "brand_loyalty", "BrandLoyalty")
SATISFACTION_KEYS = ("Customer_Satisfaction", "customer_satisfaction", "CustomerSatisfaction")


def as_record(df: DataFrame, columns: Sequence[str] | None = None, record_col: str = "record") -> DataFrame:
    """Typed row -> ``map<string,string>`` record (every key present, nulls kept)."""
    cols = list(columns or df.columns)
    pairs = [x for c in cols for x in (F.lit(c), F.col(c).cast("string"))]
    return df.withColumn(record_col, F.create_map(*pairs))


def score_customer_records(df: DataFrame, record_col: str = "record") -> DataFrame:
    """Customer value score and segment of map records.

    Each field is read under the first present spelling (``'0'`` when none
    is). Any field that fails to parse keeps the row with a null score and
    the ``ERROR`` segment. The stored score is rounded to 2 decimals; the
    segment uses the unrounded value.
    """
    rec = F.col(record_col)
    amount = parse_money_stream(first_present(rec, PURCHASE_AMOUNT_KEYS))
    frequency = parse_int(first_present(rec, FREQUENCY_KEYS))
    loyalty = parse_int(first_present(rec, LOYALTY_KEYS))
    satisfaction = parse_int(first_present(rec, SATISFACTION_KEYS))
    raw = customer_value(amount, frequency, loyalty, satisfaction)
    return (df.withColumn("customer_value_raw", raw)
            .withColumn("customer_value_score", round_half_up(F.col("customer_value_raw"), 2))
            .withColumn("customer_segment",
                        F.when(F.col("customer_value_raw").isNull(), F.lit(ERROR_SEGMENT))
                         .otherwise(stream_segment(F.col("customer_value_raw"))))
            .withColumn("processing_timestamp", F.current_timestamp()))


def clean_purchases(df: DataFrame, amount_col: str = "purchase_amount", time_col: str = "time_to_decision") -> DataFrame:
    """P3, P6, P13 as one projection behind the table's columns.

    The cleaned amount (invalid -> null), the decision time (null or invalid
    -> 0) and their ratio, which is 0 without a positive time or an amount.
    """
    amount, seconds = parse_money_etl(F.col(amount_col)), double_or_zero(F.col(time_col))
    rate = safe_ratio(amount, F.when(seconds > 0, seconds))
    # The output column names.
    added = {"cleaned_purchase_amount": amount, "cleaned_time_to_decision": seconds,
             "purchase_efficiency": F.coalesce(rate, F.lit(0.0))}
    return df.withColumns(added)


# The four columns of the inspection sample.
SAMPLE_COLUMNS = ("customer_id", "purchase_amount", "time_to_decision", "purchase_efficiency")


def purchase_sample(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of the four inspection columns, ordered by those columns.

    Planned as a distributed top-k (``TakeOrderedAndProject``): each task
    keeps ``n`` rows, so only ``n`` x tasks rows reach the final merge.
    """
    return df.select(*SAMPLE_COLUMNS).orderBy(*SAMPLE_COLUMNS).limit(n)
