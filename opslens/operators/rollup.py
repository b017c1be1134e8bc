"""Per-key rollups.

Each rollup is one ``groupBy().agg()``: Spark plans a partial aggregate before
the shuffle and a final one after it, so a key holding a third of all rows
still arrives at its reducer as one partial row per map task, not as its raw
rows. Sums and averages are Spark's own over doubles.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.functions.scores import etl_segment
from opslens.sources.sinks import free_name

# Column types eligible for automatic averaging. ``decimal``
# columns show up as ``decimal(p,s)`` and never match, as in the source rule.
AVERAGED_TYPES = ("int", "bigint", "float", "double")
BITS = 64


def with_table_bits(df: DataFrame, tag_col: str, tables: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with one BIGINT per 64 tables, in which the row's table has its bit.

    The tables' numbers come from a broadcast of their names, so a row costs
    one lookup and the plan does not grow with the number of tables (one more
    column per 64).
    """
    words = [free_name(df, f"table_bits_{w}") for w in range(-(-len(tables) // BITS))]
    tag = free_name(df, "table_name")
    numbers = df.sparkSession.createDataFrame(
        [(t, *[_signed(1 << (i - w * BITS)) if i // BITS == w else 0 for w in range(len(words))])
         for i, t in enumerate(tables)], ", ".join([f"`{tag}` string", *[f"`{w}` bigint" for w in words]]))
    return df.join(F.broadcast(numbers), F.col(tag_col) == F.col(tag), "left").drop(tag), words


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def tables_seen(tag_col: str, words: Sequence[str]) -> Column:
    """A4: how many source tables a key's rows come from, counted from their bits (or distinct tags without any).

    An OR of BIGINTs is a fixed-width buffer: no shuffle of its own, no set per key.
    """
    if not words:
        return F.countDistinct(tag_col)
    return reduce(lambda a, b: a + b, [F.bit_count(F.coalesce(F.bit_or(w), F.lit(0).cast("bigint"))).cast("bigint")
                                       for w in words])


def machine_rollup(df: DataFrame, key: str = "machine_id", tag_col: str = "source_table",
                   tables: Sequence[str] | None = None) -> DataFrame:
    """A2-A4 by machine: ``avg_<c>`` of every numeric column, anomalies, rows, source tables.

    ``anomaly_flag`` missing from every table counts as no anomalies; a
    flag above zero is one, fractions included. ``tables`` names all source
    tables where they are known.
    """
    numeric = [c for c, t in df.dtypes if t in AVERAGED_TYPES and c not in (key, tag_col)]
    anomalous = (F.col("anomaly_flag") > 0) if "anomaly_flag" in df.columns else F.lit(False)
    # The output column names.
    marked, words = with_table_bits(df, tag_col, tables) if tables else (df, [])
    return marked.groupBy(key).agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"avg_{c}") for c in numeric],
        F.count_if(anomalous).alias("total_anomalies"),
        F.count(F.lit(1)).alias("total_records"),
        tables_seen(tag_col, words).alias("source_tables_count"),
    )


def customer_rollup(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """A1 + P12 by customer.

    ``customer_value_score`` is the *maximum satisfaction* (not the stream
    score of the same name) and drives the ETL segment rule. Satisfaction
    and rating are cast to double first: ``max`` over text would compare
    lexicographically and averaging text fails under ANSI casts.
    """
    amount = F.col("cleaned_purchase_amount")
    satisfaction = F.col("customer_satisfaction").try_cast("double")
    # The output column names.
    return (df.groupBy(key).agg(
                F.sum(amount).alias("total_purchase_amount"),
                F.avg(amount).alias("avg_purchase_amount"),
                F.count(F.lit(1)).alias("purchase_count"),
                F.avg(satisfaction).alias("avg_satisfaction"),
                F.avg(F.col("product_rating").try_cast("double")).alias("avg_product_rating"),
                F.max(satisfaction).alias("customer_value_score"))
            .withColumn("customer_segment", etl_segment(F.col("customer_value_score"))))
