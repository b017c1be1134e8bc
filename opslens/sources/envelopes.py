"""Keyed stream records and their envelopes.

A producer turns each row into ``(key, JSON text)``; the stream service wraps
the text as ``{ENVELOPE_KEY: {DATA_KEY: <base64>}}``. Decoding is all built-in
expressions (``from_json``, ``try_to_binary``, ``try_validate_utf8``), so a
malformed row becomes null and is filtered instead of failing the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.functions.parse import has_key

RECORD_TYPE = "map<string,string>"
# The envelope format, {"kinesis": {"data": "<base64 of the record JSON>"}}.
ENVELOPE_KEY = "kinesis"
DATA_KEY = "data"


def record_json(columns: Sequence[str | Column], include_nulls: bool = True) -> Column:
    """The row as one JSON object; ``include_nulls`` keeps null fields as ``null``."""
    opts = {"ignoreNullFields": "false" if include_nulls else "true"}
    return F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in columns]), opts)


def encode_keyed_records(df: DataFrame, key_field: str, include_nulls: bool = True,
                         keep: Sequence[str] = ()) -> DataFrame:
    """Each row -> ``(key, value)``; key is the named field as text, else ``'default'``.

    ``keep`` columns are passed through next to the pair and left out of the record.
    """
    fields = [c for c in df.columns if c not in keep]
    key = (F.coalesce(F.col(key_field).cast("string"), F.lit("default"))
           if key_field in fields else F.lit("default"))
    return df.select(*keep, key.alias("key"), record_json(fields, include_nulls).alias("value"))


def base64_text(text: Column) -> Column:
    """Unwrapped base64 of the UTF-8 bytes (Spark's encoder may insert line breaks)."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), r"[\r\n]", "")


def envelope(data: Column) -> Column:
    """Envelope line around already base64-encoded data."""
    return F.to_json(F.struct(F.struct(data.alias(DATA_KEY)).alias(ENVELOPE_KEY)))


def to_envelope_lines(df: DataFrame, key_field: str, include_nulls: bool = True) -> DataFrame:
    """The producer: rows -> keyed JSON records (S2) -> ``(key, envelope line)``.

    A narrow projection, so it runs where the rows are read; written as text
    files into a folder a file-source stream watches (or to a message topic).
    """
    keyed = encode_keyed_records(df, key_field, include_nulls)
    return keyed.select("key", envelope(base64_text(F.col("value"))).alias("value"))


def decode_envelopes(df: DataFrame, *, value_col: str = "value", allow_bare: bool = False,
                     record_col: str = "record", keep_failed: bool = False,
                     json_col: str | None = None) -> DataFrame:
    """Envelope line -> ``map<string,string>`` record.

    ``allow_bare`` accepts a line that is not an envelope as the record itself
    (manufacturing). A line that is not an object, bad base64, bad UTF-8, bad
    JSON or a JSON value that is not an object gives a null record; those rows
    are dropped unless ``keep_failed`` (then ``decoded`` tells them apart).

    The outer and inner parses are separate projections, which Catalyst keeps
    apart because JSON parsing is not cheap to repeat. Failed rows are
    dropped by exploding a compacted one-element array rather than by a
    filter: a filter on the record would be pushed below the projection with
    the whole decode inlined, evaluating it twice per row.
    """
    staged = df.withColumn("_outer", F.from_json(F.col(value_col), RECORD_TYPE))
    staged = staged.withColumn("_inner", F.from_json(F.col("_outer").getItem(ENVELOPE_KEY), RECORD_TYPE))
    outer, inner = F.col("_outer"), F.col("_inner")
    is_envelope = has_key(outer, ENVELOPE_KEY) & has_key(inner, DATA_KEY)
    data = F.regexp_replace(inner.getItem(DATA_KEY), r"[\r\n]", "")
    payload = F.when(is_envelope, F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string")))
    if json_col:  # the record's own JSON text, for rules that depend on a token's type; decoded once for both
        staged = staged.withColumn("_payload", payload)
        payload = F.col("_payload")
        staged = staged.withColumn(json_col, F.when(is_envelope, payload).otherwise(F.col(value_col)) if allow_bare else payload)
    record = F.when(is_envelope, F.from_json(payload, RECORD_TYPE))
    if allow_bare:
        record = record.otherwise(outer)
    if keep_failed:
        out = staged.withColumn(record_col, record).withColumn("decoded", F.col(record_col).isNotNull())
    else:
        out = (staged.select(*[F.col(f"`{c}`") for c in [*df.columns, *([json_col] if json_col else [])]],
                             F.explode(F.array_compact(F.array(record))).alias(record_col))
               .withColumn("decoded", F.lit(True)))
    return out.drop("_outer", "_inner", "_payload")


def add_record_metadata(df: DataFrame, *, with_batch_id: bool = True) -> DataFrame:
    """Processing time, and a UUID per record (manufacturing).

    Both are non-deterministic by nature and are never compared by value.
    """
    out = df.withColumn("processing_timestamp", F.current_timestamp())
    return out.withColumn("batch_id", F.expr("uuid()")) if with_batch_id else out
