"""Parsing of loosely typed record fields.

Records arrive with every value as text (a CSV cell or a JSON string), so all
parsing is ``try_cast``: a bad value becomes null instead of failing the job
(Spark 4 runs with ANSI casts, where a plain cast raises).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_key(record: Column, key: str) -> Column:
    """True when the map holds ``key``, even with a null value."""
    return F.coalesce(F.map_contains_key(record, F.lit(key)), F.lit(False))


def first_present(record: Column, keys: Sequence[str], default: str = "0") -> Column:
    """Value under the first *present* key among ``keys``, else ``default``.

    A present key whose value is null or empty does not fall through to the
    next spelling, unlike ``coalesce``.
    """
    expr = F.lit(default)
    for key in reversed(keys):
        expr = F.when(has_key(record, key), record.getItem(key)).otherwise(expr)
    return expr


def parse_double(text: Column) -> Column:
    """Text -> double; surrounding blanks allowed, anything else invalid -> null."""
    return F.trim(text).try_cast("double")


def parse_int(text: Column) -> Column:
    """Strict integer parse: ``' 12 '`` and ``'+5'`` parse, ``'5.0'``, ``''``, ``'n/a'`` do not."""
    return F.trim(text).try_cast("bigint")


def parse_money_stream(text: Column) -> Column:
    """Stream money rule: drop ``$``, trim, parse; a thousands comma is invalid."""
    return F.trim(F.replace(text, F.lit("$"), F.lit(""))).try_cast("double")


def parse_money_etl(text: Column) -> Column:
    """ETL money rule: drop every ``$`` and ``,``, parse; invalid -> null."""
    return F.regexp_replace(text.cast("string"), r"[$,]", "").try_cast("double")


def double_or_zero(text: Column) -> Column:
    """Parse to double; null or invalid -> 0."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def json_number(text: Column, key: str) -> Column:
    """The field's value as a double when its JSON token is a number, else null."""
    value = F.try_variant_get(F.try_parse_json(text), f"$.{key}", "variant")
    number = F.transform(F.array(value), lambda v: F.when(   # the lambda binds the parsed token, so it is parsed once
        F.schema_of_variant(v).rlike("^(DECIMAL|DOUBLE|FLOAT|BIGINT)"), F.try_variant_get(v, "$", "double")))
    return F.get(number, F.lit(0))
