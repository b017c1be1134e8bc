"""Catalog discovery and conformed multi-table scans.

Only metadata goes through the driver here: table names, schemas, file names
and, for all-null column pruning, one flag per column. The data itself
stays in one lazy plan: every table scan is unioned by name and Catalyst
prunes columns and pushes filters into each scan.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from opslens.sources.probe import columns_from_footers, stored_files, unreadable_tables

log = logging.getLogger(__name__)


def discover_tables(spark: SparkSession, database: str, pattern: str | None = None,
                    fallback: Sequence[str] | None = None) -> list[str]:
    """Table names in ``database``, optionally ``LIKE pattern`` (``*`` wildcard).

    With no match, ``fallback`` is returned when given (S8), otherwise an
    error is raised (S7). Temporary views, which ``SHOW TABLES`` also lists,
    are not part of the database and are left out.
    """
    stmt = f"SHOW TABLES IN {database}" + (f" LIKE '{pattern}'" if pattern else "")
    names = [r["tableName"] for r in spark.sql(stmt).collect() if not r["isTemporary"]]
    if not names:
        if fallback is not None:
            return list(fallback)
        raise LookupError(f"no tables found in database {database}")
    return sorted(names)


class StoredTables(dict):
    """name -> DataFrame of catalog tables, with the stored files of those that have footers."""

    def __init__(self, tables: Mapping[str, DataFrame], stored: Mapping[str, tuple[str, list[str]]]) -> None:
        super().__init__(tables)
        self.stored = dict(stored)


def load_tagged(spark: SparkSession, tables: Iterable[str] | Mapping[str, DataFrame], *,
                database: str | None = None, skipped: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Each table as a lazy DataFrame (``conform`` tags the rows with the table name).

    ``tables`` is either names (resolved in ``database``) or name -> DataFrame.
    A table that cannot be resolved, or one with a stored file whose footer
    cannot be read, is skipped: the reason goes to the log and to
    ``skipped``. The footers of all tables are looked at in one job; reads
    stay lazy, so their scans run as one job when the result is used.
    """
    if isinstance(tables, Mapping):
        return tables if isinstance(tables, StoredTables) else dict(tables)
    names = {name: f"{database}.{name}" if database else name for name in tables}
    reasons: dict[str, str] = {}
    found: dict[str, DataFrame] = {}
    for name, full in names.items():
        try:
            found[name] = spark.table(full)
        except AnalysisException as exc:
            reasons[name] = f"cannot be read: {str(exc).splitlines()[0]}"
    stored = stored_files(spark, found, names)
    reasons |= unreadable_tables(spark, stored)
    for name, reason in reasons.items():
        log.error("skipping table %s: %s", name, reason)
    if skipped is not None:
        skipped.update(reasons)
    return StoredTables({n: df for n, df in found.items() if n not in reasons},
                        {n: f for n, f in stored.items() if n not in reasons})


def _presence(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(table, column, present)`` for ``columns`` of one table, from one aggregate."""
    flags = df.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.col(f"c{i}").alias("present"))
             for i, c in enumerate(columns)]
    return flags.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def non_null_columns_by_table(tables: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """F6 for many tables: columns holding at least one non-null value, in schema order.

    Catalog tables stored as Parquet or ORC answer from their footers (pushed
    counts). The others are scanned in one job: the per-table aggregates are
    unioned, so their scans run side by side, and an all-null Parquet column
    is cheap to read (a run of definition levels). Only one flag per column
    reaches the driver.
    """
    known: dict[str, list[str]] = {}
    for name, (fmt, files) in getattr(tables, "stored", {}).items():
        if name in tables and (cols := columns_from_footers(tables[name].sparkSession, tables[name], fmt, files)) is not None:
            known[name] = cols
    parts = [_presence(n, df, df.columns) for n, df in tables.items() if df.columns and n not in known]
    rows = reduce(DataFrame.unionByName, parts).collect() if parts else []
    found = {(r["table"], r["column"]) for r in rows if r["present"]}
    return {n: known.get(n, [c for c in df.columns if (n, c) in found]) for n, df in tables.items()}


def non_null_columns(df: DataFrame) -> list[str]:
    """F6 for one table (see ``non_null_columns_by_table``)."""
    return non_null_columns_by_table({"t": df})["t"]


def usable_tables(tables: Mapping[str, DataFrame], essentials: Sequence[str], *, strict: bool = False,
                  skipped: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """the tables that have every essential column.

    The others are skipped with a reason in the log and in ``skipped``, or
    fail the job with ``strict``.
    """
    out = StoredTables({}, getattr(tables, "stored", {}))
    for name, df in tables.items():
        missing = [c for c in essentials if c not in df.columns]
        if not missing:
            out[name] = df
            continue
        if strict:
            raise LookupError(f"table {name} lacks the essential columns {missing}")
        log.error("skipping table %s: missing essential columns %s", name, missing)
        if skipped is not None:
            skipped[name] = f"missing essential columns {missing}"
    return out


def _drifting(tables: Mapping[str, DataFrame], known: Mapping[str, str]) -> set[str]:
    """Columns whose stored types mix numbers with something else between tables."""
    kinds: dict[str, set[str]] = {}
    for df in tables.values():
        for field in df.schema.fields:
            numeric = isinstance(field.dataType, NumericType)
            kinds.setdefault(field.name, set()).add("number" if numeric else field.dataType.simpleString())
    return {c for c, k in kinds.items() if len(k - {"void"}) > 1 and c not in known}


def conform(tables: Mapping[str, DataFrame], *, essentials: Sequence[str] = (),
            prune_all_null: bool = False, types: Mapping[str, str] | None = None,
            tag_col: str = "source_table", strict: bool = False, skipped: dict[str, str] | None = None) -> DataFrame:
    """One DataFrame from same-domain tables with schema drift.

    A table lacking an essential column is skipped (F7, see
    ``usable_tables``). With ``prune_all_null`` columns without any value are
    dropped, essentials always kept (F6). Known columns are cast to their
    domain type (``try_cast``: a value that does not parse becomes null), and
    other columns that are a number in one table and something else in
    another become text, so drift in stored types cannot fail the union at
    run time. Tables are unioned by name, missing columns become null. A
    table's own column ``tag_col`` is overwritten by the tag.
    """
    usable = usable_tables(tables, essentials, strict=strict, skipped=skipped)
    types = types or {}
    text = _drifting(usable, types)
    present = non_null_columns_by_table(usable) if prune_all_null else {}
    parts: list[DataFrame] = []
    for name, df in usable.items():
        keep = [c for c in df.columns if c.lower() != tag_col.lower()]
        if prune_all_null:
            kept = set(present[name]) | set(essentials)
            keep = [c for c in keep if c in kept]
        cols = [F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types
                else F.col(f"`{c}`").cast("string").alias(c) if c in text else F.col(f"`{c}`") for c in keep]
        parts.append(df.select(*cols, F.lit(name).alias(tag_col)))
    if not parts:
        raise LookupError("no table could be conformed")
    return _balanced_union(parts)


def _balanced_union(parts: list[DataFrame]) -> DataFrame:
    """All parts by name; pairs of neighbours first, so the plan is as deep as the logarithm of their number."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1], allowMissingColumns=True) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]
