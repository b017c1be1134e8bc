"""Looking at the stored files of catalog tables before they are used.

Only file footers are read here, by Spark tasks: which files can be opened at
all, and how many values each column has. Parquet and ORC tables are probed;
for any other table (a view, CSV, JSON) there is nothing cheap to look at.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

FOOTER_FORMATS = ("parquet", "orc")
# A column that no file has: nothing but the footer is read for it.
NO_COLUMNS = "`no such column` int"


def provider(spark: SparkSession, table: str) -> str | None:
    """The file format of a catalog table in lower case; None for a view."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return None if rows.get("Type") == "VIEW" or "Provider" not in rows else rows["Provider"].lower()


def stored_files(spark: SparkSession, tables: Mapping[str, DataFrame], names: Mapping[str, str]) -> dict[str, tuple[str, list[str]]]:
    """name -> (format, files) of the tables that have footers; ``names`` are the tables' full names."""
    out = {}
    for name, df in tables.items():
        if (fmt := provider(spark, names[name])) in FOOTER_FORMATS:
            out[name] = fmt, sorted(df.inputFiles())
    return out


def _footers(spark: SparkSession, fmt: str, files: Iterable[str], **options: bool) -> DataFrame:
    return spark.read.format(fmt).schema(NO_COLUMNS).options(**options).load(list(files))


def silent_files(spark: SparkSession, fmt: str, files: Iterable[str]) -> list[str]:
    """Files that give no row: those without rows, and those that cannot be opened.

    One job over all files, however many tables they belong to; Spark passes
    over a file that fails, and only the names of silent ones reach the driver.
    """
    given = spark.createDataFrame([(f,) for f in files], "file string")
    seen = (_footers(spark, fmt, files, ignoreCorruptFiles=True, ignoreMissingFiles=True)
            .select(F.col("_metadata.file_path").alias("seen")).distinct())
    return [r["file"] for r in given.join(seen, F.col("file") == F.col("seen"), "left_anti").collect()]


def _reason(exc: Exception) -> str:
    java = getattr(exc, "java_exception", None)
    return str(java.toString() if java is not None else exc).splitlines()[0]


def unreadable_tables(spark: SparkSession, stored: Mapping[str, tuple[str, list[str]]]) -> dict[str, str]:
    """name -> reason for every table with a file whose footer cannot be read.

    A table is opened on its own only when it has a silent file, to tell an
    empty file from a broken one and to give Spark's reason.
    """
    out: dict[str, str] = {}
    for fmt in FOOTER_FORMATS:
        own = {n: files for n, (f, files) in stored.items() if f == fmt and files}
        silent = set(silent_files(spark, fmt, {f for files in own.values() for f in files})) if own else set()
        for name, files in own.items():
            doubtful = silent.intersection(files)
            try:
                if doubtful:
                    _footers(spark, fmt, sorted(doubtful)).count()
            except (PySparkException, Py4JJavaError) as exc:
                out[name] = f"cannot be read: {_reason(exc)}"
    return out


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that answers COUNT from footers; the caller's settings stay."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    for fmt in FOOTER_FORMATS:
        session.conf.set(f"spark.sql.{fmt}.aggregatePushdown", "true")
    return session


def footer_counts(spark: SparkSession, df: DataFrame, fmt: str, files: list[str]) -> DataFrame | None:
    """One row with the number of values of each flat stored column, from footers alone.

    None when the footers cannot answer: no files, no flat column, or a
    partitioned table (its partition columns are not in the files).
    """
    flat = [f for f in df.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    if not files or len(flat) < len(df.columns) or any("=" in f.rsplit("/", 2)[-2] for f in files):
        return None
    session = _footer_session(spark)
    frame = session.read.format(fmt).schema(df.schema).load(files)
    return frame.agg(*[F.count(F.col("`" + f.name.replace("`", "``") + "`")).alias(f"c{i}") for i, f in enumerate(flat)])


def columns_from_footers(spark: SparkSession, df: DataFrame, fmt: str, files: list[str]) -> list[str] | None:
    """F6 from statistics: the columns with at least one value; None where a scan has to answer.

    Files written without null counts make the pushed count fail; the scan answers then.
    """
    counts = footer_counts(spark, df, fmt, files)
    if counts is None:
        return None
    try:
        row = counts.first()
    except (PySparkException, Py4JJavaError):
        return None
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"]]
