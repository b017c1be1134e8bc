"""Writers and readers: rollup and processed tables, summaries, CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# The partition column of processed tables and its default number of values.
BUCKET_COLUMN = "key_bucket"
BUCKETS = 64
# CSV as written by common tools: a quote inside a cell is doubled, blanks and line breaks are kept.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Snappy Parquet, whole-path overwrite."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def key_bucket(key: str, buckets: int = BUCKETS):
    """The bucket of a key (null has one too); a reader prunes folders with the same expression."""
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def write_processed(df: DataFrame, path: str, key: str, *, buckets: int = BUCKETS) -> None:
    """The table in ``buckets`` folders by a hash of the key, sorted by key inside its files.

    The layout is the same at every size: the number of folders is the
    parameter, not the number of keys or rows. A filter on the key prunes to
    one folder (``key_bucket``) and, by file and row-group statistics, to few
    row groups. ``REBALANCE`` lets AQE size the writer tasks from the data and
    split a bucket that a hot key makes large over several tasks and files.
    A table that has a column of the layout's name is refused, because the
    folder would take that column's place.
    """
    if free_name(df, BUCKET_COLUMN) != BUCKET_COLUMN:
        raise ValueError(f"the table has a column {BUCKET_COLUMN}; write it as a bucketed table (write_bucketed)")
    bucketed = df.withColumn(BUCKET_COLUMN, key_bucket(key, buckets))
    (bucketed.hint("rebalance", BUCKET_COLUMN).sortWithinPartitions(BUCKET_COLUMN, key)
     .write.mode("overwrite").option("compression", "snappy").partitionBy(BUCKET_COLUMN).parquet(path))


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """A processed table without its layout column."""
    return spark.read.parquet(path).drop(BUCKET_COLUMN)


def write_bucketed(df: DataFrame, table: str, key: str, *, path: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """S11 as a catalog table bucketed and sorted by the key, read back from the catalog.

    The planner knows the layout: an aggregation or a join on the key needs no
    shuffle, and a filter on the key reads one bucket. No column is added, so
    none of the table's own can be lost. Rows are dealt to writers by the
    bucket hash; ``REBALANCE`` lets AQE split a bucket that a hot key fills
    over several writers and files.
    """
    writer = (df.hint("rebalance", F.col("`" + key.replace("`", "``") + "`")).write.mode("overwrite").format("parquet")
              .option("compression", "snappy").bucketBy(buckets, key).sortBy(key))
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Headed CSV of text columns; null is an empty cell, nothing is trimmed, quotes are doubled."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    (text.write.mode("overwrite").options(**CSV_OPTIONS, emptyValue="", nullValue="",
                                          ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path, compression=compression))


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], *, multi_line: bool = True,
             streaming: bool = False) -> DataFrame:
    """Headed CSV with every value as text.

    Files are checked against ``columns``: a file with other names or another
    order fails instead of putting values under the wrong names. With
    ``multi_line`` a cell may hold line breaks and a file is read by one task;
    without it large files are split and a line break ends the row.
    """
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    reader = spark.readStream if streaming else spark.read
    return (reader.schema(schema).options(**CSV_OPTIONS, mode="PERMISSIVE", enforceSchema=False,
                                          multiLine=multi_line).csv(path))


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, *, multi_line: bool = True,
                 streaming: bool = False) -> DataFrame:
    """Headed CSV with every value as text, plus ``ingest_timestamp``.

    With ``columns`` the schema is fixed up front (no inference pass over the
    data); otherwise the header of the folder is taken. See ``read_csv``.
    """
    if columns is None:
        columns = spark.read.options(**CSV_OPTIONS).csv(path).columns
    return read_csv(spark, path, columns, multi_line=multi_line, streaming=streaming).withColumn(
        "ingest_timestamp", F.current_timestamp())


def write_summary(summary: DataFrame, path: str) -> None:
    """Append one JSON object per run, stamped with epoch seconds."""
    stamped = summary.withColumn("timestamp", F.unix_micros(F.current_timestamp()) / 1e6)
    stamped.coalesce(1).write.mode("append").json(path)


def _missing(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(exc)


def latest_summary(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The newest summary object, by modification time of its file, then its own ``timestamp``, then path.

    Only file names and times are listed; of the files just the newest (or
    those that tie for it) is read. A folder that does not exist gives no
    row; any other failure is raised.
    """
    empty = spark.createDataFrame([], schema if schema is not None else "timestamp double")
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select(
            "path", "modificationTime")
        newest = files.agg(F.max("modificationTime")).first()[0]
    except AnalysisException as exc:
        if _missing(exc):
            return empty
        raise
    if newest is None:
        return empty
    paths = [r["path"] for r in files.where(F.col("modificationTime") == F.lit(newest)).collect()]
    given = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    read_as = given
    if given is not None and "timestamp" not in given.fieldNames():
        read_as = StructType([*given.fields, StructField("timestamp", DoubleType())])
    df = (spark.read.schema(read_as) if read_as is not None else spark.read).json(paths)
    order = [F.col("timestamp").desc_nulls_last()] if "timestamp" in df.columns else []
    ranked = df.select("*", F.col("_metadata.file_path").alias("_path")).orderBy(*order, F.col("_path").asc()).limit(1)
    return ranked.drop("_path") if given is None else ranked.select(*given.fieldNames())
