"""Helpers the operators share: scratch tables, column picking, edge lists to components."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.session import scratch_path
from opslens.sources.sinks import free_name as free_name

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Tasks import it, and a worker finds neither the driver's ``sys.path`` nor
    its working directory. Nothing to do when the package itself came as an
    archive (``--py-files``).
    """
    sc = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if sc.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="opslens-")) / "opslens.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def give_back() -> None:
    """Hand freed memory back to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # the GNU C library has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator], forget: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """A task function that leaves a small worker behind.

    Spark uses a Python worker again for the tasks of later stages, so what one
    task leaves in memory lies beside whatever the next one needs. ``forget``
    drops what the task kept in its module.
    """
    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            if forget is not None:
                forget()
            give_back()

    return tidied


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not the work before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(edges: DataFrame) -> tuple:
    """Order-independent fingerprint of an edge table."""
    h = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(0xFFFFFFFF)),
                    F.sum(F.shiftrightunsigned(h, 32))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, BIGINT); root = smallest node.

    Alternating large-star and small-star rounds until nothing changes. Each
    half round is a pre-aggregated ``min`` per node joined back to the edges,
    so a node with very many edges is a skewed join side that AQE can split,
    never one group in one task. Rounds grow with the logarithm of the
    longest path, and each writes its edges to shared scratch.
    """
    cur = scratch_table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct(), "cc")
    state = _state(cur)
    while state[0]:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = scratch_table(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "cc")
        before, state = state, _state(cur)
        if state == before:
            break
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
