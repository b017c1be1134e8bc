"""Approximate nearest neighbours with a permutation index.

Every vector is represented by its nearest pivots in order. Vectors whose
pivot orders agree are close, and the footrule distance (the sum of rank
differences, a missing pivot counting as the last rank) measures how well they
agree. The index deals all vectors into blocks by a hash of their id; each
block holds its pivots' inverted files: for every pivot the vectors that list
it, with the rank. A query tallies the postings of its own pivots in a block,
which gives every vector's footrule distance, keeps the best of the block and
reranks them by the exact distance.

Scale: pivots are a bounded sample (``n_pivots``); every row is indexed. A
task holds one block of about ``block_rows`` vectors and at most
``query_rows`` queries, whatever the tables' sizes, and hands on k rows per
query and block. Equal vectors of a block are one entry with their smallest
ids, so a vector that fills a third of the table cannot crowd out others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslens.llm.common import col, scratch_table


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    return (F.coalesce(F.size(vector) > 0, F.lit(False))
            & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False)))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` nearest pivots of each row in order (ties to the smaller pivot)."""
    d = (pivots * pivots).sum(1)[None, :] - 2.0 * (x @ pivots.T)
    return np.argsort(d, axis=1, kind="stable")[:, :length]


def inverted_files(perm: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, entries, ranks): the postings of pivot p are entries[offsets[p]:offsets[p + 1]]."""
    n, length = perm.shape
    order = np.argsort(perm.ravel(), kind="stable")
    offsets = np.searchsorted(perm.ravel()[order], np.arange(n_pivots + 1))
    return offsets, order // length, order % length


def footrule(query: np.ndarray, files: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Footrule distance of one query's pivot order to all n entries of a block, tallied from the postings.

    Both orders have length L and a pivot outside an order has rank L, so an
    entry that shares no pivot is at L * (L + 1), and each shared pivot lowers
    that by what the two absent ranks would have cost beyond its difference.
    """
    offsets, entries, ranks = files
    length = len(query)
    tally = np.full(n, length * (length + 1), np.int64)
    for rank, p in enumerate(query):
        at = slice(offsets[p], offsets[p + 1])
        other = ranks[at]
        np.subtract.at(tally, entries[at], (length - rank) + (length - other) - np.abs(rank - other))
    return tally


def distinct_vectors(ids: np.ndarray, x: np.ndarray, keep: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row of each distinct vector, its ``keep`` smallest ids in order), ordered by smallest id."""
    order = np.argsort(ids, kind="stable")
    raw = np.ascontiguousarray(x[order] + 0.0).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, group = np.unique(raw, return_index=True, return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[by_group], np.arange(len(first) + 1))
    by_id = np.argsort(first)
    return order[first[by_id]], [ids[order[by_group[bounds[g]:min(bounds[g] + keep, bounds[g + 1])]]] for g in by_id]


def _one_per_id(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with one id the lexicographically smallest vector."""
    order = np.lexsort((*x.T[::-1], ids))
    first = np.concatenate(([True], ids[order][1:] != ids[order][:-1]))
    return ids[order][first], x[order][first]


def search_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, k: int,
                 length: int, share: float, least: int) -> list[tuple[int, int, float]]:
    """(query, vector, distance) of each query's k best of a block; all arrays of one dimension, in doubles."""
    rows, members = distinct_vectors(ids, x, k + 1)
    own = x[rows]
    length = min(length, len(pivots))
    files = inverted_files(nearest_pivots(own, pivots, length), len(pivots))
    wanted = min(len(own), max(least, int(share * len(own)), k + 1))
    out = []
    for qid, vec, order in zip(q_ids.tolist(), q, nearest_pivots(q, pivots, length), strict=True):
        tally = footrule(order, files, len(own))
        near = np.argpartition(tally, wanted - 1)[:wanted] if wanted < len(own) else np.arange(len(own))
        if wanted < len(own):  # all entries that tie with the last one belong to the list as well
            near = np.nonzero(tally <= tally[near].max())[0]
        diff = own[near] - vec
        dist = np.sqrt((diff * diff).sum(axis=1))
        got = []
        for i in np.lexsort((near, dist)):
            if len(got) >= k and dist[i] > got[k - 1][0]:
                break
            got += [(dist[i], m) for m in members[near[i]].tolist() if m != qid]
            got.sort()
        out += [(qid, m, float(d)) for d, m in got[:k]]
    return out


def pick_pivots(vectors: DataFrame, n_pivots: int) -> np.ndarray:
    """At most ``n_pivots`` different vectors, the smallest by a hash of their content; driver-side by that bound."""
    hashed = vectors.select(F.xxhash64("vec").alias("h"), "vec")
    chosen = hashed.groupBy("h").agg(F.first("vec").alias("vec")).orderBy("h").limit(n_pivots).collect()
    return np.array([list(r["vec"]) for r in chosen], np.float64)


def _block_search(pivots, k: int, length: int, share: float, least: int):
    """The cogroup function of one block and one group of queries; ``pivots`` is a broadcast."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            q_ids, q = _one_per_id(left["id"].to_numpy(np.int64), np.stack(left["vec"].to_list()).astype(np.float64))
            ids, x = _one_per_id(right["id"].to_numpy(np.int64), np.stack(right["vec"].to_list()).astype(np.float64))
            rows = search_block(q_ids, q, ids, x, pivots.value, k, length, share, least)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, query_mod: int = 100, k: int = 10,
           n_pivots: int = 512, perm_length: int = 64, share: float = 0.3, least: int = 500, block_rows: int = 16384,
           query_rows: int = 4096) -> DataFrame:
    """Each query's k nearest found: query_id, rank (from 1), vec_id, score (Euclidean distance of the originals).

    Queries are the rows whose id is divisible by ``query_mod``; candidates
    are all rows but those with the query's own id. Ties go to the smaller id,
    fewer candidates give fewer rows. Null ids and unusable vectors take no
    part. Of rows that repeat an id the smallest vector counts. Vectors are
    compared within one dimension only. An empty table gives no rows; other
    columns are not read.
    """
    spark = vectors.sparkSession
    good = scratch_table(vectors.select(col(id_col).cast("bigint").alias("id"), col(vector_col).alias("raw"))
                         .where(F.col("id").isNotNull() & usable(F.col("raw")))
                         .select("id", F.col("raw").cast("array<double>").alias("vec"), F.size("raw").alias("dim")),
                         "perm-vectors")
    sizes = {r["dim"]: (r["n"], r["q"]) for r in good.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % query_mod == 0).alias("q")).collect()}
    found = None
    for dim, (n, n_queries) in sorted(sizes.items()):
        if not n_queries:
            continue
        one = good.where(F.col("dim") == dim).select("id", "vec")
        pivots = spark.sparkContext.broadcast(pick_pivots(one, n_pivots))
        blocks, groups = -(-n // block_rows), -(-n_queries // query_rows)
        block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
        group = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")
        index = one.select(block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("qgroup"), "id", "vec")
        queries = one.where(F.col("id") % query_mod == 0).select(
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), group.alias("qgroup"), "id", "vec")

        part = (queries.groupBy("block", "qgroup").cogroup(index.groupBy("block", "qgroup"))
                .applyInPandas(_block_search(pivots, k, perm_length, share, least), "query_id bigint, vec_id bigint, score double"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # k rows per query and block meet here, whatever the blocks held
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
