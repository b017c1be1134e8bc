"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies: the
source's target words over its words, between 0 and ``cap``. The whole part is
taken as it is. The fractional parts are rounded by the pivotal method: an
open document and a partner, the pool of the smaller open documents of its
source, trade expected *words* (so their sum is kept) in a random direction,
with odds that keep each one's expectation, until one side is whole. A
sequence of documents leaves at most one open document, mostly a short one.

The trades form a reduction tree. Documents are dealt by a hash into groups of
about ``group_rows``; each group leaves at most one open document per source,
and ``fan_in`` groups meet on the next level until one group is left. A hot
source is spread over all groups, no group grows with the corpus, and every
level is a written table. The result depends only on the rows and ``seed``,
not on partitioning, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col, free_name, scratch_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text_col: str):
    """Words between ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, source_size, rank): sources in code point order, null last, ranked from 0.

    A range-partitioned sort numbers rows inside each partition; only the row
    count per partition reaches the driver.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = scratch_table(totals.orderBy(F.col("source").asc_nulls_last())
                            .withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33)
    counts = sorted((r.part, r.n) for r in
                    ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, done = [], 0
    for p, n in counts:
        offsets.append((p, done))
        done += n
    table = spark.createDataFrame(offsets, "part bigint, skipped bigint")
    return (ordered.join(table, part == F.col("part"))
            .select("source", "source_size", (F.col("skipped") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("rank")))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """(source, source_size, target): ``budget`` of all words shared by weight, at most ``cap`` times a source.

    What is over the cap is reshared by weight among the open sources until
    none is above; each round is one aggregate over the sources table and
    brings three numbers to the driver.
    """
    if budget > cap:
        raise ValueError("the budget cannot exceed the cap")
    ranked = scratch_table(ranked_sources(sizes), "mix-ranked")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = ranked.withColumn("weight", weight)
    total, open_weight = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    total, share, full = float(total or 0), 0.0, -1
    if total and open_weight:
        share = budget * total / open_weight
        while True:
            capped = F.col("source_size") * cap <= F.col("weight") * share
            n, words, open_weight = weighted.agg(
                F.count_if(capped), F.sum(F.when(capped, F.col("source_size") * cap)),
                F.sum(F.when(~capped, F.col("weight")))).first()
            if n == full or not open_weight:
                break
            full, share = n, (budget * total - float(words or 0)) / open_weight
    return weighted.select("source", "source_size",
                           F.least(F.col("source_size") * cap, F.col("weight") * share).alias("target"))


def pivot(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> int:
    """Round ``p`` in place to 0 or 1, keeping sum(p * size), but for one entry whose index is returned (or -1).

    Documents come in falling size. Each one's partner is the pool of all
    smaller open documents, whose probabilities move together, so a long
    document can be rounded against many short ones. Both directions lie on
    one line and the odds make the move fair, so every expectation is kept.
    """
    for i in range(len(p)):
        while 0.0 < p[i] < 1.0:
            rest = p[i + 1:]
            still = (rest > 0.0) & (rest < 1.0)
            q = rest[still]
            if not len(q):
                return i
            words = float(size[i + 1:][still].sum())
            low, high = float(q.min()), float((1.0 - q).min())
            needs, has = (1.0 - p[i]) * size[i] / words, p[i] * size[i] / words
            take, give = min(needs, low), min(has, high)
            if rng.random() * (take + give) < give:   # words go from the pool to i
                p[i] = 1.0 if needs <= low else p[i] + take * words / size[i]
                rest[still] = np.where((q <= low) & (take >= low), 0.0, q - take)
            else:                                     # words go from i to the pool
                p[i] = 0.0 if has <= high else p[i] - give * words / size[i]
                rest[still] = np.where((1.0 - q <= high) & (give >= high), 1.0, q + give)
    return -1


def _level(rows: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """One level of the tree over (group, slot); ``open`` marks the documents that go on."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # long documents trade first, so that what stays open at the end is short
        pdf = pdf.sort_values(["source", "size", "deal", "doc_id", "p"], ascending=[True, False, True, True, True],
                              na_position="last", ignore_index=True)
        rng = np.random.default_rng([seed, level, int(key[0]), int(key[1])])
        p, size = pdf["p"].to_numpy(np.float64).copy(), pdf["size"].to_numpy(np.float64)
        still = np.zeros(len(pdf), bool)
        for _, at in pdf.groupby("source", sort=False, dropna=False).indices.items():
            at = np.sort(at)
            own = p[at]
            k = pivot(own, size[at], rng)
            if k >= 0 and last:
                own[k] = float(rng.random() < own[k])
            elif k >= 0:
                still[at[k]] = True
            p[at] = own
        return pdf.assign(p=p, open=still)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", open boolean"
    return rows.groupBy("group", "slot").applyInPandas(run, schema)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        weights: Sequence[float] = WEIGHTS, budget: float = 1.5, cap: float = 2.0, seed: int = 42,
        group_rows: int = 4096, fan_in: int = 16) -> DataFrame:
    """One row per input row: doc_id, text_hash, source, size, source_size, target, copies, taken.

    ``copies`` is the whole number of times the mix takes the document and
    ``taken`` = copies * size. Null texts have size 0, take 0 words and get no
    copies. Null sources are one source, ranked last. Null ids are ordinary
    ids. Repeated rows are separate documents that may get different copies.
    An empty table gives no rows.
    """
    sizes = scratch_table(docs.select(
        col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(col(text_col)).alias("text_hash"),
        col(source_col).cast("string").alias("source"), word_count(text_col).alias("size")), "mix-sizes")
    targets = scratch_table(source_targets(sizes, weights, budget, cap), "mix-targets")
    total = sizes.count()
    slots = 1 + targets.count() // 1024
    groups = max(1, -(-total // group_rows))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    rate = F.when(F.col("size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(cap))).otherwise(0.0)
    deal = F.xxhash64("doc_id", "text_hash", F.lit(seed))
    rows = (sizes.join(t, sizes["source"].eqNullSafe(t["t_source"])).drop("t_source")
            .withColumn("base", F.floor(rate)).withColumn("p", rate - F.col("base")).withColumn("deal", deal)
            .withColumn("group", F.pmod("deal", F.lit(groups)).cast("int"))
            .withColumn("slot", F.pmod(F.xxhash64("source"), F.lit(slots)).cast("int")))
    done, level = [], 0
    while True:
        last = groups <= 1
        out = scratch_table(_level(rows, level, last, seed), f"mix-level{level}")
        done.append(out.where("not open"))
        if last:
            break
        groups, level = -(-groups // fan_in), level + 1
        rows = out.where("open").drop("open").withColumn("group", F.floor(F.col("group") / fan_in).cast("int"))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    copies = (F.col("base") + F.col("p")).cast("bigint")
    return result.select("doc_id", "text_hash", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    copy_col: str = "copy", **settings) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, numbered from 1 in ``copy_col``.

    Rows equal in id, text and source are interchangeable: one of them stands
    for the copies of all. Where ``docs`` has a column ``copy_col``, that one
    stays and the number's name gets underscores until it is free.
    """
    chosen = mix(docs, id_col, text_col, source_col, **settings).groupBy("doc_id", "text_hash", "source").agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    chosen = scratch_table(chosen, "mix-copies")
    text_hash, number = free_name(docs, "__text_hash"), free_name(docs, copy_col)
    marked = docs.withColumn(text_hash, F.xxhash64(col(text_col)))
    if not chosen.where("rows > 1").isEmpty():
        marked = marked.dropDuplicates([id_col, source_col, text_hash])
    marked, chosen = marked.alias("d"), chosen.where("copies > 0").alias("c")

    def own(name: str) -> Column:
        return F.col("d.`" + name.replace("`", "``") + "`")

    taken = marked.join(chosen, own(id_col).cast("bigint").eqNullSafe(F.col("c.doc_id"))
                        & (own(text_hash) == F.col("c.text_hash"))
                        & own(source_col).cast("string").eqNullSafe(F.col("c.source")))
    numbers = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("c.copies"))).alias(number)
    return taken.select(*[own(c) for c in docs.columns], numbers)
