"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ
in at most ``max_bits`` = 4 bits differ in at most four bytes, so they share
at least four positional bytes: the guaranteed minimum. Posting lists on a
single byte would hold 1/256 of all rows each, so the index is posted on byte
*triples*: a fixed family of 20 of the 56 position triples such that any four
positions contain one of the family (Turan's construction for 8 points). A
pair that reaches the minimum meets in at least one list. In a list the
shared positional bytes of a pair are tallied from the XOR, pairs below the
minimum are dropped, and the rest are verified on the bit distance.

Scale: exact copies collapse to one fingerprint before anything is posted.
Lists are sorted runs streamed through a task, and only a spanning forest of
a list's links leaves it, never all pairs of a group. A list longer than
``list_block`` is cut into blocks by a hash of the fingerprint, and each pair
of blocks becomes its own run, so no run holds more than about two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col, connected_components, free_name, scratch_table, tidy

SEED = 42
BYTES = 8
# Shingles whose bits are summed at a time, so a very long text stays bounded in memory.
CHUNK = 1 << 16
# Runs up to this length are compared as shifted arrays, longer ones as blocks of a matrix.
SHORT_RUN = 8


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of one text as an unsigned integer; 0 for a text without words."""
    words = text.lower().split() if text else []  # bytes: only A-Z and the six ASCII blanks count
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        grams = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
        grams = [joined[a:b] for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(grams), CHUNK):
        part = grams[at:at + CHUNK]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(grams), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: dict[str, Column], text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``keys`` plus ``fp`` (the fingerprint's bits as a BIGINT), one row per input row; null text = empty."""
    names = list(keys)
    src = docs.select(*[c.alias(k) for k, c in keys.items()], col(text_col).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("__text")), np.uint64,
                              batch.num_rows)
            cols = [batch.column(k) for k in names] + [pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "fp"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:-1]] + ["fp bigint"])
    return src.mapInArrow(tidy(run), schema)


def triple_family() -> list[tuple[int, int, int]]:
    """20 triples of 0..7 such that every four positions contain one of them."""
    groups = [(0, 1, 2), (3, 4, 5), (6, 7)]
    out = [t for g in groups for t in combinations(g, 3)]
    for i, g in enumerate(groups):
        out += [tuple(sorted((*pair, x))) for pair in combinations(g, 2) for x in groups[(i + 1) % 3]]
    return out


def _verified(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Of XORs, those with enough shared positional bytes (count filter) and few enough differing bits."""
    shared = (x.view(np.uint8).reshape(*x.shape, BYTES) == 0).sum(axis=-1)
    ok = shared >= BYTES - max_bits
    ok[ok] = np.bitwise_count(x[ok]) <= max_bits
    return ok


def _forest(fp: np.ndarray, side: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one run as (member, smallest member it hangs together with).

    With ``side`` only members of different sides are compared.
    """
    n, lab = len(fp), np.arange(len(fp))
    rows, cols = [], []
    for a in range(0, n, 512):
        ok = _verified(fp[a:a + 512, None] ^ fp[None, :], max_bits)
        if side is not None:
            ok &= side[a:a + 512, None] != side[None, :]
        i, j = np.nonzero(ok)
        # within the run only a spanning forest is needed: merge labels block by block
        i = i + a
        while len(i):
            li, lj = lab[i], lab[j]
            open_ = li != lj
            i, j, li, lj = i[open_], j[open_], li[open_], lj[open_]
            if not len(i):
                break
            hi, lo = np.maximum(li, lj), np.minimum(li, lj)
            np.minimum.at(lab, hi, lo)
            while True:  # jump to the roots
                nxt = lab[lab]
                if np.array_equal(nxt, lab):
                    break
                lab = nxt
    child = np.nonzero(lab != np.arange(n))[0]
    return fp[child], fp[lab[child]]


def _links(key: np.ndarray, cell: np.ndarray, side: np.ndarray, fp: np.ndarray, max_bits: int):
    """Links of a batch of whole runs, sorted by (key, cell)."""
    change = np.nonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1]))[0] + 1
    starts = np.concatenate(([0], change))
    lens = np.diff(np.concatenate((starts, [len(key)])))
    crossing = np.add.reduceat((side != 0).astype(np.int64), starts) > 0
    left, right = [], []
    short = (lens > 1) & (lens <= SHORT_RUN) & ~crossing
    keep = np.repeat(short, lens)
    f, run = fp[keep], np.repeat(np.arange(len(starts)), lens)[keep]
    for d in range(1, SHORT_RUN):
        if len(f) <= d:
            break
        at = np.nonzero(run[d:] == run[:-d])[0]
        if not len(at):
            break
        at = at[_verified(f[at + d] ^ f[at], max_bits)]
        left.append(f[at + d])
        right.append(f[at])
    for r in np.nonzero((lens > 1) & ~short)[0]:
        s = slice(starts[r], starts[r] + lens[r])
        a, b = _forest(fp[s], side[s] if crossing[r] else None, max_bits)
        left.append(a)
        right.append(b)
    empty = np.empty(0, np.uint64)
    return np.concatenate(left or [empty]), np.concatenate(right or [empty])


def links(distinct_fps: DataFrame, max_bits: int = 4, list_block: int = 4096) -> DataFrame:
    """Links (a, b) whose components equal those of all pairs within ``max_bits`` <= 4 differing bits.

    ``distinct_fps`` has one BIGINT column fp without repeats. Every pair is
    either returned or connected through returned links.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the posted byte triples guarantee up to four differing bits")

    def byte(i: int) -> Column:
        return F.shiftrightunsigned("fp", 8 * i).bitwiseAND(255)

    posts = [(F.lit(n << 24).cast("bigint") + F.shiftleft(byte(i), 16) + F.shiftleft(byte(j), 8) + byte(k))
             for n, (i, j, k) in enumerate(triple_family())]
    posted = distinct_fps.select("fp", F.explode(F.array(*posts)).alias("key"))
    # lists over list_block are dealt out as pairs of blocks
    long_lists = (posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > list_block)
                  .select("key", F.ceil(F.col("n") / list_block).cast("int").alias("blocks")))
    blocked = (posted.join(long_lists, "key", "left")
               .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
               .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    cells = blocked.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
                           "blocks")
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    runs = cells.select("key", "fp", (lo.cast("bigint") * F.col("blocks") + hi).alias("cell"),
                        F.when(lo == hi, 0).when(F.col("own") == lo, 1).otherwise(2).cast("int").alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        names = ("key", "cell", "side", "fp")

        def emit(parts):
            if not len(parts[0]):
                return None
            a, b = _links(parts[0], parts[1], parts[2], parts[3].view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            now = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            if not len(now[0]):
                continue
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now, strict=True)]
            # the last run may go on in the next batch
            last = np.nonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))[0]
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [p[cut:] for p in now]
            if cut and (out := emit([p[:cut] for p in now])) is not None:
                yield out
        if held is not None and (out := emit(held)) is not None:
            yield out

    return (runs.repartition("key", "cell").sortWithinPartitions("key", "cell")
            .select("key", "cell", "side", "fp").mapInArrow(tidy(run), "a bigint, b bigint"))


def fingerprint_components(fps: DataFrame, rep: Column, max_bits: int = 4) -> DataFrame:
    """(fp, rep) per distinct fingerprint: the smallest ``rep`` of all rows of its component."""
    distinct = scratch_table(fps.groupBy("fp").agg(F.min(rep).alias("rep")), "simhash-distinct")
    comps = scratch_table(connected_components(links(distinct.select("fp"), max_bits)), "simhash-components")
    labelled = distinct.join(comps, distinct["fp"] == comps["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    lowest = labelled.groupBy("root").agg(F.min("rep").alias("rep"))
    return labelled.select("fp", "root").join(lowest, "root").select("fp", "rep")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over fingerprints that
    differ in at most ``max_bits`` bits. Null and empty texts (and texts of
    blanks) have fingerprint zero and link like any other. Repeated rows come
    back repeated. A null id is kept; it is never the smallest, and a
    component without any id has a null component_id. Empty input gives no
    rows. Other columns are not read, so their names cannot clash.
    """
    fps = scratch_table(fingerprints(docs, {"doc_id": col(id_col)}, text_col, shingle), "simhash-fps")
    comps = fingerprint_components(fps, F.col("doc_id"), max_bits)
    return fps.join(comps, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("rep").alias("component_id"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 4,
                         max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (then text hash; null ids last).

    Rows that repeat both id and text are one document. All columns stay, in order.
    """
    keys = {"__id": col(id_col), "__text_hash": F.xxhash64(col(text_col))}
    fps = scratch_table(fingerprints(docs, keys, text_col, shingle), "simhash-fps")
    order = F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__text_hash")
    comps = fingerprint_components(fps, order, max_bits)
    keepers = scratch_table(
        fps.join(comps, "fp").where(order.eqNullSafe(F.col("rep"))).groupBy("__id", "__text_hash")
        .agg(F.count(F.lit(1)).alias("__rows")).select(F.col("__id").alias("__keep_id"), F.col("__text_hash").alias("__keep_hash"),
                                                       "__rows"), "simhash-keepers")
    text_hash = free_name(docs, "__text_hash")
    marked = docs.withColumn(text_hash, keys["__text_hash"])
    keepers = keepers.withColumnsRenamed({"__keep_id": (keep_id := free_name(marked, "__keep_id")),
                                          "__keep_hash": (keep_hash := free_name(marked, "__keep_hash"))})
    kept = marked.join(keepers, col(id_col).eqNullSafe(col(keep_id)) & (col(text_hash) == col(keep_hash)), "left_semi")
    if not keepers.where("__rows > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, text_hash])
    return kept.drop(text_hash)
