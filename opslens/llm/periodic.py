"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run is a stretch of words with smallest period q that is at least
max(24, 3 q) words long and cannot be extended. Every word of a run occurs in
it at least three times, so a word that occurs less often within the current
segment belongs to no run there and splits the segment. The parts are counted
anew, on their own, until no part changes; parts below 24 words are dropped.
Ordinary prose falls apart in a few rounds, so that the scan sees little.

The lag scan of a surviving segment looks, for each lag q, only at every q-th
word: where words agree with those q further on over at least 2 q places, some
aligned block of q words equals the next block, and the first words of both
have equal names (a hash of eight words; below q = 8 all words are compared).
Such a place is extended on both sides by comparing words, which decides. All
lags of a segment of m words cost about m log m comparisons, not m * m. A run's
multiples of its period give the same stretch and are left out; a place within
a run already found is extended from that run's ends.

Scale: a projection, one row in and one row out. No shuffle, nothing is kept
between rows; a task holds a slice of about 4 MB of text (or one longer text).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opslens.llm.common import col
from opslens.llm.tokens import slices

MIN_WORDS, MIN_PERIODS = 24, 3
NAME_WORDS = 8
Run = tuple[int, int, int]  # start, length, period


def surviving_segments(ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Segments (start, end) that no rare word splits; texts are ids[bounds[i]:bounds[i + 1]].

    A word that occurs fewer than three times in its segment splits it;
    segments that were split are counted again until none is.
    """
    pos = np.arange(len(ids))
    seg = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    kinds = int(ids.max()) + 1 if len(ids) else 1
    done: list[tuple[int, int]] = []
    while len(pos):
        _, at, count = np.unique(seg * kinds + ids[pos], return_inverse=True, return_counts=True)
        before = np.bincount(seg)
        kept = count[at] >= MIN_PERIODS
        pos, old = pos[kept], seg[kept]
        if not len(pos):
            break
        first = np.concatenate(([True], (np.diff(pos) != 1) | (np.diff(old) != 0)))
        starts = np.nonzero(first)[0]
        size = np.diff(np.append(starts, len(pos)))
        stable = (size == before[old[starts]]) & (size >= MIN_WORDS)
        done += zip(pos[starts[stable]].tolist(), (pos[starts[stable]] + size[stable]).tolist(), strict=True)
        again = ~stable & (size >= MIN_WORDS)
        number = np.cumsum(again) - 1
        pick = np.repeat(again, size)
        pos, seg = pos[pick], np.repeat(number, size)[pick]
    return sorted(done)


def _agree_right(w: np.ndarray, i: int, q: int) -> int:
    """First place from ``i`` on whose word differs from the one q further on (or where that one is missing)."""
    step, end = 64, len(w) - q
    while i < end:
        stop = min(i + step, end)
        differs = w[i:stop] != w[i + q:stop + q]
        at = int(differs.argmax())
        if differs[at]:
            return i + at
        i, step = stop, step * 2
    return end


def _agree_left(w: np.ndarray, i: int, q: int) -> int:
    """First place of the agreement with lag q that reaches ``i``."""
    step = 64
    while i > 0:
        stop = max(0, i - step)
        differs = (w[stop:i] != w[stop + q:i + q])[::-1]
        at = int(differs.argmax())
        if differs[at]:
            return i - at
        i, step = stop, step * 2
    return 0


def _names(w: np.ndarray) -> np.ndarray:
    """A 64-bit name of the NAME_WORDS words from each place on."""
    h = np.zeros(len(w) - NAME_WORDS + 1, np.uint64)
    for k in range(NAME_WORDS):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k:k + len(h)].astype(np.uint64)
        h ^= h >> np.uint64(29)
    return h


def lag_scan(w: np.ndarray) -> list[Run]:
    """All runs of one segment of word ids, by start, then period."""
    found: dict[tuple[int, int], int] = {}   # stretch -> its smallest period
    m = len(w)
    for q in range(1, min(NAME_WORDS - 1, m // MIN_PERIODS) + 1):
        same = np.concatenate(([False], w[:-q] == w[q:], [False]))
        edge = np.nonzero(same[1:] != same[:-1])[0]
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a + q >= max(MIN_WORDS, MIN_PERIODS * q):
                found.setdefault((a, b + q), q)
    if m // MIN_PERIODS >= NAME_WORDS:
        names = _names(w)
        over = np.full(m, -1)   # the longest known run over each word
        known = np.zeros((0, 3), np.int64)
        for (s, e), p in sorted(found.items(), key=lambda x: x[0][1] - x[0][0]):
            over[s:e] = len(known)
            known = np.concatenate((known, [(s, e, p)]))
        for q in range(NAME_WORDS, m // MIN_PERIODS + 1):
            every = names[::q]
            hits = np.nonzero(every[:-1] == every[1:])[0] * q
            if not len(hits):
                continue
            # within a known run whose period divides q the agreement covers that run
            inside = np.zeros((len(hits), 3), np.int64)
            if len(known):
                inside = np.where(over[hits, None] >= 0, known[over[hits]], 0)
                ok = (inside[:, 2] > 0) & (q % np.maximum(inside[:, 2], 1) == 0) & (hits + q < inside[:, 1])
                inside[~ok] = 0
                again = ok & (inside[:, 1] - inside[:, 0] >= MIN_PERIODS * q)   # and is that run
                hits, inside = hits[~again], inside[~again]
            reached = 0
            for i, (s, e, _) in zip(hits.tolist(), inside.tolist(), strict=True):
                if i < reached:
                    continue
                reached = _agree_right(w, e - q if e else i, q)
                a = _agree_left(w, s if e else i, q)
                if reached - a >= (MIN_PERIODS - 1) * q and (a, reached + q) not in found:
                    found[a, reached + q] = q
                    shorter = (over[a:reached + q] < 0) | (
                        (known[:, 1] - known[:, 0])[over[a:reached + q]] < reached + q - a if len(known) else False)
                    over[a:reached + q][shorter] = len(known)
                    known = np.concatenate((known, [(a, reached + q, q)]))
    return sorted((s, e - s, p) for (s, e), p in found.items())


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for r in runs:
        if best is None or (d := r[1] * best[2] - best[1] * r[2]) > 0 or (
                d == 0 and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


def planted_order(n: int, doc_id: int | None) -> np.ndarray | None:
    """Word numbers of a text that the test rule makes periodic; None where it leaves the text as it is."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def _slice_rows(part: pa.RecordBatch, planted: bool) -> list[tuple]:
    """(runs, words with the runs' repetitions, kept words or None for all) per text of a slice."""
    words = [(t.as_py() or b"").split() for t in part.column("text")]   # bytes: exactly the six ASCII blanks
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(x, len(known)) for x in chain.from_iterable(words)), np.int64,
                      sum(map(len, words)))
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in words]))).astype(np.int64)
    if planted:
        for k, doc in enumerate(part.column("doc_id").to_pylist()):
            order = planted_order(len(words[k]), doc)
            if order is not None:
                own = ids[bounds[k]:bounds[k + 1]]
                own[:] = own[order]
                words[k] = [words[k][i] for i in order.tolist()]
    runs: list[list[Run]] = [[] for _ in words]
    for a, b in surviving_segments(ids, bounds):
        k = int(np.searchsorted(bounds, a, "right")) - 1
        runs[k] += [(s + a - int(bounds[k]), size, q) for s, size, q in lag_scan(ids[a:b])]
    out = []
    for own, found in zip(words, runs, strict=True):
        kept = None
        if found:
            kept = np.ones(len(own), bool)
            for s, size, q in found:
                kept[s + q:s + size] = False
        out.append((found, own, kept))
    return out


def collapsed(words: list[bytes], kept: np.ndarray | None) -> bytes:
    return b" ".join(words if kept is None else [words[i] for i in np.nonzero(kept)[0].tolist()])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """One row per input row: doc_id, runs (start, length, period by start, then period) and the collapsed text.

    The collapsed text has the words that no run repeats (of each run the
    first period stays), joined by one blank. With ``planted`` texts are first
    made periodic by the test rule (``planted_order``); a null id never is.
    Null, empty and blank texts have no runs and an empty collapsed text.
    Repeated rows come back repeated, other columns are not read, an empty
    table gives no row. Texts are read whole.
    """
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("binary").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = _slice_rows(part, planted)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in found]
                              for found, _, _ in rows], run_type),
                    pa.array([collapsed(own, kept).decode() for _, own, kept in rows], pa.string())],
                    names=["doc_id", "runs", "collapsed"])

    return src.mapInArrow(run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


DIGEST_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli")


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_runs, the strongest run and digests of all runs and of the collapsed text.

    The rows of ``find_runs`` with their texts digested where they are found;
    without a run start, length, period and exponent_milli are null.
    """
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("binary").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                numbers, all_runs, texts = [], [], []
                for found, own, kept in _slice_rows(part, planted):
                    best = strongest(found)
                    numbers.append((len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None))
                    all_runs.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest())
                    texts.append(hashlib.sha256(collapsed(own, kept)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array([r[i] for r in numbers], pa.int64()) for i in range(5)],
                     pa.array(all_runs, pa.string()), pa.array(texts, pa.string())],
                    names=["doc_id", *DIGEST_COLUMNS, "runs_sha256", "collapsed_sha256"])

    return src.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in DIGEST_COLUMNS)
                          + ", runs_sha256 string, collapsed_sha256 string")
