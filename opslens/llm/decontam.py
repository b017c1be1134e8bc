"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit check.

A document holds an item when some run of its words is within
``floor((1 - similarity) * words of the item)`` word edits of it.

* Windows. For each item length L every run of L words of a document is a
  window. Of the word pairs (triples) of a contained item at most two (three)
  are lost per edit, so a window with fewer than L - 2 - 3k triples (for short
  items L - 1 - 2k pairs) of the items of its length cannot match and is passed
  over: a loss-free gate, read off the sorted places of known triples.
* Embedding. The CGK walk copies the current word to its output and moves on
  by a random bit that depends on the output position and the word, the same
  for all strings. Two strings within few edits fall into step again, so their
  outputs agree at many positions: edit distance becomes Hamming distance.
* Pieces. An item of over ``PIECE_WORDS`` words is embedded in equal pieces of at
  most so many, which together cover it. Its edits cannot all exceed the allowed
  share in every piece, so some piece is a short item within its own limit, and
  the window that is shifted by the edits before it passes the gate: a word too
  many or too few before a piece costs one edit and at most three triples.
* LSH. Each of ``repetitions`` independent walks samples ``bits`` output
  positions; windows meet the items of their length under the same sample.
  The defaults reach over 0.95 recall at the largest allowed distance.
* Check. Each candidate pair is verified by the exact edit distance between
  the item and the best run of words around its windows.

Scale: documents are read once, whatever the benchmark's size, and never
shuffled. That pass asks the gate only, against one bitmap of all the
benchmark's word triples (``2**GATE_BITS`` bits, 16 MB, a collision lets a
document pass for nothing), and writes the few documents that pass. Items are
split into words, made distinct and embedded in tasks, one slice of about
``slice_words`` words (or one item) a task. The slices' indexes are then
broadcast one after the other over the passing documents alone, so driver and
workers hold one slice at a time. Equal items are one item until the result.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from opslens.llm.common import col, free_name, scratch_table, tidy
from opslens.llm.tokens import slices as text_slices

WORDS = re.compile(r"[^\W_]+")
PAD, UNKNOWN, FIRST = 0, 1, 2
CLASSES = 1 << 10           # of words, for the walk's random bits
PIECE_WORDS = 256           # longer items and windows are embedded in equal pieces of at most so many words
SLICE_CHARS = 1 << 21
WALKS_AT_ONCE = 1 << 16     # windows; of long items by as many fewer as they have pieces
GATE_BITS = 27
HITS = "item_id bigint, edit_distance int, item_words int, first_word int"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORDS.findall(text.lower()) if text else []


def allowed_edits(words: int, similarity: float) -> int:
    return int((1.0 - similarity) * words + 1e-9)


def needed_grams(words: int, similarity: float, n: int) -> int:
    """Runs of ``n`` words of an item that survive in any window that can match: an edit loses at most n."""
    return words - (n - 1) - n * allowed_edits(words, similarity)


def gate_of(words: int, similarity: float) -> tuple[int, int]:
    """(n, need): the longest runs (3, 2 or 1 words) of which some must survive in a match, and how many."""
    return next((n, need) for n in (3, 2, 1) if (need := needed_grams(words, similarity, n)) > 0)


def pieces_of(words: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces that an item of so many words is embedded in."""
    n = max(1, -(-words // PIECE_WORDS))
    edge = [words * i // n for i in range(n + 1)]
    return list(zip(edge[:-1], edge[1:], strict=True))


class Index:
    """The items of a slice: vocabulary, known word pairs and triples, and their sampled embeddings."""

    def __init__(self, items: list[tuple[int, list[str]]], similarity: float, repetitions: int, bits: int, seed: int):
        self.similarity, self.repetitions, self.bits, self.seed = similarity, repetitions, bits, seed
        same: dict[tuple[str, ...], list[int]] = {}   # equal items are indexed once
        for i, words in items:
            same.setdefault(tuple(words), []).append(i)
        self.item_ids = list(same.values())
        items = [(ids[0], list(words)) for words, ids in same.items()]
        vocabulary = sorted({w for _, words in items for w in words})
        self.ids = {w: n + FIRST for n, w in enumerate(vocabulary)}
        self.items = [np.array([self.ids[w] for w in words], np.int64) for _, words in items]
        self.base = len(vocabulary) + FIRST
        none = np.empty(0, np.int64)
        self.pairs = np.unique(np.concatenate([a[:-1] * self.base + a[1:] for a in self.items] or [none]))
        numbered = [np.searchsorted(self.pairs, a[:-1] * self.base + a[1:]) for a in self.items]
        threes = [a[:-1] * len(self.pairs) + a[1:] for a in numbered]
        self.triples = np.unique(np.concatenate(threes or [none]))
        self.lengths = sorted({len(a) for a in self.items} - {0})
        self.gates = [gate_of(length, similarity) for length in self.lengths]
        # for each run length: which item lengths hold a known run, as (offsets by run, lengths)
        self.holders = {}
        for n, runs, count in ((1, self.items, self.base), (2, numbered, len(self.pairs)),
                               (3, [np.searchsorted(self.triples, t) for t in threes], len(self.triples))):
            both = [np.stack([r, np.full(len(r), np.searchsorted(self.lengths, len(a)))], axis=1)
                    for r, a in zip(runs, self.items, strict=True)
                    if len(a) and self.gates[np.searchsorted(self.lengths, len(a))][0] == n]
            held = np.unique(np.concatenate(both), axis=0) if both else np.empty((0, 2), np.int64)
            self.holders[n] = np.searchsorted(held[:, 0], np.arange(count + 1)), held[:, 1]
        # the pieces of each length, in a row, and their sampled output positions by repetition
        cut = [pieces_of(n) for n in self.lengths]
        self.n_pieces = np.array([len(c) for c in cut], np.int64)
        self.first_piece = np.cumsum(self.n_pieces) - self.n_pieces
        self.pieces = np.array([p for c in cut for p in c], np.int64).reshape(-1, 2)
        self.at = np.stack([[np.sort(np.random.default_rng([seed, 1, rep, b - a]).integers(0, 2 * (b - a), bits))
                             for a, b in self.pieces.tolist()] for rep in range(repetitions)]) if self.lengths else None
        flat = np.concatenate(self.items or [none])
        lens = np.array([len(a) for a in self.items], np.int64)
        ends = np.cumsum(lens)
        some = np.nonzero(lens)[0]
        size = np.searchsorted(self.lengths, lens[some])
        starts, stops, piece, own = self.cut(flat[:0], (ends - lens)[some], ends[some], size)
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        for rep in range(repetitions if len(some) else 0):
            keys = self.sample(flat, starts, stops, piece, rep)
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], some[own[order]]))

    def cut(self, none: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, pieces, string of each) of the pieces of strings; ``size`` is the place among the item lengths."""
        if not len(starts):
            return none, none, none, none
        many = self.n_pieces[size]
        own = np.repeat(np.arange(len(starts)), many)
        piece = np.arange(len(own)) + np.repeat(self.first_piece[size] - (np.cumsum(many) - many), many)
        begin, end = starts[own], ends[own]
        return (np.minimum(begin + self.pieces[piece, 0], end), np.minimum(begin + self.pieces[piece, 1], end), piece, own)

    def coins(self, rep: int) -> np.ndarray:
        """Random bits of one walk by output position and word class; the same for all strings."""
        kept = self.__dict__.setdefault("_coins", {})
        if rep not in kept:
            steps = 3 * int((self.pieces[:, 1] - self.pieces[:, 0]).max())
            kept[rep] = np.random.default_rng([self.seed, 2, rep]).integers(0, 2, (steps, CLASSES), dtype=np.int8)
        return kept[rep]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_coins"}

    def sample(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: np.ndarray, rep: int) -> np.ndarray:
        """Key of each string ids[start:end]: its piece and the embedded words at the sampled positions.

        ``piece`` names the item length and the part of it (a window may be
        cut short by an end of its text).
        """
        at, coins = self.at[rep][piece], self.coins(rep)
        where, words = starts.copy(), np.zeros((len(starts), self.bits), np.int64)
        last, wanted = len(ids) - 1, set(np.unique(self.at[rep]).tolist())
        for j in range(max(wanted) + 1):
            word = np.where(where < ends, ids[np.minimum(where, last)], PAD)
            if j in wanted:
                for b in range(self.bits):
                    take = at[:, b] == j
                    words[take, b] = word[take]
            where += coins[j][word & (CLASSES - 1)]
        key = piece.astype(np.int64) + 1
        for b in range(self.bits):
            key = (key * np.int64(1_000_003)) ^ (words[:, b] + 1) * np.int64(0x5851F42D4C957F2D)
        return key


def edit_distance_in(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(smallest edit distance between ``item`` and any run of ``text``, where that run ends)."""
    n = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)          # a run may start anywhere
    for i, w in enumerate(item.tolist()):
        step = np.empty_like(row)
        step[0] = i + 1
        step[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        row = np.minimum.accumulate(step - n) + n    # words only in the text
    end = int(row.argmin())
    return int(row[end]), end


def find_items(texts: list[str | None], index: Index) -> list[tuple[int, int, int, int]]:
    """(text, item, edit distance, first word of the windows) of all contained items."""
    out: list[tuple[int, int, int, int]] = []
    group: list[int] = []
    chars = 0
    for i, t in enumerate(texts):
        if group and chars + len(t or "") > SLICE_CHARS:
            out += _find(texts, group, index)
            group, chars = [], 0
        group.append(i)
        chars += len(t or "")
    return out + (_find(texts, group, index) if group else [])


def _known(ids: np.ndarray, owner: np.ndarray, index: Index) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By n = 1, 2, 3: (places, numbers) of the runs of n words that the benchmark knows, within texts."""
    one = np.nonzero(ids >= FIRST)[0]
    out = {1: (one, ids[one]), 2: (one[:0], one[:0]), 3: (one[:0], one[:0])}
    both = one[:-1][(one[1:] == one[:-1] + 1) & (owner[one[1:]] == owner[one[:-1]])]
    if not len(both) or not len(index.pairs):
        return out
    code = ids[both] * index.base + ids[both + 1]
    at = np.minimum(np.searchsorted(index.pairs, code), len(index.pairs) - 1)
    hit = index.pairs[at] == code
    both, number = both[hit], at[hit]
    out[2] = both, number
    run = np.nonzero(both[1:] == both[:-1] + 1)[0]
    if len(run) and len(index.triples):
        code = number[run] * len(index.pairs) + number[run + 1]
        at = np.minimum(np.searchsorted(index.triples, code), len(index.triples) - 1)
        hit = index.triples[at] == code
        out[3] = both[run[hit]], at[hit]
    return out


def _windows(ids: np.ndarray, owner: np.ndarray, text_start: np.ndarray,
             index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, places among the item lengths, texts) of all windows that pass the gate of their length.

    A window may begin before its text by as many words as an item may lose,
    so that an item whose head is missing still lies in step with it.
    """
    known = _known(ids, owner, index)
    all_starts, all_sizes, all_texts = [ids[:0]], [ids[:0]], [ids[:0]]
    for n, (places, numbers) in known.items():
        offsets, holders = index.holders[n]
        many = offsets[numbers + 1] - offsets[numbers]
        place = np.repeat(places, many)
        first = np.repeat(offsets[numbers] - (np.cumsum(many) - many), many)
        size = holders[first + np.arange(len(place))]
        order = np.lexsort((place, size))
        place, size = place[order], size[order]
        edge = np.searchsorted(size, np.arange(len(index.lengths) + 1))
        for k in np.unique(size).tolist():
            p, need = place[edge[k]:edge[k + 1]], index.gates[k][1]
            if len(p) < need:
                continue
            # the need-th run from each must still begin inside the window and in the same text
            lo, hi = p[need - 1:], p[:len(p) - need + 1]
            fits = (lo - hi <= index.lengths[k] - n) & (owner[lo] == owner[hi])
            lo, hi = lo[fits] - (index.lengths[k] - n), hi[fits]
            # the texts are set apart, so that the places before one are not those of another
            early = allowed_edits(index.lengths[k], index.similarity)
            text = owner[hi]
            apart = text * (early + 1) + early
            lo, hi = np.maximum(lo, text_start[text] - early) + apart, hi + apart
            span = hi - lo + 1
            places = np.repeat(lo - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
            starts, first = np.unique(places, return_index=True)
            text = np.repeat(text, span)[first]
            all_starts.append(starts - text * (early + 1) - early)
            all_sizes.append(np.full(len(starts), k))
            all_texts.append(text)
    return np.concatenate(all_starts), np.concatenate(all_sizes), np.concatenate(all_texts)


def _find(texts: list[str | None], group: list[int], index: Index) -> list[tuple[int, int, int, int]]:
    per_text = [words_of(texts[i]) for i in group]
    lens = np.fromiter(map(len, per_text), np.int64, len(per_text))
    total = int(lens.sum())
    if not total or not index.items:
        return []
    ids = np.fromiter(map(index.ids.get, chain.from_iterable(per_text), repeat(UNKNOWN)), np.int64, total)
    del per_text
    bounds = np.cumsum(lens)
    owner = np.repeat(np.arange(len(lens)), lens)
    starts, sizes, text_of = _windows(ids, owner, bounds - lens, index)
    ends = np.minimum(starts + np.array(index.lengths)[sizes], bounds[text_of])
    candidates: dict[tuple[int, int], list[int]] = {}
    step = max(1, WALKS_AT_ONCE // int(index.n_pieces.max()))
    for a in range(0, len(starts), step):
        part, size, end, text = starts[a:a + step], sizes[a:a + step], ends[a:a + step], text_of[a:a + step]
        head = (bounds - lens)[text]
        met = []
        begin, stop, piece, window = index.cut(ids[:0], part, end, size)
        begin, stop = np.maximum(begin, head[window]), np.maximum(stop, head[window])
        for rep, (keys, members) in enumerate(index.tables):
            own = index.sample(ids, begin, stop, piece, rep)
            lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            for d in range(int((hi - lo).max(initial=0))):   # items that share a key
                at = np.nonzero(lo + d < hi)[0]
                met.append(np.stack([text[window[at]], part[window[at]], members[lo[at] + d]], axis=1))
        for t, p, item in np.unique(np.concatenate(met), axis=0).tolist() if met else []:
            candidates.setdefault((t, item), []).append(p)
    out = []
    for (text, item), starts in candidates.items():
        words = index.items[item]
        k = allowed_edits(len(words), index.similarity)
        for lo, hi in _regions(starts, len(words) + 2 * k):
            a = max(lo - k, int(bounds[text] - lens[text]))
            b = min(hi + len(words) + k, int(bounds[text]))
            shared = np.isin(words, ids[a:b]).sum()   # each edit loses one of the item's words
            if shared < len(words) - k:
                continue
            distance, _ = edit_distance_in(words, ids[a:b])
            if distance <= k:
                out.append((group[text], item, distance, max(0, lo - int(bounds[text] - lens[text]))))
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for text, item, distance, first in out:
        best[text, item] = min(best.get((text, item), (distance, first)), (distance, first))
    return [(t, i, d, f) for (t, i), (d, f) in sorted(best.items())]


def _regions(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """Window starts closer than ``gap`` as one region (first, last)."""
    starts = sorted(set(starts))
    lo = hi = starts[0]
    for s in starts[1:]:
        if s - hi > gap:
            yield lo, hi
            lo = s
        hi = s
    yield lo, hi


def gram_slots(words: list[str], n: int) -> np.ndarray:
    """Place in the gate's bitmap of each run of ``n`` words."""
    codes = np.fromiter(map(zlib.crc32, map(str.encode, words)), np.uint64, len(words))
    return _slots(codes, n)


def _slots(codes: np.ndarray, n: int) -> np.ndarray:
    m = max(0, len(codes) - n + 1)
    h = codes[:m] + np.uint64(n)
    for j in range(1, n):
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (h >> np.uint64(29))
        h += codes[j:m + j]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - GATE_BITS)).astype(np.int64)


class Gate:
    """Which documents can hold any item: enough known runs close together, for some item length.

    ``ranges`` are ranges of item lengths; the lengths of a range share one
    rule, the widest window and the smallest need among them.
    """

    def __init__(self, packed: np.ndarray, ranges: list[tuple[int, int]], similarity: float):
        self.packed = packed
        rules: dict[tuple[int, int], tuple[int, int]] = {}
        for low, high in ranges:
            for length in range(low, high + 1):
                n, need = gate_of(length, similarity)
                span, least = rules.get((n, low), (length, need))
                rules[n, low] = max(span, length), min(least, need)
        self.rules = sorted((n, span, need) for (n, _), (span, need) in rules.items())

    def passing(self, texts: list[str | None]) -> np.ndarray:
        """Whether each text passes; texts are taken in groups of bounded size."""
        out = np.zeros(len(texts), bool)
        group: list[int] = []
        chars = 0
        for i, t in enumerate(texts):
            if group and chars + len(t or "") > SLICE_CHARS:
                self._mark(texts, group, out)
                group, chars = [], 0
            group.append(i)
            chars += len(t or "")
        if group:
            self._mark(texts, group, out)
        return out

    def _mark(self, texts: list[str | None], group: list[int], out: np.ndarray) -> None:
        parts = []
        for i in group:
            words = words_of(texts[i])
            parts.append(np.fromiter(map(zlib.crc32, map(str.encode, words)), np.uint64, len(words)))
        owner = np.repeat(np.array(group), [len(p) for p in parts])
        codes = np.concatenate(parts)
        for n in sorted({n for n, *_ in self.rules}):
            slot = _slots(codes, n)
            known = (self.packed[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            place = np.nonzero(known & (owner[:len(slot)] == owner[n - 1:len(slot) + n - 1]))[0]
            for _, span, need in (r for r in self.rules if r[0] == n):
                last, first = place[need - 1:], place[:max(0, len(place) - need + 1)]
                fits = (last - first <= span - n) & (owner[last] == owner[first])
                out[owner[first[fits]]] = True


@F.pandas_udf(ArrayType(StringType()))
def _words(texts: pd.Series) -> pd.Series:
    return texts.map(words_of)


def _gate(items: DataFrame, similarity: float) -> Gate:
    """The gate of all items (columns item, words); the driver takes its bitmap and at most a few hundred length ranges."""
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in batch.column("words").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(gram_slots(words, gate_of(len(words), similarity)[0])) + 1)],
                                                 names=["slot"])

    bits = (items.select("words").mapInArrow(slots, "slot bigint").groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    packed = np.zeros(1 << (GATE_BITS - 3), np.uint8)
    for r in bits:
        packed[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    n = F.size("words")
    ranges = (items.groupBy(F.floor(F.log2(n) * 8).alias("level")).agg(F.min(n).alias("low"), F.max(n).alias("high"))
              .select("low", "high").collect())
    return Gate(packed, [(r["low"], r["high"]) for r in ranges], similarity)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 item_col: str = "item_id", item_text_col: str = "text", similarity: float = 0.8, repetitions: int = 48,
                 bits: int = 2, seed: int = 42, slice_words: int = 200_000) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, edit_distance, item_words, first_word.

    Only documents that hold an item appear. ``edit_distance`` counts words,
    ``first_word`` is about where the run starts. Null and empty texts hold
    nothing; items that are null, have a null id or no words are in no
    document. Repeated document rows give repeated rows, repeated items give
    one row each. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {HITS}"
    given = scratch_table(benchmark.select(col(item_col).cast("bigint").alias("item_id"),
                                           _words(col(item_text_col).cast("string")).alias("words"))
                          .where(F.col("item_id").isNotNull() & (F.size("words") > 0)), "decontam-items")
    items = scratch_table(given.groupBy("words").agg(F.min("item_id").alias("item")), "decontam-distinct")
    total = items.agg(F.sum(F.size("words").cast("bigint"))).first()[0]
    if total is None:
        return spark.createDataFrame([], schema)

    gate = sc.broadcast(_gate(items, similarity))

    def pass_gate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(text_slices, batches)):
            yield batch.filter(pa.array(gate.value.passing(batch.column("text").to_pylist())))

    passed = scratch_table(src.mapInArrow(tidy(pass_gate), src.schema), "decontam-passed")
    gate.destroy()

    def embed(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(pdf["item"].tolist(), pdf["words"], strict=True), key=lambda r: r[0])
        index = Index([(i, list(words)) for i, words in rows], similarity, repetitions, bits, seed)
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1].to_numpy(), "index": [pickle.dumps(index)]})

    n_slices = -(-total // slice_words)
    embedded = scratch_table(items.withColumn("slice", F.pmod(F.xxhash64("words"), F.lit(n_slices)).cast("int"))
                             .groupBy("slice").applyInPandas(embed, "slice int, index binary"), "decontam-indexes")
    hits = None
    for number in range(n_slices):
        blob = embedded.where(F.col("slice") == number).select("index").first()
        if blob is None:
            continue
        shared = sc.broadcast(pickle.loads(blob[0]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in chain.from_iterable(map(text_slices, batches)):
                index = shared.value
                found = find_items(batch.column("text").to_pylist(), index)
                if found:
                    t, i, d, f = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(t)), pa.array([index.item_ids[n][0] for n in i], pa.int64()),
                         pa.array(d, pa.int32()), pa.array([len(index.items[n]) for n in i], pa.int32()),
                         pa.array(f, pa.int32())],
                        names=["doc_id", "item_id", "edit_distance", "item_words", "first_word"])

        part = scratch_table(passed.mapInArrow(tidy(run), schema), "decontam-hits")
        shared.destroy()
        hits = part if hits is None else hits.unionByName(part)
    alike = given.join(items, "words").select(F.col("item").alias("same"), F.col("item_id").alias("each"))
    return (hits.join(alike, F.col("item_id") == F.col("same"))
            .select("doc_id", F.col("each").alias("item_id"), "edit_distance", "item_words", "first_word"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns and rows of the others stay.

    A text decides, so the rows are told by the digest of their text, whatever
    ids they have.
    """
    digest = F.sha2(col(text_col).cast("string"), 256)
    texts = docs.select(digest.alias("doc_id"), col(text_col).alias("text"))
    held = scratch_table(contaminated(texts, benchmark, **settings).select("doc_id").distinct(), "decontam-held")
    name = free_name(docs, "held")
    return docs.join(held.select(F.col("doc_id").alias(name)), digest == F.col(name), "left_anti")
