"""Alignment of two tokenizers by interval coalescing, and corpus-wide counts of linked ids.

Both tokenizers cut the same bytes, so their tokens are intervals over one
axis. All A and B tokens are sorted by start (``lexsort``), the running maximum
of their ends is taken (``maximum.accumulate``), and a group breaks where a
start reaches that maximum. Within groups the overlapping A-B pairs are
expanded from two binary searches, in proportion to their number, so a long
group of n tokens that never meet costs n links and not n * n pairs.

Neither tokenizer joins a blank to the character before it (A by its
pre-tokenizer, B because no piece of its vocabulary holds a blank behind
another character, which is checked when it is loaded), so a text is cut before
such blanks and each distinct chunk is coalesced once while it is remembered
(``tokens``).

Scale: one pass encodes and writes, per document, its figures and its distinct
id pairs with their counts. The counts are added up corpus-wide with map-side
sums. A pair that makes up at least ``1 / HOT_SHARE`` of all links is hot: at
most HOT_SHARE pairs can be, so they are broadcast; the others meet the
documents' pairs in a shuffle join in which no key holds more than
``1 / HOT_SHARE`` of the links. Nothing that grows with the corpus reaches the
driver or one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col, scratch_table
from opslens.llm.tokens import MEMO_CHUNKS, MEMO_VALUES, Ragged, byte_pair_tokenizer, by_text, slices, tokenizer_path

BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT_SHARE = 1 << 19
ID_BITS = 31
# Chunks encoded as one text.
JOINED = 1000
# A blank between two characters that no tokenizer takes for a blank.
CUT = re.compile(r" (?=[!-~\w])(?<=[!-~\w] )")
BLANK_MARK = "▁"


def byte_level_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes are themselves, the rest follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def byte_level_table(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer (entries outside its alphabet: their own UTF-8)."""
    alphabet = byte_level_alphabet()
    out = [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab().items():
        known = all(c in alphabet for c in entry)
        out[i] = bytes(alphabet[c] for c in entry) if known else entry.encode()
    return out


def piece_table(model) -> list[bytes]:
    """The bytes of every id of a sentencepiece model; <0xHH> is one byte, control pieces have none."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i)
                   else piece.replace(BLANK_MARK, " ").encode())
    return out


class Pair(NamedTuple):
    """The two encoders and the bytes of their ids."""
    a: object
    b: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    a_size: np.ndarray
    b_size: np.ndarray
    cuts: bool   # whether texts may be cut before blanks


_LOADED: dict[tuple[str, str], Pair] = {}


def load_pair(a_name: str = BYTE_TOKENIZER, b_name: str = PIECE_TOKENIZER) -> Pair:
    if (a_name, b_name) not in _LOADED:
        import sentencepiece
        a = byte_pair_tokenizer(a_name, plain_specials=True)
        b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(b_name))
        ab, bb = byte_level_table(a), piece_table(b)
        crossing = any(BLANK_MARK in b.id_to_piece(i).lstrip(BLANK_MARK) for i in range(b.get_piece_size()))
        sizes = [np.fromiter(map(len, t), np.int64, len(t)) for t in (ab, bb)]
        _LOADED[a_name, b_name] = Pair(a, b, ab, bb, *sizes, not crossing)
    return _LOADED[a_name, b_name]


class Links(NamedTuple):
    """Coalesced tokens: the group of each token, and the overlapping pairs as token numbers."""
    a_group: np.ndarray
    b_group: np.ndarray
    left: np.ndarray
    right: np.ndarray


def coalesce(a_size: np.ndarray, b_size: np.ndarray) -> Links:
    """Groups and links of two tilings of one axis by token sizes in bytes."""
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    a_start, b_start = a_end - a_size, b_end - b_size
    start, end = np.concatenate((a_start, b_start)), np.concatenate((a_end, b_end))
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(np.concatenate(([0], start[order][1:] >= reach[:-1]))) if len(order) else 0
    low = np.searchsorted(b_end, a_start, "right")
    many = np.searchsorted(b_start, a_end, "left") - low
    left = np.repeat(np.arange(len(a_size)), many)
    right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many - low, many)
    return Links(group[:len(a_size)], group[len(a_size):], left, right)


class Chunks:
    """What is remembered of distinct chunks: token counts, groups as text, and links as packed id pairs."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.figures = Ragged(np.int64)   # tokens of A and B, groups, links
        self.links = Ragged(np.int64)
        self.groups: list[str | None] = []  # None: the bytes of A or B are not those of the chunk
        self.met = np.zeros(0, np.int64)

    def bound(self) -> None:
        """Beyond the bound, chunks that were met once are forgotten, then all if many were met again."""
        if len(self.slot) <= MEMO_CHUNKS and self.links.used <= MEMO_VALUES:
            return
        kept = np.nonzero(self.met[:len(self.groups)] > 1)[0]
        size = self.links.ends[kept + 1] - self.links.ends[kept]
        if 2 * len(kept) > MEMO_CHUNKS or 2 * size.sum() > MEMO_VALUES:
            self.forget()
            return
        names, groups = list(self.slot), self.groups
        figures, links = self.figures.take(kept), self.links.take(kept)
        self.forget()
        self.slot = {names[i]: k for k, i in enumerate(kept.tolist())}
        self.groups = [groups[i] for i in kept.tolist()]
        self.figures.extend(*figures)
        self.links.extend(*links)

    def count(self, slots: np.ndarray) -> None:
        met = np.bincount(slots, minlength=len(self.groups))
        met[:len(self.met)] += self.met
        self.met = met

    def learn(self, chunks: list[str]) -> None:
        """Encode and coalesce chunks that are not known yet; A sees a blank before each, B adds one."""
        p = self.pair
        raw = [(" " + c).encode() for c in chunks]
        a_ids, a_many = self._encode_a(chunks, raw)
        b_lists = p.b.encode(chunks, num_threads=1)
        b_many = np.fromiter(map(len, b_lists), np.int64, len(chunks))
        b_ids = np.fromiter(chain.from_iterable(b_lists), np.int64, int(b_many.sum()))
        good = _same_bytes(a_ids, a_many, p.a_bytes, p.a_size, raw) & _same_bytes(b_ids, b_many, p.b_bytes, p.b_size, raw)
        a_pick, b_pick = np.repeat(good, a_many), np.repeat(good, b_many)
        a_chunk = np.repeat(np.arange(len(chunks)), a_many)[a_pick]
        a_ids, b_ids = a_ids[a_pick], b_ids[b_pick]
        x = coalesce(p.a_size[a_ids], p.b_size[b_ids])
        first = np.nonzero(np.concatenate(([True], np.diff(x.a_group) != 0)))[0] if len(a_ids) else np.arange(0)
        n_groups = np.bincount(a_chunk[first], minlength=len(chunks))
        n_links = np.bincount(a_chunk[x.left], minlength=len(chunks))
        a_many, b_many = np.where(good, a_many, 0), np.where(good, b_many, 0)
        self.figures.extend(np.stack((a_many, b_many, n_groups, n_links), axis=1).ravel(), np.full(len(chunks), 4))
        self.links.extend((a_ids[x.left] << ID_BITS) | b_ids[x.right], n_links)
        self.slot.update(zip(chunks, range(len(self.groups), len(self.groups) + len(chunks)), strict=True))
        texts = iter(_group_texts(a_ids, b_ids, x, a_chunk))
        self.groups += [next(texts) if g else None for g in good.tolist()]

    def _encode_a(self, chunks: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of A, how many per chunk). Chunks that a text could be cut around are encoded as one text."""
        p = self.pair
        plain = [i for i, c in enumerate(chunks) if p.cuts and CUT.search(f"{c[-1:]} {c[:1]}")]
        lists: list[list[int]] = [[]] * len(chunks)
        for at in range(0, len(plain), JOINED):
            own = plain[at:at + JOINED]
            ids = p.a.encode_batch_fast([" " + " ".join([chunks[i] for i in own])], add_special_tokens=False)[0].ids
            ends = np.searchsorted(np.cumsum(p.a_size[ids]), np.cumsum([len(raw[i]) for i in own]), "right").tolist()
            for i, a, b in zip(own, [0, *ends], ends, strict=False):
                lists[i] = ids[a:b]
        alone = sorted(set(range(len(chunks))).difference(plain))
        for i, e in zip(alone, p.a.encode_batch_fast([" " + chunks[i] for i in alone], add_special_tokens=False), strict=True):
            lists[i] = e.ids
        many = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int64, int(many.sum())), many


def _same_bytes(ids: np.ndarray, many: np.ndarray, table: list[bytes], size: np.ndarray, raw: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each chunk's ids are the chunk's."""
    parts = list(map(table.__getitem__, ids.tolist()))
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    if np.array_equal(by_text(size[ids], many), lengths) and b"".join(parts) == b"".join(raw):
        return np.ones(len(raw), bool)
    ends = np.cumsum(many).tolist()
    return np.array([b"".join(parts[e - n:e]) == r for e, n, r in zip(ends, many.tolist(), raw, strict=True)], bool)


def _group_texts(a_ids: np.ndarray, b_ids: np.ndarray, x: Links, a_chunk: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2`` of each chunk that has tokens."""
    n = len(a_ids) + len(b_ids)
    if not n:
        return []
    group = np.concatenate((x.a_group, x.b_group))
    side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
    order = np.lexsort((side, group))
    group, side = group[order], side[order]
    chunk = np.empty(group[-1] + 1, np.int64)
    chunk[x.a_group] = a_chunk
    behind = np.where(np.diff(group) == 0, np.where(np.diff(side) == 0, 0, 1), np.where(np.diff(chunk[group]) == 0, 2, 3))
    out = [""] * (2 * n - 1)
    out[::2] = map(str, np.concatenate((a_ids, b_ids))[order].tolist())
    out[1::2] = map(",|;\n".__getitem__, behind.tolist())
    return "".join(out).split("\n")


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _pieces_of(text: str | None, cuts: bool) -> list[str]:
    return [] if not text else CUT.split(text) if cuts else [text]


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_name: str = BYTE_TOKENIZER,
            b_name: str = PIECE_TOKENIZER, keep_groups: bool = False) -> DataFrame:
    """One row per input row: row, doc_id, figures, groups (or their digest), distinct linked pairs and their counts."""
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text")).withColumn(
        "row", F.monotonically_increasing_id())
    kind = src.schema["doc_id"].dataType.simpleString()
    out = "groups" if keep_groups else "groups_sha256"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Chunks(load_pair(a_name, b_name))
        for batch in batches:
            for part in slices(batch):
                yield _encode_slice(part, memo, keep_groups, out)

    return src.mapInArrow(run, f"row bigint, doc_id {kind}, " + ", ".join(f"{f} bigint" for f in FIGURES)
                          + f", {out} string, pairs array<bigint>, times array<int>")


def _encode_slice(part: pa.RecordBatch, memo: Chunks, keep_groups: bool, out: str) -> pa.RecordBatch:
    memo.bound()
    texts = [_pieces_of(t, memo.pair.cuts) for t in part.column("text").to_pylist()]
    new = list(dict.fromkeys(c for t in texts for c in t if c not in memo.slot))
    if new:
        memo.learn(new)
    slots = [list(map(memo.slot.__getitem__, t)) for t in texts]
    groups = [[memo.groups[s] for s in own] for own in slots]
    # bytes that differ in a chunk differ in the whole: both sides keep the order of the text
    for i, own in enumerate(groups):
        if None in own:
            slots[i], groups[i] = [], []
    counts = np.fromiter(map(len, slots), np.int64, len(slots))
    flat = np.fromiter(chain.from_iterable(slots), np.int64, int(counts.sum()))
    memo.count(flat)
    figures = memo.figures.take(flat)[0].reshape(-1, 4)
    links, sizes = memo.links.take(flat)
    sums = [by_text(figures[:, i], counts) for i in range(4)]
    doc = np.repeat(np.arange(len(texts)), by_text(sizes, counts))
    order = np.lexsort((links, doc))
    links, doc = links[order], doc[order]
    new_pair = np.nonzero(np.concatenate(([True], (np.diff(links) != 0) | (np.diff(doc) != 0))))[0] if len(doc) else order
    times = np.diff(np.append(new_pair, len(doc)))
    edge = pa.array(np.searchsorted(doc[new_pair], np.arange(len(texts) + 1)), pa.int32())
    joined = [";".join(g) for g in groups]
    shown = joined if keep_groups else [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in joined]
    return pa.RecordBatch.from_arrays(
        [part.column("row"), part.column("doc_id"), *[pa.array(s, pa.int64()) for s in sums], pa.array(shown, pa.string()),
         pa.ListArray.from_arrays(edge, pa.array(links[new_pair], pa.int64())),
         pa.ListArray.from_arrays(edge, pa.array(times, pa.int32()))],
        names=["row", "doc_id", *FIGURES, out, "pairs", "times"])


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, count, best) over the corpus; best: the count is the highest of the pair's B id, ties included."""
    listed = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = scratch_table(listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count")), "align-counts")
    b_id = F.col("pair").bitwiseAND((1 << ID_BITS) - 1)
    # as many rows as the vocabulary of B has entries
    top = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("top"))
    return (counts.join(F.broadcast(top), b_id == F.col("b"))
            .select("pair", "count", (F.col("count") == F.col("top")).alias("best")))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_name: str = BYTE_TOKENIZER,
          b_name: str = PIECE_TOKENIZER, keep_groups: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and the groups.

    Texts are encoded whole, without special tokens, with one blank before
    them. The groups are a text ``a1,a2|b1;a3|b2,b3`` (ids in order) with
    ``keep_groups``, else its SHA-256. Null and empty texts, and texts whose
    tokens on one side are not their bytes (a B model that has no piece for a
    character, or a text with U+2581 itself), have no tokens: zeros and an
    empty string. Repeated rows come back repeated and count each time, other
    columns are not read, an empty table gives no row, a null id stays null.
    """
    found = scratch_table(encoded(docs, id_col, text_col, a_name, b_name, keep_groups), "align-documents")
    counts = scratch_table(pair_counts(found), "align-pairs")
    total = found.agg(F.sum("n_links")).first()[0] or 0
    often = F.col("count") * HOT_SHARE >= total
    scored = scratch_table(score_hot_pairs(found, counts.where(often)), "align-scored")
    rare = (scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
            .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
            .join(counts.where(~often), "pair"))
    per_row = rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"),
                                      F.sum(F.col("times") * F.col("count")).alias("rare_sum"))
    zero = F.lit(0).cast("bigint")
    out = "groups" if keep_groups else "groups_sha256"
    return (scored.drop("pairs", "times").join(per_row, "row", "left")
            .select("doc_id", *FIGURES, (F.col("hot_best") + F.coalesce("rare_best", zero)).alias("n_best"),
                    (F.col("hot_sum") + F.coalesce("rare_sum", zero)).alias("count_sum"), out))


def score_hot_pairs(found: DataFrame, hot: DataFrame) -> DataFrame:
    """``found`` with hot_best and hot_sum over its hot pairs; pairs and times keep the others.

    ``hot`` has at most HOT_SHARE rows: each holds 1 / HOT_SHARE of all links.
    """
    table = hot.select("pair", "count", "best").toPandas().sort_values("pair")
    shared = found.sparkSession.sparkContext.broadcast(
        (table["pair"].to_numpy(np.int64), table["count"].to_numpy(np.int64), table["best"].to_numpy(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            pairs = lists.flatten().to_numpy()
            times = batch.column("times").flatten().to_numpy()
            many = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(key, pairs), max(len(key) - 1, 0))
            met = key[at] == pairs if len(key) else np.zeros(len(pairs), bool)
            at = np.where(met, at, 0)
            value = np.where(met, count[at] * times, 0) if len(key) else np.zeros(len(pairs), np.int64)
            hits = np.where(met & best[at], times, 0) if len(key) else value
            left = by_text(~met, many)
            edge = pa.array(np.concatenate(([0], np.cumsum(left))), pa.int32())
            cols = {n: batch.column(n) for n in batch.schema.names}
            cols |= {"hot_best": pa.array(by_text(hits, many), pa.int64()), "hot_sum": pa.array(by_text(value, many), pa.int64()),
                     "pairs": pa.ListArray.from_arrays(edge, pa.array(pairs[~met], pa.int64())),
                     "times": pa.ListArray.from_arrays(edge, pa.array(times[~met], pa.int32()))}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return found.mapInArrow(run, kinds + ", hot_best bigint, hot_sum bigint")
