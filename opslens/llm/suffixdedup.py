"""Repeated-substring removal by bucket-pointer refinement.

A string of ``min_length`` = L bytes that starts at two places is removed at
both. Strings are told apart by bucket identifiers refined recursively, as in
bucket-pointer suffix sorting: the first bucket of a position is its q-gram
(q = L / 4). A pass sorts the positions by their own bucket and the bucket one
width later, renumbers them, and drops those that stand alone; the next pass
sorts by these updated numbers, until a bucket stands for L bytes. Positions
that can be equal at all are brought together by Spark first, so no rank table
of the corpus is needed:

1. Every L-byte string contains L - q + 1 q-grams. The smallest of their
   identifiers names the string's initial bucket, and neighbouring strings
   mostly share it, so a text has about 2 / (L - q + 1) names per byte. Equal
   strings have the same name, so a name seen at only one place in the corpus
   ends here. Names are counted over all texts by one pre-aggregated groupBy.
2. For the names that repeat, each text hands on its *stretches*: runs of
   starts with that name, with the bytes they need. Stretches meet by name,
   are refined to L-byte buckets and sorted; a start whose bucket has another
   member is repeated.
3. The repeated starts return to their texts as intervals, which are cut.

Equal texts are one text from the beginning (they meet by a 128-bit key, one
per task), so groups of copies cost what one copy costs. A stretch is handed on
in pieces of at most PIECE_STARTS starts, whatever the text's length. A name
with more than ``hot_stretches`` pieces or ``hot_bytes`` bytes is not gathered:
its starts are dealt out singly by their L-byte bucket and pre-aggregated.
There identifiers must agree between tasks, so they are 64-bit hashes of the
two buckets of each refinement instead of numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col, scratch_table

SLICE_BYTES = 2 << 20
STARTS_AT_ONCE = 2 << 20
PIECE_STARTS = 1 << 19
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LOW, HIGH = np.uint64(0), np.uint64((1 << 64) - 1)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        grown = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        grown[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(grown)
        if len(have) > 4 * SLICE_BYTES:  # one very long text must not stay in memory
            _POWERS.pop(base)
    return have[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def qgrams(data: np.ndarray, q: int) -> np.ndarray:
    """Bucket identifier of the q-gram at each position of ``data`` (bytes)."""
    n = len(data)
    if n < q:
        return np.empty(0, np.uint64)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTES[data] * _powers(BASE, n), out=total[1:])
    return _mix((total[q:] - total[:-q]) * _powers(INVERSE, n)[: n - q + 1])


def refine(bucket: np.ndarray, offset: int) -> np.ndarray:
    """Bucket of the longer string: from a position's bucket and the one ``offset`` later."""
    if len(bucket) <= offset:
        return np.empty(0, np.uint64)
    return _mix(bucket[:-offset] * np.uint64(0xA0761D6478BD642F) + bucket[offset:])


def numbered(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each of ``n`` positions: the rank of its key among those at ``at``, -1 elsewhere and for a key met once."""
    out = np.full(n, -1, np.int64)
    if len(keys) < 2:
        return out
    order = np.argsort(keys)
    keys = keys[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    alone = new & np.concatenate((new[1:], [True]))
    out[at[order[~alone]]] = (np.cumsum(new) - 1)[~alone]
    return out


def refine_by_sort(bucket: np.ndarray, room: np.ndarray, width: int, length: int) -> np.ndarray:
    """Buckets of ``length`` bytes from those of ``width`` bytes (-1: alone), sorting by later buckets until they are.

    ``room`` is the number of bytes from each position to the end of its piece.
    A position is dropped as soon as it or the position it points to is alone:
    whatever contains a string that occurs once occurs once.
    """
    while width < length:
        offset = min(width, length - width)
        at = np.nonzero((bucket >= 0) & (room >= width + offset))[0]
        later = bucket[at + offset]
        at, later = at[later >= 0], later[later >= 0]
        bucket = numbered(bucket[at] * (len(bucket) + 1) + later, at, len(bucket))
        width += offset
    return bucket


def full_buckets(data: np.ndarray, length: int) -> np.ndarray:
    """Bucket of the ``length`` bytes at each position, as a hash that is the same in every task."""
    q = -(-length // 4)
    double = refine(qgrams(data, q), q)
    return refine(double, length - 2 * q)


def _sliding(values: np.ndarray, width: int, op: np.ufunc, pad: np.uint64) -> np.ndarray:
    """``op`` over each window of ``width`` values (from running results in blocks of that width)."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    blocks = np.full(-(-n // width) * width, pad, np.uint64)
    blocks[:n] = values
    grid = blocks.reshape(-1, width)
    forward = op.accumulate(grid, axis=1).ravel()
    backward = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(backward[: n - width + 1], forward[width - 1:n])


class Names:
    """Names (smallest q-gram bucket) of all L-byte strings of some texts laid end to end."""

    def __init__(self, texts: list[bytes], length: int):
        self.length, self.width = length, length - -(-length // 4) + 1
        self.lens = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.lens)
        self.starts = self.ends - self.lens
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.grams = qgrams(self.data, -(-length // 4))
        self.name = _sliding(self.grams, self.width, np.minimum, HIGH)
        # a start is good when its string ends inside its own text
        self.good = np.zeros(len(self.name), bool)
        for s, e in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            if e - s >= length:
                self.good[s:e - length + 1] = True

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, name, whether it stands at several places of the text), distinct and by text."""
        if not self.good.any():
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
        # a q-gram gives a name when it is the smallest of some good window around it
        named = np.where(self.good, self.name, LOW)
        pad = np.full(self.width - 1, LOW, np.uint64)
        reach = _sliding(np.concatenate((pad, named, pad)), self.width, np.maximum, LOW)
        at = np.nonzero((self.grams == reach) & (reach != LOW))[0]
        text = np.searchsorted(self.ends, at, side="right")
        order = np.lexsort((self.grams[at], text))
        text, name = text[order], self.grams[at][order]
        first = np.concatenate(([True], (text[1:] != text[:-1]) | (name[1:] != name[:-1])))
        head = np.nonzero(first)[0]
        return text[head], name[head], np.diff(np.concatenate((head, [len(name)]))) > 1

    def stretches(self, wanted: list[set[int]]) -> Iterator[tuple[int, int, int, int]]:
        """(text, name, first start, last start) of the runs of good starts whose name the text wants."""
        if not self.good.any():
            return
        text = np.searchsorted(self.ends, np.arange(len(self.name)), side="right") if len(self.lens) > 1 else None
        change = np.ones(len(self.name), bool)
        change[1:] = (self.name[1:] != self.name[:-1]) | (self.good[1:] != self.good[:-1])
        if text is not None:
            change[1:] |= text[1:] != text[:-1]
        head = np.nonzero(change)[0]
        tail = np.concatenate((head[1:], [len(self.name)])) - 1
        use = self.good[head]
        own = np.searchsorted(self.ends, head[use], side="right")
        for t, v, a, b in zip(own.tolist(), self.name[head[use]].view(np.int64).tolist(), head[use].tolist(),
                              tail[use].tolist(), strict=True):
            if v in wanted[t]:
                yield t, v, a - int(self.starts[t]), b - int(self.starts[t])


def _groups(sizes: list[int]) -> Iterator[slice]:
    """Consecutive rows of about SLICE_BYTES (a longer one stands alone)."""
    at = held = 0
    for i, n in enumerate(sizes):
        if i > at and held + n > SLICE_BYTES:
            yield slice(at, i)
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield slice(at, len(sizes))


def text_keys(text: Column) -> list[Column]:
    """128 bits that name a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def name_table(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, k1, k2, n_bytes, sha, names, several): per row the names of its strings and which occur at several places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [t or b"" for t in batch.column("text").to_pylist()]
            names: list[np.ndarray] = []
            several: list[np.ndarray] = []
            for part in _groups([len(t) for t in text]):
                found = Names(text[part], length)
                own, name, many = found.places()
                at = np.searchsorted(own, np.arange(len(found.lens) + 1))
                for a, b in zip(at[:-1], at[1:], strict=True):
                    names.append(name[a:b].view(np.int64))
                    several.append(many[a:b])
            kind = pa.list_(pa.int64()), pa.list_(pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k1"), batch.column("k2"),
                 pa.array([len(t) for t in text], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in text]),
                 pa.array(names, kind[0]), pa.array(several, kind[1])],
                names=["doc_id", "k1", "k2", "n_bytes", "sha", "names", "several"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, k1 bigint, k2 bigint, n_bytes bigint, sha string, "
                                 "names array<bigint>, several array<boolean>")


def one_per_task(texts: DataFrame) -> DataFrame:
    """Rows whose (k1, k2) this task has not seen yet, so a text comes at most once from each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            new = []
            for key in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True):
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    return texts.mapInArrow(run, texts.schema)


def pieces(first: int, last: int) -> Iterator[tuple[int, int]]:
    """(first, last) of consecutive ranges of at most PIECE_STARTS starts."""
    for at in range(first, last + 1, PIECE_STARTS):
        yield at, min(at + PIECE_STARTS - 1, last)


def stretch_table(texts: DataFrame, length: int) -> DataFrame:
    """(name, k1, k2, at, data): the stretches of wanted names in pieces, each with the bytes of its strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("name", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int64()),
                            ("data", pa.binary())])
        for batch in batches:
            text, names = batch.column("text").to_pylist(), batch.column("names").to_pylist()
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for part in _groups([len(t) for t in text]):
                rows = [(v, k1[part.start + t], k2[part.start + t], i, text[part.start + t][i:j + length])
                        for t, v, a, b in Names(text[part], length).stretches([set(n) for n in names[part]])
                        for i, j in pieces(a, b)]
                for few in _groups([len(r[4]) for r in rows]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows[few], strict=True), schema, strict=True)], schema=schema)

    return texts.select("k1", "k2", "text", "names").mapInArrow(
        run, "name bigint, k1 bigint, k2 bigint, at bigint, data binary")


def _starts(rows: list[tuple], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, stretch, offset) of every start of the stretches."""
    data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    lens = np.array([len(r[4]) for r in rows], np.int64)
    bucket = full_buckets(data, length)
    n = lens - length + 1
    own = np.repeat(np.arange(len(rows)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return bucket[np.repeat(np.cumsum(lens) - lens, n) + offset], own, offset


def repeated_starts(data: np.ndarray, lens: np.ndarray, length: int) -> np.ndarray:
    """Positions whose ``length`` bytes start at another position too; ``data`` is pieces of ``lens`` bytes end to end.

    The starts are taken in shares of their initial buckets, so that what is
    sorted at once stays bounded; equal strings begin with the same bucket.
    """
    q = -(-length // 4)
    n = len(data)
    grams = np.concatenate([qgrams(data[i:i + SLICE_BYTES + q - 1], q) for i in range(0, max(n - q + 1, 0), SLICE_BYTES)]
                           or [np.empty(0, np.uint64)])
    room = np.repeat(np.cumsum(lens), lens) - np.arange(n)
    starts = np.nonzero(room >= length)[0]
    # every position that a start leads to by the offsets of the passes
    offsets, width = [0], q
    widths = []
    while width < length:
        widths.append(min(width, length - width))
        width += widths[-1]
    for step in reversed(widths):
        offsets += [o + step for o in offsets]
    shares = -(-len(starts) // STARTS_AT_ONCE)
    out = []
    for share in range(shares):
        own = starts if shares == 1 else starts[_mix(grams[starts]) % np.uint64(shares) == share]
        used = np.zeros(n, bool)
        for o in sorted(set(offsets)):
            used[own + o] = True
        at = np.nonzero(used)[0]
        bucket = refine_by_sort(numbered(grams[at], at, n), room, q, length)
        out.append(own[bucket[own] >= 0])
    return np.sort(np.concatenate(out)) if out else starts


def repeated_spans(rows: list[tuple], length: int) -> list[tuple[int, int, int, int]]:
    """(k1, k2, start, end) of the bytes covered by strings that occur at two places; whole names only.

    Strings of different names differ, so several names can share the passes.
    """
    rows = list({(r[0], r[1], r[2], r[3]): r for r in rows}.values())  # a place counts once
    if not rows:
        return []
    lens = np.array([len(r[4]) for r in rows], np.int64)
    at = repeated_starts(np.frombuffer(b"".join(r[4] for r in rows), np.uint8), lens, length)
    if not len(at):
        return []
    ends = np.cumsum(lens)
    own = np.searchsorted(ends, at, side="right")
    at = at - (ends - lens)[own]
    head = np.nonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1))))[0]
    tail = np.concatenate((head[1:], [len(own)])) - 1
    out = []
    for o, a, b in zip(own[head].tolist(), at[head].tolist(), at[tail].tolist(), strict=True):
        _, k1, k2, start, _ = rows[o]
        out.append((k1, k2, start + a, start + b + length))
    return out


SPAN = "k1 bigint, k2 bigint, s bigint, e bigint"


def _span_batch(spans: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*spans, strict=True)],
                                      names=["k1", "k2", "s", "e"])


def spans_by_name(stretches: DataFrame, length: int) -> DataFrame:
    """Covered byte spans per text; stretches of a name meet in one task, several names at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SLICE_BYTES and row[0] != held[-1][0]:
                    if spans := repeated_spans(held, length):
                        yield _span_batch(spans)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held and (spans := repeated_spans(held, length)):
            yield _span_batch(spans)

    return stretches.repartition("name").sortWithinPartitions("name").mapInArrow(run, SPAN)


def spans_by_bucket(stretches: DataFrame, length: int) -> DataFrame:
    """The same for hot names: every start goes by its own bucket, counted before it is joined back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for part in _groups([len(r[4]) for r in rows]):
                bucket, own, offset = _starts(rows[part], length)
                own = own + part.start
                keys = [np.array([r[i] for r in rows], np.int64)[own] for i in (0, 1, 2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.view(np.int64)), *(pa.array(k) for k in keys[:3]), pa.array(keys[3] + offset)],
                    names=["bucket", "name", "k1", "k2", "at"])

    starts = stretches.mapInArrow(run, "bucket bigint, name bigint, k1 bigint, k2 bigint, at bigint")
    place = F.xxhash64("k1", "k2", "at")
    several = (starts.groupBy("bucket", "name").agg(F.min(place).alias("a"), F.max(place).alias("b"))
               .where("a <> b").select("bucket", "name"))
    return starts.join(several, ["bucket", "name"]).select("k1", "k2", F.col("at").alias("s"),
                                                           (F.col("at") + length).alias("e"))


def merged(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the given disjoint, sorted spans."""
    kept, at = [], 0
    for s, e in spans:
        kept.append(text[at:s])
        at = e
    return b"".join(kept) + text[at:]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 400,
                   hot_stretches: int = 50_000, hot_bytes: int = 8 << 20, keep_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text if asked).

    Texts are UTF-8 bytes, null counts as empty. Every byte covered by a
    string of ``min_length`` bytes that also starts anywhere else, in the same
    or another row, is removed; strings are judged on the input. Repeated rows
    are other places, so their strings go too. Null ids are kept, an empty
    table gives no rows, other columns are not read. ``kept_text`` is binary,
    since a cut may split a character.
    """
    if min_length < 4:
        raise ValueError("min_length must be at least 4 bytes")
    text = F.coalesce(col(text_col).cast("binary"), F.lit(b""))
    src = docs.select(col(id_col).alias("doc_id"), text.alias("text")).select("doc_id", "text", *text_keys(F.col("text")))
    table = scratch_table(name_table(src, min_length), "repeat-names")
    keys = ["k1", "k2"]

    # initial buckets: names at two places or more
    places = table.select("k1", "k2", F.explode(F.arrays_zip("names", "several")).alias("n")).select(
        "k1", "k2", F.col("n.names").alias("name"), F.col("n.several").alias("several"))
    who = F.xxhash64("k1", "k2")
    repeated = (places.groupBy("name").agg(F.min(who).alias("a"), F.max(who).alias("b"), F.max("several").alias("several"))
                .where((F.col("a") != F.col("b")) | F.col("several")).select("name"))
    wanted = places.join(repeated, "name").groupBy(*keys).agg(F.collect_set("name").alias("names"))

    # the texts that hold them, one of each
    texts = one_per_task(src.where(F.octet_length("text") >= min_length).select("k1", "k2", "text"))
    texts = scratch_table(texts.join(wanted, keys), "repeat-texts")
    stretches = scratch_table(stretch_table(texts, min_length), "repeat-stretches")
    hot = (stretches.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("data")).alias("size"))
           .where((F.col("n") > hot_stretches) | (F.col("size") > hot_bytes)).select("name"))
    hot = scratch_table(hot, "repeat-hot")
    if hot.isEmpty():
        spans = spans_by_name(stretches, min_length)
    else:
        spans = spans_by_name(stretches.join(hot, "name", "left_anti"), min_length).unionByName(
            spans_by_bucket(stretches.join(hot, "name", "left_semi"), min_length))
    per_text = spans.groupBy(*keys).agg(F.collect_list(F.struct("s", "e")).alias("spans"))

    # whole copies need no cutting
    copies = (table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("n_bytes").alias("n_removed"))
              .where((F.col("n") > 1) & (F.col("n_removed") >= min_length)).drop("n"))
    copies = scratch_table(copies, "repeat-copies")
    partly = per_text.join(copies, keys, "left_anti").join(texts.select("k1", "k2", "text"), keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k1, k2, found, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = merged([(x["s"], x["e"]) for x in found])
                kept = cut(data, spans)
                rows.append((k1, k2, len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                             kept if keep_text else None))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["k1", "k2", "n_removed", "n_spans", "cut_sha", "cut_text"])

    changed = partly.select("k1", "k2", "spans", "text").mapInArrow(
        run, "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, cut_sha string, cut_text binary").dropDuplicates(keys)
    changed = changed.unionByName(copies.select(
        "k1", "k2", "n_removed", F.lit(1).cast("bigint").alias("n_spans"), F.lit(EMPTY_SHA).alias("cut_sha"),
        F.lit(b"").alias("cut_text")))
    zero = F.lit(0).cast("bigint")
    out = table.select("doc_id", "k1", "k2", "n_bytes", "sha").join(changed, keys, "left")
    result = out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                        F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("cut_sha", "sha").alias("kept_sha256"),
                        *(["k1", "k2", "cut_text"] if keep_text else []))
    if not keep_text:
        return result
    own = src.select("text", "k1", "k2").dropDuplicates(keys)
    return result.join(own, keys).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                                         F.coalesce("cut_text", "text").alias("kept_text"))
