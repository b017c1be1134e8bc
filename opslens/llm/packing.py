"""Packing by vector bin packing with the dot-product heuristic.

An example asks for three things at once: tokens, segments (one) and
loss-bearing tokens; a sequence offers limits on all three. Sequences are
filled one after the other: of the examples that still fit, the one with the
greatest dot product of its demand and what the sequence has left goes in, each
dimension weighted by how much all examples ask of it. So the scarce limit is
spent on examples that use it well. Examples with equal demand are one class
with a count, so a placement costs a few vector operations over the classes.

Texts may be cut. A text longer than a sequence gives full sequences and a
remainder. Remainders stay whole while some other one fits the gap; a gap of
at least CUT_STEP tokens that no example fits is filled with the head of a
remainder, cut at a multiple of CUT_STEP. The checksums of a remainder's heads
are taken when it is tokenized, and those of cut parts follow from them, so ids
are neither stored nor tokenized again.

Scale: one pass tokenizes and writes a row per piece (no ids); pieces that are
not full are dealt by a hash of their row number into groups of about
GROUP_PIECES, whatever the data holds, and each group is packed on its own. A
group wastes at most one open sequence in hundreds. Sequence numbers are
unique, not dense: no count over all groups is needed.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col, scratch_table
from opslens.llm.tokens import Ragged, byte_pair_tokenizer, by_text, slices

TOKENIZER, END_ID = "word_bpe_49k.json", 1
SEQUENCE_TOKENS, MAX_SEGMENTS = 2048, 256
CUT_STEP = 64
GROUP_PIECES = 2048
MEMO_CHUNKS, MEMO_IDS = 600_000, 6_000_000
PIECE_SCHEMA = ("doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, heads array<bigint>")


# Letters that stay one letter each in lower case and composed form.
WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
JOINED = 1000
PUNCTUATION = re.compile("(?<=[A-Za-z0-9])(?=[.,;:!?])")


class TokenMemo:
    """Ids of distinct chunks, cut at blanks and before punctuation behind a letter or digit.

    The tokenizer drops blanks, never joins across them, and takes letters,
    digits and other characters apart, so the chunks' ids are the text's.
    """

    def __init__(self, name: str) -> None:
        self.tokenizer = byte_pair_tokenizer(name)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        entries = self.tokenizer.get_vocab()
        self.word_end = None   # whether an id ends a word, where the vocabulary says so
        if suffix:
            self.word_end = np.zeros(max(entries.values()) + 1, bool)
            self.word_end[[i for e, i in entries.items() if e.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = Ragged(np.uint32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each text)."""
        if len(self.slot) > MEMO_CHUNKS or self.ids.used > MEMO_IDS:
            self.forget()
        chunks = [PUNCTUATION.sub(" ", t or "").split(" ") for t in texts]
        new = {c for own in chunks for c in own if c not in self.slot}
        if new:
            self._learn(new)
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        rows = np.fromiter(map(self.slot.__getitem__, chain.from_iterable(chunks)), np.int64, int(counts.sum()))
        ids, sizes = self.ids.take(rows)
        return ids, by_text(sizes, counts)

    def _learn(self, new: set[str]) -> None:
        """Chunks of plain letters are one word each: many are encoded as one text and told apart by the word ends."""
        words = [c for c in new if WORD.fullmatch(c)] if self.word_end is not None else []
        texts = [" ".join(words[at:at + JOINED]) for at in range(0, len(words), JOINED)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32, sum(map(len, found)))
        if words:
            sizes = np.diff(np.nonzero(self.word_end[ids])[0], prepend=-1)
            if len(sizes) != len(words) or sizes.sum() != len(ids):
                raise ValueError("the tokenizer does not close each plain word by a word end")
            self._add(words, ids, sizes)
        others = list(new.difference(words))
        if others:
            enc = self.tokenizer.encode(others, is_pretokenized=True, add_special_tokens=False)
            self._add(others, np.array(enc.ids, np.uint32), np.bincount(np.array(enc.word_ids, np.int64), minlength=len(others)))

    def _add(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.slot.update(zip(chunks, range(self.ids.rows, self.ids.rows + len(chunks)), strict=True))
        self.ids.extend(ids, sizes)


@lru_cache
def token_memo(name: str) -> TokenMemo:
    """One per Python worker, so that a task finds what the tasks before it learned."""
    return TokenMemo(name)


def head_checksums(data: memoryview) -> list[int]:
    """CRC-32 of the first CUT_STEP, 2 CUT_STEP, ... ids, as far as there are more behind."""
    out, crc, step = [], 0, 4 * CUT_STEP
    for at in range(0, len(data) - step, step):
        crc = zlib.crc32(data[at:at + step], crc)
        out.append(crc)
    return out


def tail_checksum(head: int, whole: int, n_ids: int) -> int:
    """CRC-32 of the last ``n_ids`` ids, from those of what stands before them and of both together."""
    zeros = bytes(4 * n_ids)
    return whole ^ zlib.crc32(zeros, head) ^ zlib.crc32(zeros)


def text_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                end_id: int = END_ID, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces of at most ``tokens`` ids of every text, each text closed by ``end_id``."""
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = PIECE_SCHEMA.format(kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = token_memo(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids, sizes = memo.encode(part.column("text").to_pylist())
                row, rest, at = [], [], 0
                for i, n in enumerate(sizes.tolist()):
                    own = np.append(ids[at:at + n], np.uint32(end_id)).astype("<u4")
                    data, at = memoryview(own.tobytes()), at + n
                    for a in range(0, n + 1, tokens):
                        piece = data[4 * a:4 * (a + tokens)]
                        row.append(i)
                        rest.append((a, len(piece) // 4, zlib.crc32(piece), n + 1,
                                     [] if len(piece) == 4 * tokens else head_checksums(piece)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())),
                     *[pa.array([r[k] for r in rest], pa.int64()) for k in range(4)],
                     pa.array([r[4] for r in rest], pa.list_(pa.int64()))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "heads"])

    return src.mapInArrow(run, schema)


class Placed(NamedTuple):
    """One placement: the example, where in it the part starts, its tokens, its sequence and place there."""
    item: int
    start: int
    length: int
    sequence: int
    offset: int


def pack(tokens: Sequence[int], loss: Sequence[int], limits: tuple[int, int, int], cuttable: bool = False) -> list[Placed]:
    """Placements of all examples under (tokens, segments, loss-bearing tokens) of a sequence.

    With ``cuttable`` an example may be cut at multiples of CUT_STEP; its
    parts then bear loss on all tokens but their first. An example that
    exceeds a limit on its own gets a sequence to itself.
    """
    out: list[Placed] = []
    limit = np.array(limits, np.float64)
    demand = np.stack((np.asarray(tokens), np.ones(len(tokens)), np.asarray(loss)), axis=1).astype(np.float64)
    weight = demand.sum(axis=0) / limit / limit
    members: dict[tuple[float, ...], list[tuple[int, int]]] = {}
    over = (demand > limit).any(axis=1)
    sequence = 0
    for i in np.nonzero(over)[0].tolist():
        out.append(Placed(i, 0, int(demand[i, 0]), sequence, 0))
        sequence += 1
    for i in np.nonzero(~over)[0].tolist()[::-1]:   # lists are emptied from their end: first come, first placed
        members.setdefault(tuple(demand[i]), []).append((i, 0))
    classes = np.array(sorted(members, reverse=True)).reshape(-1, 3)
    lists = [members[tuple(c)] for c in classes]
    alive = np.ones(len(classes), bool)
    while alive.any():
        if alive.mean() < 0.5:
            lists = [x for x, a in zip(lists, alive.tolist(), strict=True) if a]
            classes, alive = classes[alive], np.ones(int(alive.sum()), bool)
        room, used = limit.copy(), 0
        while True:
            fits = alive & (classes <= room).all(axis=1)
            if fits.any():
                k = int(np.where(fits, classes @ (weight * room), -1.0).argmax())
                item, start = lists[k].pop()
                length = int(classes[k, 0])
                room -= classes[k]
            else:
                length = int(min(room[0], room[2] + 1)) // CUT_STEP * CUT_STEP if cuttable and room[1] >= 1 else 0
                longer = np.nonzero(alive & (classes[:, 0] > length))[0] if length else ()
                if not len(longer):
                    break
                k = int(longer[0])   # the longest
                item, start = lists[k].pop()
                rest = float(classes[k, 0] - length)
                room -= (length, 1, length - 1)
                tail = np.array([rest, 1.0, rest - 1])
                same = np.nonzero((classes == tail).all(axis=1))[0]
                if len(same):
                    lists[same[0]].append((item, start + length))
                    alive[same[0]] = True
                else:
                    at = int(np.searchsorted(-classes[:, 0], -rest))
                    classes, alive = np.insert(classes, at, tail, axis=0), np.insert(alive, at, True)
                    lists.insert(at, [(item, start + length)])
                    k += at <= k
            alive[k] = bool(lists[k])
            out.append(Placed(item, start, length, sequence, used))
            used += length
        sequence += 1
    return out


def group_of(row: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(groups))


def _number_of_groups(open_rows: int) -> int:
    return max(1, -(-open_rows // GROUP_PIECES))


def pack_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
               end_id: int = END_ID, tokens: int = SEQUENCE_TOKENS, segments: int = MAX_SEGMENTS,
               loss_tokens: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every text is tokenized whole and closed by ``end_id``; a null text is the
    empty one, so each input row gives at least one piece. All ids but the
    first of a piece bear loss. A sequence holds at most ``tokens`` ids,
    ``segments`` pieces and ``loss_tokens`` loss-bearing ids (default: no
    limit of its own); its pieces lie one behind the other from offset 0.
    Repeated rows are packed each, other columns are not read, an empty table
    gives no row, a null id stays null.
    """
    pieces = scratch_table(text_pieces(docs, id_col, text_col, tokenizer, end_id, tokens)
                           .withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    short = pieces.where(F.col("length") < tokens)
    limits = (tokens, segments, tokens if loss_tokens is None else loss_tokens)
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(key: tuple, g: pa.Table) -> pa.Table:
        g = g.sort_by("row").combine_chunks()
        length = g.column("length").to_numpy()
        placed = pack(length, length - 1, limits, cuttable=True)
        item, start, n, sequence, offset = np.array(placed, np.int64).reshape(-1, len(Placed._fields)).T
        whole = g.column("ids_crc32").to_numpy()
        crc = whole[item]
        for i in np.nonzero(n != length[item])[0].tolist():
            heads = [0, *g.column("heads")[int(item[i])].as_py()]
            end = int(start[i] + n[i])
            total = int(whole[item[i]]) if end == length[item[i]] else heads[end // CUT_STEP]
            crc[i] = tail_checksum(heads[int(start[i]) // CUT_STEP], total, int(n[i]))
        own = g.take(pa.array(item))
        return pa.table({
            "doc_id": own.column("doc_id"), "start": pa.array(own.column("start").to_numpy() + start),
            "length": pa.array(n), "ids_crc32": pa.array(crc), "doc_tokens": own.column("doc_tokens"),
            "sequence_id": pa.array(2 * ((key[0].as_py() << 32) + sequence) + 1), "offset": pa.array(offset)})

    groups = _number_of_groups(short.count())
    schema = (f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint")
    packed = short.withColumn("group", group_of(F.col("row"), groups)).groupBy("group").applyInArrow(run, schema)
    full = pieces.where(F.col("length") == tokens).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("row") * 2).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(full)


def pack_examples(examples: DataFrame, tokens_col: str = "n_tokens", loss_col: str = "n_loss",
                  tokens: int = SEQUENCE_TOKENS, segments: int = MAX_SEGMENTS, loss_tokens: int | None = None) -> DataFrame:
    """``examples`` with sequence_id and token_offset: whole examples under all three limits.

    For instruction data, where an example must not be cut and only part of
    its tokens bears loss. An example that exceeds a limit on its own gets a
    sequence to itself. A null count is 0; an existing column sequence_id or
    token_offset is replaced.
    """
    kept = [c for c in examples.columns if c not in ("sequence_id", "token_offset")]
    rows = scratch_table(examples.select(
        F.struct(*[col(c) for c in kept]).alias("example"), F.monotonically_increasing_id().alias("row"),
        F.coalesce(col(tokens_col).cast("bigint"), F.lit(0)).alias("tokens"),
        F.coalesce(col(loss_col).cast("bigint"), F.lit(0)).alias("loss")), "packing-examples")
    limits = (tokens, segments, tokens if loss_tokens is None else loss_tokens)

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("row", ignore_index=True)
        p = pd.DataFrame(pack(g["tokens"], g["loss"], limits), columns=Placed._fields)
        return pd.DataFrame({"row": g["row"].to_numpy()[p["item"]], "sequence_id": (key[0] << 32) + p["sequence"],
                             "token_offset": p["offset"]})

    places = (rows.select("row", "tokens", "loss", group_of(F.col("row"), _number_of_groups(rows.count())).alias("group"))
              .groupBy("group").applyInPandas(run, "row bigint, sequence_id bigint, token_offset bigint"))
    return rows.join(places, "row").select("example.*", "sequence_id", "token_offset")


def conversation_examples(conversations: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                          answering: str = "assistant") -> DataFrame:
    """(conv_id, n_tokens, n_loss): a conversation's tokens, ``end_id`` behind each turn; answers bear loss."""
    src = conversations.select(col("conv_id").alias("conv_id"), col("role").cast("string").alias("role"),
                               col("text").cast("string").alias("text"))
    kind = src.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = token_memo(tokenizer)
        for batch in batches:
            for part in slices(batch):
                n = memo.encode(part.column("text").to_pylist())[1] + 1
                yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("role"), pa.array(n, pa.int64())],
                                                 names=["conv_id", "role", "n"])

    turns = src.mapInArrow(run, f"conv_id {kind}, role string, n bigint")
    return turns.groupBy("conv_id").agg(F.sum("n").alias("n_tokens"),
                                        F.sum(F.when(F.col("role") == answering, F.col("n")).otherwise(0)).alias("n_loss"))
