"""Vector packing: ids come back exactly, limits hold, little padding; the packer against its own rules."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_SMALL
from opslens.llm import packing, queries
from opslens.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path(packing.TOKENIZER))


ODD = ["", None, " ", "  two   blanks ", "tab\tand\nline", "<|endoftext|>", "a<|startoftext|>b <|endoftext|> c", "don't WE'LL x's",
       "ΟΔΥΣΣΕΥΣ ΣΑΣ", "é ́x İ", " nb  space", "日本語 テキスト", "\x1c \x85  ", "ﬁ １２", "a " * 5000, "x" * 3000]


def checked(rows, got, tokenizer, tokens=2048, segments=packing.MAX_SEGMENTS):
    """Every id lies in one piece with its checksum, sequences are gapless and within the limits; returns the padding."""
    ids_of = {}
    for i, t in rows:
        ids_of.setdefault(i, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(ids_of)
    for i, texts in ids_of.items():
        want, mine = {}, {}
        for r in pieces[i]:
            mine[r.start, r.length, r.ids_crc32] = mine.get((r.start, r.length, r.ids_crc32), 0) + 1
            ids = texts[0][r.start:r.start + r.length]
            assert r.length == len(ids) > 0 and r.doc_tokens == len(texts[0])
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert sum(r.length for r in pieces[i]) == sum(map(len, texts))
        covered = np.zeros(len(texts[0]), int)
        for r in pieces[i]:
            covered[r.start:r.start + r.length] += 1
        assert (covered == len(texts)).all(), want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= tokens and len(parts) <= segments
        padding += tokens - at
    return padding, len(sequences)


def test_ids_come_back(docs_of, tokenizer):
    rows = list(enumerate(ODD)) + [(None, "a null id " * 300)]
    checked(rows, packing.pack_texts(docs_of(rows)).collect(), tokenizer)


def test_repeated_rows_are_packed_each(docs_of, tokenizer):
    rows = [(5, "same text " * 90)] * 7 + [(6, None)]
    got = packing.pack_texts(docs_of(rows)).collect()
    checked(rows, got, tokenizer)


def test_cut_remainders_keep_checksums_and_leave_little_padding(docs_of, tokenizer):
    rows = [(i, "word " * 1100) for i in range(60)]   # no two fit one sequence
    padding, n = checked(rows, packing.pack_texts(docs_of(rows)).collect(), tokenizer)
    assert n == 33 and padding < 2048 + 32 * packing.CUT_STEP


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=10), max_size=6).map(" ".join))
def test_chunks_encode_like_whole_texts(text):
    memo = packing.TokenMemo(packing.TOKENIZER)
    ids, sizes = memo.encode([text, "again", text])
    want = memo.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids[:sizes[0]].tolist() == want == ids[sizes[:2].sum():].tolist()


def test_remembering_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_CHUNKS", 3)
    memo = packing.TokenMemo(packing.TOKENIZER)
    first = memo.encode(["a b c d e"])[0].tolist()
    assert len(memo.slot) == 5
    assert memo.encode(["e d"])[0].tolist() == first[:2:-1] and len(memo.slot) == 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 130), st.integers(0, 60)), max_size=60), st.booleans())
def test_packer_places_all_under_all_limits(items, cuttable):
    limits = (100, 4, 50)
    tokens, loss = [t for t, _ in items], [t - 1 if cuttable else x for t, x in items]
    placed = packing.pack(tokens, loss, limits, cuttable)
    covered = {i: sorted((p.start, p.length) for p in placed if p.item == i) for i in range(len(items))}
    for i, t in enumerate(tokens):
        at = 0
        for start, n in covered[i]:
            assert start == at
            at += n
        assert at == t
    for s in {p.sequence for p in placed}:
        own = sorted((p for p in placed if p.sequence == s), key=lambda p: p.offset)
        whole = [loss[p.item] if p.length == tokens[p.item] else p.length - 1 for p in own]
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1].tolist()]
        if len(own) > 1:
            assert sum(p.length for p in own) <= 100 and len(own) <= 4 and sum(whole) <= 50


def test_scarce_dimension_decides():
    # loss is scarce: with tokens alone the two heavy ones would share a sequence
    placed = packing.pack([60, 40, 60, 40], [30, 30, 0, 0], (100, 8, 30))
    by = {}
    for p in placed:
        by.setdefault(p.sequence, set()).add(p.item)
    assert sorted(map(sorted, by.values())) in ([[0, 3], [1, 2]],)
    assert packing.pack([], [], (100, 8, 30)) == []
    assert sorted(p.sequence for p in packing.pack([300, 1], [0, 0], (100, 8, 30))) == [0, 1]


def test_examples_of_conversations(spark):
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    examples = packing.conversation_examples(conv)
    limits = {"tokens": 512, "segments": 8, "loss_tokens": 200}
    got = packing.pack_examples(examples, **limits).collect()
    assert len(got) == conv.select("conv_id").distinct().count()
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.token_offset)
        assert [r.token_offset for r in own] == [0, *np.cumsum([r.n_tokens for r in own])[:-1].tolist()]
        if len(own) > 1:
            assert sum(r.n_tokens for r in own) <= 512 and len(own) <= 8 and sum(r.n_loss for r in own) <= 200
    total = sum(r.n_tokens for r in got), sum(r.n_loss for r in got), len(got)
    least = max(total[0] / 512, total[1] / 200, total[2] / 8)
    assert len(bins) <= 1.25 * least + 1


def test_examples_with_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5, 9), (1, 600, None, 9), (None, 3, 3, 9)],
                               "conv_id bigint, n_tokens bigint, n_loss bigint, sequence_id bigint")
    got = packing.pack_examples(df, tokens=512)
    assert got.columns == ["conv_id", "n_tokens", "n_loss", "sequence_id", "token_offset"] and got.count() == 3
    assert packing.pack_examples(df.limit(0)).count() == 0


def test_query_on_the_whole_table(spark, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op13_vector_packing(spark, SF_SMALL).collect()
    padding, n = checked(docs, got, tokenizer)
    assert padding <= 0.02 * 2048 * n + 2048
    again = queries.op13_vector_packing(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_empty_table(docs_of):
    assert packing.pack_texts(docs_of([])).count() == 0


def test_group_numbers_are_even(spark):
    rng = random.Random(1)
    rows = spark.range(rng.randint(40_000, 41_000))
    n = packing._number_of_groups(rows.count())
    sizes = [r["count"] for r in rows.groupBy(packing.group_of(rows["id"], n)).count().collect()]
    assert len(sizes) == n and max(sizes) < 1.2 * packing.GROUP_PIECES
