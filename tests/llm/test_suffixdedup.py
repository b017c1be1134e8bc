"""Repeated substrings against brute force over all byte strings; every path must give the same."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from opslens.llm import suffixdedup as S

L = 24


def brute(texts, length):
    where = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if where[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    rand = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, line = rand(70), rand(L)
    texts = [rand(rng.randint(0, 200)) for _ in range(30)]
    texts += [rand(rng.randint(0, 40)) + passage[rng.randint(0, 20):rng.randint(40, 70)] + rand(rng.randint(0, 40)) for _ in range(40)]
    texts += [texts[0] * 2, "a" * 300, "ab" * 100, line + "x" + line, line, passage, passage, passage, "short", "short", "", None,
              texts[3][:50] + "é" + texts[3][50:], rand(20_000) + passage, "x" * 23, "x" * 24]
    return list(enumerate(texts)) + [(3, texts[3]), (None, texts[5])]


@pytest.mark.parametrize("hot", [{}, {"hot_stretches": 3}, {"hot_bytes": 100}, {"hot_bytes": 0}])
def test_matches_brute_force(docs_of, rows, hot):
    got = S.remove_repeats(docs_of(rows).repartition(5), min_length=L, keep_text=True, **hot).collect()
    data = [(t or "").encode() for _, t in rows]
    want = sorted((str(i), *w) for (i, _), w in zip(rows, brute(data, L), strict=True))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept_text)) for r in got) == want


def test_shares_and_slices_change_nothing(monkeypatch, rows):
    data = [(t or "").encode() for _, t in rows]

    def spans():
        out = []
        for part in S._groups([len(t) for t in data]):
            names = S.Names(data[part], L)
            for t, v, a, b in names.stretches([_All()] * len(data[part])):
                out.append((v, part.start + t, 0, a, data[part][t][a:b + L]))
        covered = {}
        for k1, _, s, e in S.repeated_spans(out, L):
            covered.setdefault(k1, []).append((s, e))
        return {k: S.merged(v) for k, v in covered.items()}

    whole = spans()
    assert whole
    monkeypatch.setattr(S, "STARTS_AT_ONCE", 100)
    monkeypatch.setattr(S, "SLICE_BYTES", 300)
    assert spans() == whole


class _All(set):
    def __contains__(self, _):
        return True


def test_names_of_equal_strings_agree():
    rng = random.Random(1)
    rand = lambda n: bytes(rng.randrange(97, 101) for _ in range(n))
    shared = rand(60)
    a, b = S.Names([rand(33) + shared + rand(9)], L), S.Names([rand(5), rand(50) + shared], L)
    for i in range(60 - L + 1):
        assert a.name[33 + i] == b.name[5 + 50 + i]
    text, name, several = S.Names([b"a" * 60, b"b" * 10], L).places()
    assert text.tolist() == [0] and several.tolist() == [True]
    assert np.array_equal(S.full_buckets(np.frombuffer(shared + shared, np.uint8), L)[:10],
                          S.full_buckets(np.frombuffer(shared + shared, np.uint8), L)[60:70])


@pytest.mark.parametrize("length", [4, 5, 24, 25, 27])
def test_refined_starts_match_brute_force(monkeypatch, length):
    """Random and periodic pieces, in one share, in many shares, and with q-grams taken in chunks."""
    rng = random.Random(length)
    for _ in range(40):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 4 * length))) for _ in range(rng.randint(1, 5))]
        parts += [b"abc" * length, parts[0][:length], b"z" * (length + rng.randint(0, 9))]
        where = Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
        ends = np.cumsum([len(p) for p in parts])
        want = [int(e) - len(p) + i for e, p in zip(ends, parts, strict=True) for i in range(len(p) - length + 1)
                if where[p[i:i + length]] > 1]
        for at_once, chunk in ((2 << 20, 2 << 20), (5, 2 << 20), (2 << 20, 50)):
            monkeypatch.setattr(S, "STARTS_AT_ONCE", at_once)
            monkeypatch.setattr(S, "SLICE_BYTES", chunk)
            got = S.repeated_starts(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]), length)
            assert got.tolist() == want


def test_a_position_alone_drops_what_leads_to_it():
    data = np.frombuffer(b"abcdefgh" + b"abcdefgX", np.uint8)
    room = np.repeat([8, 16], 8) - np.arange(16)
    first = S.numbered(S.qgrams(data, 2), np.arange(15), 16)
    assert first[0] == first[8] >= 0 and first[6] == first[14] == first[7] == -1
    four = S.refine_by_sort(first, room, 2, 4)
    assert np.nonzero(four >= 0)[0].tolist() == [0, 1, 2, 3, 8, 9, 10, 11]
    assert np.nonzero(S.refine_by_sort(four, room, 4, 7) >= 0)[0].tolist() == [0, 8]
    assert not (S.refine_by_sort(four, room, 4, 8) >= 0).any()


def test_pieces_of_a_long_stretch(monkeypatch):
    monkeypatch.setattr(S, "PIECE_STARTS", 4)
    assert list(S.pieces(3, 12)) == [(3, 6), (7, 10), (11, 12)] and list(S.pieces(5, 5)) == [(5, 5)]


def test_empty_table_and_bad_length(docs_of):
    assert S.remove_repeats(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        S.remove_repeats(docs_of([]), min_length=3)
