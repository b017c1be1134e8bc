"""Decontamination: planted edits up to the allowed distance, agreement with exact search on all pairs."""

import random

import numpy as np
import pytest

from opslens.llm import decontam as D


@pytest.fixture(scope="module")
def bench(spark):
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(10, 60)))) for i in range(60)]
    items += [(60, "only"), (61, "two words"), (62, None), (63, " .. "), (None, "no id here"), (64, " ".join(vocab[:300]))]
    return items, spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")


def edited(words, k, rng):
    words = list(words)
    for _ in range(k):
        at, how = rng.randrange(len(words)), rng.random()
        if how < 0.4:
            words[at] = f"new{rng.randrange(99)}"
        elif how < 0.7:
            words.insert(at, f"new{rng.randrange(99)}")
        else:
            del words[at]
    return words


def plain_distance(item, text):
    """Smallest edit distance between ``item`` and any run of ``text``, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(text):
            new.append(min(row[j] + (w != v), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def exact(texts, items):
    out = {}
    for i, t in texts:
        words = D.words_of(t)
        for j, item in items:
            want = D.words_of(item)
            if j is None or not want:
                continue
            d = plain_distance(want, words)
            if d <= D.allowed_edits(len(want), 0.8):
                out[i, j] = d
    return out


def test_edit_distance_of_substrings():
    a = np.array([1, 2, 3, 4])
    assert D.edit_distance_in(a, np.array([9, 1, 2, 3, 4, 9]))[0] == 0
    assert D.edit_distance_in(a, np.array([1, 2, 9, 3, 4]))[0] == 1
    assert D.edit_distance_in(a, np.array([2, 4]))[0] == 2
    assert D.edit_distance_in(a, np.array([], np.int64))[0] == 4


def test_planted_passages(docs_of, bench):
    items, frame = bench
    rng = random.Random(3)
    noise = lambda n: [f"n{rng.randrange(5000)}" for _ in range(n)]
    texts, planted = [], 0
    for n in range(150):
        j = rng.randrange(60)
        words = D.words_of(items[j][1])
        k = rng.randint(0, D.allowed_edits(len(words), 0.8))
        body = noise(rng.randint(0, 80)) + edited(words, k, rng) + noise(rng.randint(0, 80))
        texts.append((n, rng.choice([" ", ", ", "!! "]).join(body).upper() if n % 7 == 0 else " ".join(body)))
        planted += 1
    texts += [(500 + n, " ".join(noise(300))) for n in range(20)] + [(600, None), (601, ""), (602, "Only!"), (603, "two, WORDS"),
                                                                       (604, items[64][1] if len(items) > 64 else ""),
                                                                       (605, " ".join(noise(40_000)) + " " + items[5][1])]
    got = {(r.doc_id, r.item_id): r.edit_distance for r in D.contaminated(docs_of(texts), frame).collect()}
    small = [t for t in texts if t[0] != 605]
    want = exact(small, items)
    found = {k: v for k, v in got.items() if k[0] != 605}
    assert set(found) <= set(want) and all(want[k] == v for k, v in found.items())
    assert len(found) >= 0.95 * len(want) and len(want) >= planted
    assert (605, 5) in got and (602, 60) in got and (603, 61) in got
    kept = D.drop_contaminated(docs_of(texts), frame)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in texts} - {i for i, _ in got}
    assert kept.columns == docs_of(texts).columns


def test_slices_of_the_benchmark_find_the_same(docs_of, bench):
    items, frame = bench
    texts = [(i, "start " + (t or "") + " end") for i, t in items if i is not None] + [(None, items[0][1]), (0, items[0][1])]
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    whole = key(D.contaminated(docs_of(texts), frame))
    assert whole == key(D.contaminated(docs_of(texts), frame, slice_words=100)) and len(whole) >= 62


def test_equal_items_are_searched_once_and_listed_each(spark, docs_of):
    words = " ".join(f"v{i * i % 59}" for i in range(43))
    frame = spark.createDataFrame([(i, words if i < 300 else f"other {words} x{i}") for i in range(302)], "item_id bigint, text string")
    got = D.contaminated(docs_of([(1, f"a b {words} c"), (2, "nothing of it here")]), frame).collect()
    assert sorted(r.item_id for r in got) == [*range(302)] and {r.doc_id for r in got} == {1}
    assert all(r.edit_distance == (0 if r.item_id < 300 else 2) for r in got)
    index = D.Index([(i, D.words_of(words)) for i in range(300)], 0.8, 48, 2, 42)
    assert len(index.items) == 1 and index.item_ids == [list(range(300))]


def test_empty_tables(docs_of, bench):
    _, frame = bench
    assert D.contaminated(docs_of([]), frame).count() == 0
    assert D.contaminated(docs_of([(1, "two words")]), frame.limit(0)).count() == 0
    assert D.drop_contaminated(docs_of([(1, "two words")]), frame.limit(0)).count() == 1


@pytest.mark.parametrize("length", [300, 1000, 3000])
def test_long_items_with_edits_at_one_end(length):
    """Items of any length are compared as a whole: all allowed edits may lie at the head, at the tail or anywhere."""
    rng = random.Random(length)
    vocab = [f"v{i}" for i in range(3 * length)]
    items = [(i, [rng.choice(vocab) for _ in range(length)]) for i in range(2)]
    index = D.Index(items, 0.8, 48, 2, 42)
    k = D.allowed_edits(length, 0.8)
    assert sum(b - a for a, b in D.pieces_of(length)) == length and max(b - a for a, b in D.pieces_of(length)) <= D.PIECE_WORDS
    noise = lambda n: [f"n{rng.randrange(9999)}" for _ in range(n)]
    texts = []
    for _, words in items:
        texts += [noise(k) + words[k:], words[k:], words[:-k] + noise(k), words[:-k],
                  [w for x in words[:k] for w in (x, "n")] + words[k:], edited(words, k, rng)]
    got = D.find_items([" ".join(noise(50) + t + noise(50)) for t in texts], index)
    assert {(t, i) for t, i, *_ in got} == {(t, t // 6) for t in range(len(texts))}
    assert all(d <= k for _, _, d, _ in got)


def test_the_gate_holds_the_known_runs_and_loses_no_match(spark):
    """Bits by Spark equal bits by hand; all allowed edits pass for every item length; other texts do not."""
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(5000)]
    items = [[rng.choice(vocab) for _ in range(n)] for n in [1, 2, 3, 4, 5, 6, 7, 9, 10, 14, 20, 43, 100, 300]]
    gate = D._gate(spark.createDataFrame([(i, w) for i, w in enumerate(items)], "item bigint, words array<string>"), 0.8)
    want = {int(x) for w in items for x in D.gram_slots(w, D.gate_of(len(w), 0.8)[0])}
    assert set(np.nonzero(np.unpackbits(gate.packed, bitorder="little"))[0].tolist()) == want
    noise = lambda n: [f"n{rng.randrange(9999)}" for _ in range(n)]
    texts = [" ".join(noise(30) + edited(w, D.allowed_edits(len(w), 0.8), rng) + noise(30)) for w in items for _ in range(20)]
    assert gate.passing(texts).all()
    other = [" ".join(noise(300)) for _ in range(50)] + [None, "", " .. "]
    assert not gate.passing(other).any()


def test_dropping_goes_by_text_and_keeps_every_other_row(spark, bench):
    items, frame = bench
    held, clean = items[3][1], "nothing of the kind"
    rows = [(1, held, 7), (1, clean, 7), (None, held, 8), (2, clean, None), (2, clean, None), (3, None, 9), (4, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, held int")
    kept = D.drop_contaminated(docs, frame, slice_words=100)
    assert kept.columns == docs.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(str(r) for r in rows if r[1] != held)
