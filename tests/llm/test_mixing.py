"""Pivotal mixing: targets against a plain loop, totals near targets, expectation, reruns."""

import numpy as np
import pytest

from opslens.llm import mixing


def plain_targets(sizes):
    """Share 150% by weight; cap at twice the size; reshare until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share >= 2 * sizes[s]}
        if not full:
            out |= {s: weight[s] * share for s in open_}
            break
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(9)
    names = ["b", "a", "é", "z", "ab", None, "C"]
    return [(i, " ".join(["w"] * int(rng.integers(0, 40))) + ("\n" if i % 5 else ""),
             names[int(rng.integers(0, 7)) if i % 3 else 0]) for i in range(900)] + [(900, None, "a"), (5, "x y", "b"), (5, "x y", "b"), (None, "q", "z")]


def test_targets_and_totals(docs_of, rows):
    got = mixing.mix(docs_of(rows), group_rows=64, fan_in=4).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        assert abs(taken[s] - want[s]) <= 40  # at most about one document
    assert {r.source: r.source_size for r in got} == sizes


def test_reruns_agree_whatever_the_partitions(docs_of, rows):
    key = lambda df: sorted(map(str, df.collect()))
    a = key(mixing.mix(docs_of(rows).repartition(7), group_rows=64))
    assert a == key(mixing.mix(docs_of(rows[::-1]).coalesce(1), group_rows=64))
    assert a != key(mixing.mix(docs_of(rows), group_rows=64, seed=1))


def test_pivot_keeps_words_and_expectation():
    size = np.array([50.0, 20, 9, 5, 5, 1])
    start = np.array([0.3, 0.7, 0.5, 0.2, 0.9, 0.4])
    total = np.zeros(6)
    for seed in range(3000):
        p = start.copy()
        open_ = mixing.pivot(p, size, np.random.default_rng(seed))
        assert p @ size == pytest.approx(start @ size)
        assert all(x in (0.0, 1.0) or i == open_ for i, x in enumerate(p))
        if open_ >= 0:
            p[open_] = float(np.random.default_rng([seed, 1]).random() < p[open_])
        total += p
    assert total / 3000 == pytest.approx(start, abs=0.04)


def test_mixed_documents_repeat_rows(docs_of, rows):
    mixed = mixing.mixed_documents(docs_of(rows))
    per = mixing.mix(docs_of(rows)).groupBy("doc_id").sum("copies").collect()
    seen = {r[0]: r[1] for r in mixed.groupBy("doc_id").count().collect()}
    assert seen == {r[0]: r[1] for r in per if r[1]}
    assert mixed.columns == [*docs_of(rows).columns, "copy"]


def test_clashing_columns_stay(docs_of, rows):
    docs = docs_of(rows).selectExpr("*", "'mine' AS copy", "'h' AS __text_hash", "1 AS rows")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [*docs.columns, "copy_"]
    got = mixed.collect()
    assert {(r.copy, r["__text_hash"], r.copies, r.rows) for r in got} == {("mine", "h", "v", 1)}
    plain = mixing.mixed_documents(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r["copy_"]) for r in got) == sorted((str(r.doc_id), r["copy"]) for r in plain)


def test_edges(docs_of):
    assert mixing.mix(docs_of([])).count() == 0
    only_empty = mixing.mix(docs_of([(1, None, None), (2, "", "a")])).collect()
    assert {(r.size, r.taken) for r in only_empty} == {(0, 0)}
    one = mixing.mix(docs_of([(1, "a b c", "s")])).first()
    assert one.target == 4.5 and one.taken in (3, 6)
