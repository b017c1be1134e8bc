"""Permutation index: footrule by postings against its definition, recall and order against brute force."""

import numpy as np
import pytest

from opslens.llm import permindex as P


def test_footrule_equals_its_definition():
    rng = np.random.default_rng(0)
    perm = np.stack([rng.permutation(12)[:5] for _ in range(30)])
    files = P.inverted_files(perm, 12)
    for q in perm[:6]:
        got = P.footrule(q, files, len(perm))
        rank = lambda order, p: list(order).index(p) if p in order else 5
        want = [sum(abs(rank(q, p) - rank(x, p)) for p in range(12)) for x in perm]
        assert got.tolist() == want


def brute(ids, x, q, k=10):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
    return [(int(ids[i]), d[i]) for i in np.lexsort((ids, d)) if ids[i] != q][:k]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 16)).astype(np.float32)
    x[1000:2400] = x[7]                       # a vector that fills a third of the table
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = P.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int"), block_rows=700,
                   query_rows=16).collect()
    ids, full = np.arange(4000), x.astype(np.float64)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(range(0, 4000, 100)) and all(len(v) == 10 for v in found.values())
    hits = 0
    for q, near in found.items():
        want = brute(ids, full, q)
        hits += len({i for i, _ in near} & {i for i, _ in want})
        assert near == sorted(near, key=lambda t: (t[1], t[0]))
        assert all(s == pytest.approx(np.sqrt(((full[i] - full[q]) ** 2).sum()), abs=1e-12) for i, s in near)
        if 1000 <= q < 2400:                  # ties go to the smaller id
            assert [i for i, _ in near] == [i for i, _ in want]
    assert hits / 400 >= 0.9


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [0.5, 0.5]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [3.0, 3.0]), (7, [1.0, 2.0, 3.0]), (200, [1.0, 1.0, 1.0]), (300, []), (8, [3.0, 3.0])]
    got = P.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {0: [100, 6, 8], 100: [0, 6, 8], 200: [7]}
    assert P.search(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
