"""Periodic runs against a search over all places and periods, and edge rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from opslens.llm import periodic, queries


def brute_runs(w):
    """All runs: for every period the maximal agreeing stretches; a stretch counts with its smallest period."""
    n, seen = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                seen.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def brute_row(doc_id, text, planted=True):
    words = (text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [x for x in words.split(" ") if x]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(x for i, x in enumerate(words) if i not in dropped)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def scan(w):
    ids = np.array(w, np.int64)
    return sorted((s + a, n, q) for a, b in periodic.surviving_segments(ids, np.array([0, len(ids)]))
                  for s, n, q in periodic.lag_scan(ids[a:b]))


def repeated(rng, size, alphabet):
    base = [rng.randrange(alphabet) for _ in range(size)]
    n = int(size * rng.uniform(2, 6)) + rng.randint(0, 30)
    return [base[i % size] for i in range(n)]


def test_scan_matches_brute_force_on_built_texts():
    rng = random.Random(11)
    for _ in range(300):
        w = []
        for _ in range(rng.randint(1, 5)):
            w += repeated(rng, rng.choice([1, 2, 3, 5, 7, 8, 9, 13, 30]), rng.choice([1, 2, 3, 50]))
            w += [rng.randrange(60) for _ in range(rng.randint(0, 25))]
        if rng.random() < 0.3:
            w = w * rng.randint(2, 4)   # runs inside runs
        assert scan(w) == brute_runs(w)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=30), st.integers(1, 8), st.lists(st.integers(0, 4), max_size=40))
def test_scan_matches_brute_force(base, times, tail):
    w = tail[:7] + base * times + tail
    assert scan(w) == brute_runs(w)


def test_fibonacci_words_and_long_periods():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    assert scan(b) == brute_runs(b)
    rng = random.Random(1)
    base = [rng.randrange(10**6) for _ in range(400)]
    w = base * 3 + [7, 8, 9]
    assert scan(w) == [(0, 1200, 400)] == brute_runs(w)
    assert scan(base * 3 + base[:-1]) == [(0, 1599, 400)]
    assert scan(base + base + base[:-1]) == []   # one word short of three periods


def test_rare_words_split_until_nothing_changes():
    w = [1, 2] * 30 + [99] + [1, 2] * 5 + [3, 98, 3] + [4] * 30
    ids = np.array(w, np.int64)
    assert periodic.surviving_segments(ids, np.array([0, len(ids)])) == [(0, 60), (74, 104)]
    prose = np.array([(i * i) % 97 for i in range(2000)], np.int64)
    assert len(periodic.surviving_segments(np.arange(5000), np.array([0, 5000]))) == 0
    assert sorted(scan(prose.tolist())) == brute_runs(prose.tolist())


def test_a_very_long_run_is_not_quadratic():
    w = list(range(10)) * 30_000 + [5] * 300_000
    assert scan(w) == [(0, 300_000, 10), (300_000, 300_000, 1)]
    lines = [x for i in range(4_000) for x in [i % 7 + 10] * 25 + [1000 + i]]   # thousands of short runs
    assert len(scan(lines)) == 4_000


def test_rows_match_brute_force(docs_of):
    rng = random.Random(4)
    texts = ["", None, " \n\t ", "one", "same " * 24, "same " * 23, "a b c " * 8, "a b c " * 8 + "a b", "é x " * 30,
             "x\u0085y z " * 12, "A a " * 20]
    texts += [" ".join(f"t{x}" for x in repeated(rng, rng.randint(1, 20), 5)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(None, "same " * 40), (4, "same " * 24)]
    got = periodic.run_digests(docs_of(rows), planted=True).collect()
    assert sorted(map(str, got)) == sorted(map(str, (
        type(got[0])(**dict(zip(got[0].__fields__, (i, *brute_row(i, t))))) for i, t in rows)))
    plain = periodic.find_runs(docs_of(rows)).collect()
    by_id = {r.doc_id: r for r in plain}
    assert [tuple(x) for x in by_id[4].runs] == [(0, 24, 1)] and by_id[4].collapsed == "same"
    assert by_id[5].runs == [] and by_id[5].collapsed == " ".join(["same"] * 23)
    assert by_id[7].collapsed == "a b c" and by_id[1].collapsed == "" and by_id[None].collapsed == "same"


def test_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SF_SMALL).collect()}
    short = [d for d in docs if len(d.text) < 12_000]
    assert len(got) == len(docs) and len(short) > 100
    for d in short:
        assert got[d.doc_id] == brute_row(d.doc_id, d.text), d.doc_id
    assert any(r[0] for r in got.values())


def test_empty_table(docs_of):
    assert periodic.run_digests(docs_of([])).count() == 0
    assert periodic.find_runs(docs_of([])).count() == 0
