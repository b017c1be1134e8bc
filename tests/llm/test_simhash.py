"""SimHash near-dedup against brute force over all pairs, and its edge rows."""

import random

import numpy as np
import xxhash

from opslens.llm import simhash
from opslens.llm.common import connected_components


def brute_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    label = list(range(len(fps)))
    for _ in range(len(fps)):
        new = [min(label[j] for j in range(len(fps)) if bin(fps[i] ^ fps[j]).count("1") <= 4) for i in range(len(fps))]
        if new == label:
            break
        label = new
    return label


def test_triples_cover_every_four_positions():
    from itertools import combinations
    family = simhash.triple_family()
    assert len(family) == len(set(family)) == 20
    assert all(any(set(t) <= set(four) for t in family) for four in combinations(range(8), 4))


def test_matches_brute_force(spark, docs_of):
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(60)] + ["É", "Straße", "A\u00a0b"]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 80))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab).upper()
            texts.append(rng.choice([" ", "\n", "\t "]).join(copy))
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, ""), (901, None), (902, " \n\t"), (3, texts[3]), (None, texts[7])]
    got = simhash.near_duplicates(docs_of(rows)).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    label = brute_components(fps)
    smallest = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            smallest[c] = min(smallest.get(c, i), i)
    want = sorted((str(i), f"{f:016x}", smallest.get(c)) for (i, _), f, c in zip(rows, fps, label))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert fps[-3] == fps[-4] == 0


def test_long_text_is_read_whole_in_chunks(monkeypatch):
    text = " ".join(f"t{i % 97}" for i in range(5000)).encode()
    whole = simhash.fingerprint(text, 4)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text, 4) == whole == brute_fingerprint(text.decode())


def test_long_lists_in_blocks_lose_no_link(spark):
    rng = np.random.default_rng(3)
    center = np.uint64(0x0123456789ABCDEF)
    fps = {int(center)}
    for _ in range(400):  # one dense group: many share byte triples
        flips = rng.choice(24, rng.integers(1, 9), replace=False)
        fps.add(int(center) ^ sum(1 << int(b) for b in flips))
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 100)}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.array(f, np.uint64).view(np.int64)),) for f in fps], "fp bigint")
    links = simhash.links(df, 4, list_block=32).collect()
    roots = {r.node: r.root for r in connected_components(simhash.links(df, 4, list_block=32)).collect()}
    as_signed = [int(np.array(f, np.uint64).view(np.int64)) for f in fps]
    label = brute_components(fps)
    got = {}
    for f, c in zip(as_signed, label):
        got.setdefault(c, set()).add(roots.get(f, f))
    assert all(len(v) == 1 for v in got.values())
    assert len({next(iter(v)) for v in got.values()}) == len(got)
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 * 400 for a, b in ((r.a, r.b) for r in links))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7), (5, 4), (4, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(51))
    assert all(got[1000 + i] == 1000 for i in range(60))
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_representatives_keep_one_of_each_component(docs_of):
    same = " ".join(f"word{i}" for i in range(40))
    rows = [(5, same), (2, same), (2, same), (9, "quite another text with its own words in it"), (None, same), (11, None)]
    kept = simhash.keep_representatives(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, same), (9, rows[3][1]), (11, None)]


def test_clashing_columns_stay(docs_of):
    same = " ".join(f"word{i}" for i in range(40))
    docs = docs_of([(5, same), (2, same), (2, same), (9, None)]).selectExpr("*", "'h' AS __text_hash", "7 AS __keep_id", "8 AS __keep_hash")
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r["__text_hash"], r["__keep_id"], r["__keep_hash"]) for r in kept.collect()) == [(2, "h", 7, 8), (9, "h", 7, 8)]


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.keep_representatives(docs_of([])).count() == 0
