"""The corpus pipeline on planted documents: each stage against a plain reading of its input."""

import random

import pytest

import corpus_pipeline as C
from opslens.llm import decontam, mixing, pii, simhash
from opslens.llm.common import scratch_table

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, copies string, spans string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    syllables = ["the", "ing", "on", "er", "at", "ou", "sh", "re", "tion", "and"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(15, 40))) for i in range(8)]
    docs, labels = [], []
    for i in range(700):
        body, toxic = text(rng.randint(20, 80)), i % 9 == 0
        if toxic:
            words = body.split()
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron"]))
            body = " ".join(words)
        docs.append((i, body, "en", f"s{i % 4}"))
        labels.append((i, 1, int(toxic)))
    clean = [d for d in docs if d[0] % 9]
    docs += [(1000 + n, clean[n][1], "en", "copy") for n in range(30)]                          # exact copies
    docs += [(1100 + n, text(10) + " " + items[n % 8][1] + " " + text(10), "en", "leak") for n in range(16)]
    docs += [(1200 + n, f"{text(30)} mail joe{n}@mail.com ip 10.1.2.{n} {text(5)}", "en", "pii") for n in range(10)]
    docs += [(1300, None, None, None), (1301, "", "en", None), (None, text(50), "en", "s1"), (1, docs[1][1], "en", "s1")]
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(*d, None if d[1] is None else len(d[1]), "c", "s") for d in docs]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return f"file://{folder}", docs, items


@pytest.fixture(scope="module")
def staged(spark, corpus):
    """Every stage's result, each written and read again."""
    folder, _, _ = corpus
    df = spark.read.parquet(f"{folder}/documents.parquet")
    out = {"input": df}
    for name, stage in C.STAGES:
        df = scratch_table(stage(spark, df, folder), f"t-{name}")
        out[name] = df
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages_in_order_and_columns(staged):
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "mixing"]
    for name in ("toxicity", "near_dedup", "decontamination", "pii"):
        assert staged[name].schema.simpleString() == staged["input"].schema.simpleString()
    assert staged["mixing"].columns == [*staged["input"].columns, "copy"]


def test_toxic_documents_go_and_clean_ones_stay(staged):
    left = {r["doc_id"] for r in rows(staged["toxicity"])}
    assert not left & {i for i in range(700) if i % 9 == 0}
    assert len({r["doc_id"] for r in rows(staged["input"]) if r["doc_id"] is None or r["doc_id"] >= 700 or r["doc_id"] % 9} - left) <= 3


def test_one_of_each_group_stays(staged):
    before, after = rows(staged["toxicity"]), rows(staged["near_dedup"])
    fps = [simhash.fingerprint(None if r["text"] is None else r["text"].encode(), 4) for r in before]
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4 and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    keep = {}
    for g, r in zip(group, before, strict=True):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        keep[g] = min(keep.get(g, key), key)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == sorted(keep.values())


def test_leaks_go(staged, corpus):
    items = [decontam.words_of(t) for _, t in corpus[2]]

    def holds(text):
        words = decontam.words_of(text)
        return any(words[i:i + len(t)] == t for t in items for i in range(len(words) - len(t) + 1))

    before, after = rows(staged["near_dedup"]), rows(staged["decontamination"])
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if not holds(r["text"])}


def test_personal_data_is_replaced(staged):
    before = {r["doc_id"]: r for r in rows(staged["decontamination"])}
    after = {r["doc_id"]: r for r in rows(staged["pii"])}
    assert set(before) == set(after)
    for i, r in after.items():
        assert not pii.base_spans(r["text"] or "")[0]
        if not pii.find_spans(before[i]["text"]):
            assert r["text"] == before[i]["text"] and r["n_chars"] == before[i]["n_chars"]
        else:
            assert r["n_chars"] == len(r["text"])
    assert any("[EMAIL]" in (r["text"] or "") and "[IP]" in r["text"] for r in after.values())


def test_the_mix_meets_its_targets(staged):
    docs, mixed = rows(staged["pii"]), rows(staged["mixing"])
    assert {r["text"] for r in mixed} <= {r["text"] for r in docs}
    targets = {r["source"]: r["target"] for r in mixing.source_targets(staged["pii"].select(
        "source", mixing.word_count("text").alias("size"))).collect()}
    words = {}
    for r in mixed:
        words[r["source"]] = words.get(r["source"], 0) + len((r["text"] or "").split())
        assert 1 <= r["copy"] <= 2
    for s, target in targets.items():
        assert abs(words.get(s, 0) - target) <= 90


def test_run_equals_the_stages(spark, corpus, staged):
    key = lambda df: sorted(str((r["doc_id"], r["text"], r["copy"])) for r in rows(df))
    assert key(C.run(spark, corpus[0])) == key(staged["mixing"])


def test_empty_documents(spark, corpus):
    folder, _, _ = corpus
    df = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        df = scratch_table(stage(spark, df, folder), f"e-{name}")
        assert df.count() == 0
