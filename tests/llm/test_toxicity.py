"""Toxicity: Kneser-Ney probabilities against a plain dictionary model, held-out accuracy, edge rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from opslens.llm import toxicity as T


def plain_shared(grams):
    """P(w | context) over tuples of symbols from distinct left neighbours, by recursion."""
    levels = {k: {g[-(k + 1):] for g in grams} for k in range(1, T.ORDER)}

    def prob(gram):
        k = len(gram)
        if k == 0:
            return 1.0 / T.SYMBOLS
        count = Counter(g[1:] for g in levels[k])
        total = sum(n for g, n in count.items() if g[:-1] == gram[:-1])
        types = sum(1 for g in count if g[:-1] == gram[:-1])
        if not total:
            return prob(gram[1:])
        return (max(count[gram] - T.SHARED_DISCOUNT, 0) + T.SHARED_DISCOUNT * types * prob(gram[1:])) / total

    return prob


def code(gram):
    out = 0
    for s in gram:
        out = out << T.BITS | s
    return out


def test_shared_model_equals_plain_recursion():
    sym = T.symbolise(["the cat sat on the mat", "a theme"]).s
    grams = {tuple(sym[i:i + T.ORDER].tolist()) for i in range(len(sym) - T.ORDER + 1)}
    got = T.shared_model(np.array([code(g) for g in grams]))
    want = plain_shared(grams)
    for g in list(grams)[:12]:
        assert got[code(g[1:])] == pytest.approx(want(g[1:]))
    context = next(iter(grams))[1:4]
    assert sum(got[code((*context, s))] for s in range(T.SYMBOLS)) == pytest.approx(1.0)


def test_model_prefers_the_class_a_gram_is_from():
    one = np.array([code((1, 2, 3, 4, 5)), code((1, 2, 3, 4, 6))])
    m = T.build_model(one, np.array([9.0, 1]), np.array([1.0, 9]), np.array([5, 3]), np.array([4.0, 0]), np.array([0.0, 4]),
                      [(10, 2, 1, 1), (10, 2, 1, 1)])
    assert m.ratio[0] > 0 > m.ratio[1] and m.words.tolist() == [3, 5] and m.word_ratio[1] > 0 > m.word_ratio[0]


def test_symbols_and_word_hashes():
    s = T.symbolise(["Éa, b", None, "", "a b"])
    assert s.s[s.doc == 0].tolist() == [0, 0, 0, 0, 5, 1, 0, 2, 0]
    starts, ends, h = T.word_hashes(s.s)
    assert len(set(h.tolist())) == 3  # ea, b, a, b
    long = T.symbolise(["x " * 1000 + "word " * 3])
    _, _, h = T.word_hashes(long.s)
    assert len(set(h.tolist())) == 2
    counted = T._counted(np.array([7, 7, 9], np.int64), np.array([1, 0, 1]))
    assert [c.tolist() for c in counted] == [[7, 9], [1, 1], [1, 0]]
    counted = T._counted(np.array([7, 7, 9], np.int32), np.array([1, -1, 0]))
    assert [c.tolist() for c in counted] == [[7, 9], [1, 0], [0, 1]]


def test_slices_do_not_change_features(monkeypatch):
    texts = ["abc def", None, "ghi " * 50, "", "é 12 x"]
    m = T.build_model(np.array([code((0, 0, 0, 0, 1))]), np.array([1.0]), np.array([2.0]), np.empty(0, np.int64),
                      np.empty(0), np.empty(0), [(1, 1, 1, 0), (1, 1, 1, 0)])
    whole = T.text_features(texts, m)
    monkeypatch.setattr(T, "SLICE_CHARS", 4)
    assert np.allclose(T.text_features(texts, m), whole)
    assert not whole[1].any() and not whole[3].any()


@pytest.fixture(scope="module")
def corpus(spark, docs_of):
    rng = random.Random(4)
    syllables = ["the", "ing", "on", "er", "at", "ou", "sh", "re"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    rows, marks = [], []
    for i in range(1500):
        words = [word() for _ in range(rng.randint(3, 60))]
        toxic = i % 8 == 0
        for _ in range(max(2, len(words) // 15) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "zlurk" + word()]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    extra = [(2000, None), (2001, ""), (None, "idiot scum"), (2002, "idiot " * 30_000), (3, rows[3][1])]
    labels = spark.createDataFrame([*marks, (None, 1), (5, None), (0, 1), (0, 0)], "doc_id bigint, toxic int")
    return rows + extra, docs_of(rows + extra), labels, dict(marks)


def test_held_out_accuracy_and_rows(corpus):
    rows, docs, labels, truth = corpus
    got = T.score_documents(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[2000].score == by_id[2001].score and by_id[2002].predicted == 1


def test_held_out_labels_change_nothing(corpus):
    from pyspark.sql import functions as F
    rows, docs, labels, _ = corpus
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    key = lambda df: sorted((str(r.doc_id), round(r.score, 9)) for r in df.collect())
    assert key(T.score_documents(docs, labels)) == key(T.score_documents(docs.repartition(3), flipped))


def test_filter_and_empty_tables(corpus, docs_of):
    rows, docs, labels, truth = corpus
    kept = T.keep_ordinary(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    wrong = sum((i in set(ids)) == bool(t) for i, t in truth.items())
    assert wrong < 0.05 * len(truth) and 2000 in ids and 2002 not in ids
    assert T.score_documents(docs_of([]), labels).count() == 0
    assert T.score_documents(docs.limit(20), labels.limit(0)).count() == 20


def test_rare_words_count_whatever_is_broadcast(corpus, monkeypatch):
    """A word below the share of the broadcast keeps its ratio: fewer broadcast words change no score."""
    rows, docs, labels, _ = corpus
    docs = docs.where("doc_id is not null")

    def scores():
        return sorted((r.doc_id, r.score, r.predicted) for r in T.score_documents(docs, labels).collect())

    whole, kept = scores(), sorted(r.doc_id for r in T.keep_ordinary(docs, labels).collect())
    monkeypatch.setattr(T, "WORD_SHARE", 20)
    few = scores()
    assert [(i, p) for i, _, p in few] == [(i, p) for i, _, p in whole]
    assert [s for _, s, _ in few] == pytest.approx([s for _, s, _ in whole], rel=1e-3, abs=1e-4)
    assert sorted(r.doc_id for r in T.keep_ordinary(docs, labels).collect()) == kept


def test_words_are_their_real_characters():
    """Scripts outside Latin, digits and accents tell words apart; case does not."""
    words = ["слово", "клово", "слова", "λόγος", "λόγον", "كلمات", "מילים", "漢字文字列", "漢字文字表", "abc1", "abc2", "a1", "a2", "pêche",
             "peche", "𝒜𝒷𝒸𝒹𝑒", "𝒜𝒷𝒸𝒹𝒻"]
    _, _, h = T.word_hashes(T.symbolise([" ".join(words)]).units)
    assert len(h) == len(set(h.tolist())) == len(words)
    _, _, h = T.word_hashes(T.symbolise(["СЛОВО", "слово", "Straße", "STRASSE"]).units)
    assert h[0] == h[1] and h[2] == h[3]


def test_the_bit_field_holds_every_key(spark):
    rng = np.random.default_rng(5)
    keys = rng.integers(-2**63, 2**63 - 1, 3000)
    field = T._field(spark.createDataFrame([(int(k),) for k in keys], "key bigint"))
    assert T._may_hold(field, keys).all()
    assert T._may_hold(field, rng.integers(-2**63, 2**63 - 1, 3000)).sum() < 10
    assert not len(T._field(spark.createDataFrame([], "key bigint")))


def test_labels_of_the_calibration_fold_are_counted_but_not_for_the_curve(spark, docs_of):
    """An expression of toxic texts of that fold only is known to the model that scores, not to the one that calibrates."""
    fold = lambda i: zlib.crc32(str(i).encode()) % T.FOLDS
    rows, marks = [], []
    for i in range(200):
        toxic = i % 4 == 0
        word = ("zlurkbane" if fold(i) == T.CALIBRATION else "scumtoad") if toxic else "meadow"
        rows.append((i, f"a quiet {word} text of {word} and number {i}"))
        marks.append((i, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    known = T.labelled(docs_of(rows), labels, "doc_id", "text", "doc_id", "toxic")
    from pyspark.sql import functions as F
    counts = T.gram_and_word_counts(known.select("text", F.coalesce("label", F.lit(-1)).cast("int").alias("y"),
                                                 (F.col("fold") == T.CALIBRATION).alias("held")))
    _, _, h = T.word_hashes(T.symbolise(["zlurkbane scumtoad meadow"]).units)
    full, held = (dict(zip(m.words.tolist(), m.word_ratio.tolist())) for m in (T.train(counts)[0], T.train(counts, True)[0]))
    assert full[h[0]] > 1 and h[0] not in held
    assert full[h[1]] > 1 and held[h[1]] > 1 and full[h[2]] < 0
    got = {r.doc_id: r.predicted for r in T.score_documents(docs_of(rows), labels).collect()}
    assert sum(got[i] == y for i, y in marks) >= 0.95 * len(marks)
