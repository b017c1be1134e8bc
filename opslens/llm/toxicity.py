"""Toxicity by class-conditional Kneser-Ney models with shared backoff.

Two models score each text, one trained on toxic and one on ordinary labelled
texts, and their log-likelihoods are compared per character and per word:

* Characters: 5-grams over a five-bit alphabet (boundary, folded letters,
  digit, four classes for other scripts). The top order is counted per class.
  All lower orders are continuation counts of *all* texts, labelled or not,
  shared by both classes, so a rare expression of one class is smoothed by
  what is known about its spelling everywhere.
* Words: absolute-discounted counts per class over a shared uniform backoff. A
  word is its case-folded code points, in any script and with its digits.

Counting is distributed: a batch emits its distinct 5-grams and words with
class counts, which Spark adds up. Every counted word keeps its ratio. Those
that make up at least ``1 / WORD_SHARE`` of a class (so at most WORD_SHARE per
class) are broadcast; the others stay a Spark table, and the words of a
document that the broadcast does not hold are joined to it by shuffle, unless a
broadcast bit field of fixed size (a bit per hash, no false negatives) shows
that the table lacks them. The broadcasts decide where a word is looked up, never
what it counts. What reaches the driver is bounded: these words, the bit field
and at most 2**25 possible 5-grams. A logistic curve over the normalised
log-likelihood ratios is fitted on at most ``calibration_rows`` rows of one fold
of the labelled ones, scored by a model without that fold's labels; the model
that scores the documents counts all labels outside the held-out fold.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col, scratch_table, tidy
from opslens.llm.tokens import slices as text_slices

ORDER, BITS = 5, 5
SYMBOLS, GRAMS, CONTEXTS = 1 << BITS, 1 << (BITS * ORDER), 1 << (BITS * (ORDER - 1))
SHARED_DISCOUNT = 0.75
WORD_SHARE = 1 << 20
FIELD_BITS = 26       # log2 of the bits that show which words may be in the table of rare words
BLOCK_BITS = 18       # and of a block of them
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
SLICE_CHARS = 1 << 19
BROADCAST_LABELS = 2_000_000
MARGIN = 3.0          # of a word's log ratio, beyond which it counts as an expression of a class
FEATURES = ("mean_char", "max_char", "excess_char", "top_char", "log_words", "max_word", "top_word", "mean_word")
LENGTH = FEATURES.index("log_words")
HASH_BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def _alphabet() -> np.ndarray:
    """Symbol of each UTF-16 unit: 0 boundary, 1-26 letters without accents, 27 digit, 28-31 other letters."""
    table = np.zeros(0x10000, np.uint8)
    for cp in range(0x10000):
        ch = chr(cp)
        base = unicodedata.normalize("NFKD", ch.lower())[:1]
        if "a" <= base <= "z":
            table[cp] = ord(base) - 96
        elif ch == "ß":
            table[cp] = 19
        elif ch.isdigit():
            table[cp] = 27
        elif ch.isalpha() or 0xD800 <= cp < 0xE000:
            table[cp] = 28 + cp % 4
    return table


_CACHE: dict = {}


def _lookup() -> np.ndarray:
    if "alphabet" not in _CACHE:
        _CACHE["alphabet"] = _alphabet()
    return _CACHE["alphabet"]


class Symbols(NamedTuple):
    """Texts as one symbol array: ORDER-1 boundaries before each text and one behind it, runs of boundaries as one."""
    s: np.ndarray       # symbols
    doc: np.ndarray     # text of each symbol
    scored: np.ndarray  # symbols that are predicted (not the leading boundaries)
    units: np.ndarray   # case-folded UTF-16 unit of each symbol, 0 for boundaries


def symbolise(texts: list[str | None]) -> Symbols:
    lead = np.zeros(ORDER - 1, np.uint16)
    units, lens, heads = [], [], []
    for t in texts:
        u = np.frombuffer((t or "").casefold().encode("utf-16-le", "surrogatepass"), np.uint16)
        units += [lead, u, lead[:1]]
        lens.append(len(u) + ORDER)
    lens_a = np.array(lens, np.int64)
    folded = np.concatenate(units)
    s = _lookup()[folded]
    starts = np.cumsum(lens_a) - lens_a
    heads = np.zeros(len(s), bool)
    for k in range(ORDER - 1):
        heads[starts + k] = True
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    keep |= heads
    # the boundary behind an empty text or after a leading boundary is not needed twice
    doc = np.repeat(np.arange(len(texts)), lens_a)
    return Symbols(s[keep], doc[keep], ~heads[keep], np.where(s[keep] != 0, folded[keep], 0))


def gram_codes(s: np.ndarray) -> np.ndarray:
    """Code of the 5-gram that ends at each symbol (from position ORDER-1 on)."""
    n = len(s) - ORDER + 1
    out = s[:n].astype(np.int32)
    for k in range(1, ORDER):
        out <<= BITS
        out |= s[k:k + n]
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def word_hashes(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, 64-bit hashes) of the runs of letters and digits, of symbols or units."""
    inside = s != 0
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts, ends = np.nonzero(inside & ~before)[0], np.nonzero(inside & ~after)[0] + 1
    # in place and freed early: each array is four times the text
    mixed = s.astype(np.uint64)
    mixed += np.uint64(1)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    mixed *= _powers(HASH_BASE, len(s))
    total = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mixed, out=total[1:])
    del mixed
    h = total[ends] - total[starts]
    del total
    h *= _powers(pow(HASH_BASE, -1, 1 << 64), len(s))[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xE7037ED1A0B428DB)
    return starts, ends, (h ^ (h >> np.uint64(29))).view(np.int64)


def slices(texts: list[str | None]) -> Iterator[list[int]]:
    """Indexes of texts in groups of about SLICE_CHARS characters (a longer text stands alone)."""
    group, chars = [], 0
    for i, t in enumerate(texts):
        if group and chars + len(t or "") > SLICE_CHARS:
            yield group
            group, chars = [], 0
        group.append(i)
        chars += len(t or "")
    if group:
        yield group


def _counted(keys: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their counts in toxic (1) and ordinary (0) texts; others (-1) are only seen."""
    order = np.sort((keys.astype(np.int64) << 2) | (label + 1)) if keys.dtype != np.int64 else None
    if order is not None:
        packed, n = np.unique(order, return_counts=True)
        key, lab = packed >> 2, (packed & 3) - 1
        distinct, at = np.unique(key, return_inverse=True)
    else:
        distinct, at = np.unique(keys, return_inverse=True)
        lab, n = label, np.ones(len(keys), np.int64)
    tox = np.bincount(at, weights=n * (lab == 1), minlength=len(distinct)).astype(np.int64)
    ordinary = np.bincount(at, weights=n * (lab == 0), minlength=len(distinct)).astype(np.int64)
    return distinct, tox, ordinary


COUNTS = ("toxic", "ordinary", "toxic_held", "ordinary_held")


def gram_and_word_counts(texts: DataFrame) -> DataFrame:
    """(kind, key, COUNTS): kind 0 = 5-grams of all texts, kind 1 = words of labelled texts.

    ``texts`` has text, y (1, 0, or -1 for texts whose label is not used) and
    held (their counts are also given apart, for the model that calibrates).
    """
    def rows(kind: int, keys: np.ndarray, label: np.ndarray, held: np.ndarray) -> Iterator[pa.RecordBatch]:
        for apart in (False, True):
            pick = held & (label >= 0) if apart else slice(None)
            key, tox, ordinary = _counted(keys[pick], label[pick])
            if len(key):
                none = np.zeros(len(key), np.int64)
                counts = (none, none, tox, ordinary) if apart else (tox, ordinary, none, none)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), kind, np.int32)), pa.array(key.astype(np.int64)), *map(pa.array, counts)],
                    names=["kind", "key", *COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(text_slices, batches)):
            text = batch.column("text").to_pylist()
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int8)
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for group in slices(text):
                sym = symbolise([text[i] for i in group])
                pick = sym.scored[ORDER - 1:]
                doc = sym.doc[ORDER - 1:][pick]
                yield from rows(0, gram_codes(sym.s)[pick], y[group][doc], held[group][doc])
                starts, _, h = word_hashes(sym.units)
                doc = sym.doc[starts]
                own = y[group][doc] >= 0
                yield from rows(1, h[own], y[group][doc[own]], held[group][doc[own]])

    return (texts.mapInArrow(tidy(run), "kind int, key bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))
            .groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in COUNTS]))


def _discount(once: float, twice: float) -> float:
    return once / (once + 2 * twice) if once and twice else SHARED_DISCOUNT


def shared_model(seen: np.ndarray) -> np.ndarray:
    """P(symbol | up to three symbols before it), from the distinct left neighbours of each gram; indexed by 4-gram."""
    prob = np.full(SYMBOLS, 1.0 / SYMBOLS)
    grams = np.unique(seen)
    for k in range(1, ORDER):
        # the distinct (k+1)-grams give the continuation counts of k-grams
        longer = np.unique(grams & ((1 << (BITS * (k + 1))) - 1))
        count = np.bincount(longer & ((1 << (BITS * k)) - 1), minlength=1 << (BITS * k)).reshape(-1, SYMBOLS).astype(np.float64)
        total, types = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
        lower = np.tile(prob.reshape(-1, SYMBOLS), (max(1, len(count) * SYMBOLS // len(prob)), 1)) if k > 1 else prob.reshape(1, -1)
        mixed = (np.maximum(count - SHARED_DISCOUNT, 0) + SHARED_DISCOUNT * types * lower) / np.maximum(total, 1)
        prob = np.where(total > 0, mixed, lower).reshape(-1)
    return prob


class Model(NamedTuple):
    """Log ratios toxic / ordinary: of seen 5-grams, of unseen ones by context, and of the broadcast words.

    ``field``: bits of the words that the Spark table beside it may hold; empty without further words.
    """
    grams: np.ndarray
    ratio: np.ndarray
    unseen: np.ndarray
    words: np.ndarray
    word_ratio: np.ndarray
    field: np.ndarray = np.empty(0, np.int64)


def word_weights(word_stats: list[tuple[float, float, float, float]]) -> list[tuple[float, float, float]]:
    """Per class: (discount, words, probability of a word that the class has not seen)."""
    kinds = max(1.0, max(s[1] for s in word_stats))
    out = []
    for total, types, once, twice in word_stats:
        d = _discount(once, twice)
        freed = d * types / total if total else 1.0   # what discounting takes from all words of the class
        out.append((d, max(total, 1.0), max(freed, 1e-9) / kinds))
    return out


def build_model(grams: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, words: np.ndarray, word_toxic: np.ndarray,
                word_ordinary: np.ndarray, word_stats: list[tuple[float, float, float, float]]) -> Model:
    """``word_stats`` per class (toxic, ordinary): words, types, types seen once, types seen twice."""
    shared = shared_model(grams)[grams & (CONTEXTS - 1)]
    context = grams >> BITS
    ratio, unseen = None, []
    for n in (toxic, ordinary):
        d = _discount(float((n == 1).sum()), float((n == 2).sum()))
        total = np.bincount(context, weights=n, minlength=CONTEXTS)
        types = np.bincount(context, weights=n > 0, minlength=CONTEXTS)
        back = np.where(total > 0, d * types / np.maximum(total, 1), 1.0)
        p = np.maximum(n - d, 0)
        p /= np.maximum(total, 1)[context]
        p += back[context] * shared
        np.log(p, out=p)
        ratio = p if ratio is None else np.subtract(ratio, p, out=ratio)
        unseen.append(np.log(back))
    ps = [np.maximum(n - d, 0) / total + back
          for n, (d, total, back) in zip((word_toxic, word_ordinary), word_weights(word_stats), strict=True)]
    order = np.argsort(words)
    return Model(grams.astype(np.int32), ratio.astype(np.float32),
                 (unseen[0] - unseen[1]).astype(np.float32), words[order],
                 np.log(ps[0] / ps[1])[order].astype(np.float32))


def train(counts: DataFrame, hold_back: bool = False) -> tuple[Model, DataFrame]:
    """(model, (key, ratio) of the words that it does not hold) from ``gram_and_word_counts``; see the module text.

    With ``hold_back`` the labels of the calibration fold are not counted.
    """
    if hold_back:
        counts = counts.withColumns({c: F.col(c) - F.col(f"{c}_held") for c in ("toxic", "ordinary")})
    g = counts.where("kind = 0").select("key", "toxic", "ordinary").orderBy("key").toPandas()
    words = counts.where("kind = 1 and toxic + ordinary > 0").select("key", "toxic", "ordinary")
    stats = words.agg(*[f(c).cast("double") for c in ("toxic", "ordinary") for f in (
        F.sum, lambda c: F.count_if(F.col(c) > 0), lambda c: F.count_if(F.col(c) == 1),
        lambda c: F.count_if(F.col(c) == 2))]).first()
    values = [float(v or 0) for v in stats]
    word_stats = [tuple(values[:4]), tuple(values[4:])]
    often = ((F.col("toxic") * WORD_SHARE >= max(values[0], 1.0)) | (F.col("ordinary") * WORD_SHARE >= max(values[4], 1.0)))
    kept = words.where(often).toPandas()
    p = [F.greatest(F.col(c) - F.lit(d), F.lit(0.0)) / F.lit(total) + F.lit(back)
         for c, (d, total, back) in zip(("toxic", "ordinary"), word_weights(word_stats), strict=True)]
    rare = words.where(~often).select("key", F.log(p[0] / p[1]).cast("float").alias("ratio"))
    grams = [g.pop(c).to_numpy(t) for c, t in (("key", np.int64), ("toxic", np.float64), ("ordinary", np.float64))]
    del g
    model = build_model(*grams, kept["key"].to_numpy(np.int64), kept["toxic"].to_numpy(np.float64),
                        kept["ordinary"].to_numpy(np.float64), word_stats)
    return model._replace(field=_field(rare)), rare


def _field(rare: DataFrame) -> np.ndarray:
    """2**FIELD_BITS bits in words of 64, set at the top bits of each key; empty for an empty table.

    Tasks build it in blocks, of which at most 2**(FIELD_BITS - BLOCK_BITS) reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("at").to_numpy()
            for block in np.unique(at >> BLOCK_BITS).tolist():
                own = at[at >> BLOCK_BITS == block] & ((1 << BLOCK_BITS) - 1)
                blocks.setdefault(block, np.zeros(1 << BLOCK_BITS, bool))[own] = True
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array(
                [np.packbits(b, bitorder="little").tobytes() for b in blocks.values()], pa.binary())], names=["block", "bits"])

    at = rare.select(F.shiftrightunsigned("key", 64 - FIELD_BITS).alias("at"))
    rows = at.repartition(F.shiftright("at", BLOCK_BITS)).mapInArrow(run, "block bigint, bits binary").collect()
    size = 1 << (BLOCK_BITS - 6)
    out = np.zeros(1 << (FIELD_BITS - 6) if rows else 0, np.int64)
    for r in rows:
        out[r["block"] * size:(r["block"] + 1) * size] = np.frombuffer(r["bits"], "<i8")
    return out


def _may_hold(field: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key.view(np.uint64) >> np.uint64(64 - FIELD_BITS)
    return (field.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _dense(model: Model) -> np.ndarray:
    """Log ratio of every possible 5-gram (64 MB), built once per task."""
    key = (len(model.grams), float(model.ratio[:64].sum()), float(model.unseen.sum()), len(model.words))
    if _CACHE.get("dense_of") != key:
        table = np.repeat(model.unseen.astype(np.float16), SYMBOLS)
        table[model.grams] = model.ratio.astype(np.float16)
        _CACHE["dense"], _CACHE["dense_of"] = table, key
    return _CACHE["dense"]


def _forget() -> None:
    """Drop the table of 5-grams; later stages use the same Python worker."""
    _CACHE.pop("dense", None)
    _CACHE.pop("dense_of", None)


def _top(values: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest value and sum of the three largest per document (0 without any)."""
    order = np.lexsort((-values, doc))
    v, d = values[order], doc[order]
    rank = np.arange(len(d)) - np.searchsorted(d, d)
    first = np.zeros(n)
    first[d[rank == 0]] = v[rank == 0]
    return first, np.bincount(d[rank < 3], weights=v[rank < 3], minlength=n)


NONE = np.empty(0, np.int64)


class Words(NamedTuple):
    """Word evidence of texts: by text the number of words and the up to three largest known ratios; words to look up."""
    n: np.ndarray                              # words of each text
    unknown: np.ndarray                        # words that are not broadcast
    top: list[list[float]]                     # largest ratios of broadcast words
    asked: list[tuple[np.ndarray, np.ndarray]]  # (words that the table may hold, how often each)


def text_features(texts: list[str | None], model: Model) -> np.ndarray:
    """One row of FEATURES per text; zeros for texts without letters or digits. Words outside the model count 0."""
    return text_evidence(texts, model)[0]


def text_evidence(texts: list[str | None], model: Model) -> tuple[np.ndarray, Words]:
    """(rows of FEATURES, what the words outside the model need to be added by ``with_rare_words``)."""
    dense, out = _dense(model), np.zeros((len(texts), len(FEATURES)))
    words = Words(np.zeros(len(texts)), np.zeros(len(texts), np.int64), [[] for _ in texts], [(NONE, NONE) for _ in texts])
    for group in slices(texts):
        sym = symbolise([texts[i] for i in group])
        n = len(group)
        r = np.zeros(len(sym.s))
        r[ORDER - 1:] = dense[gram_codes(sym.s)]
        r[~sym.scored] = 0.0
        starts, ends, h = word_hashes(sym.units)
        if not len(starts):
            continue
        total = np.concatenate(([0.0], np.cumsum(r)))
        char = total[np.minimum(ends + 1, len(r))] - total[starts]   # with the boundary behind the word
        doc = sym.doc[starts]
        word, known = np.zeros(len(h)), np.zeros(len(h), bool)
        if len(model.words):
            at = np.minimum(np.searchsorted(model.words, h), len(model.words) - 1)
            known = model.words[at] == h
            word = np.where(known, model.word_ratio[at], 0.0)
        n_words = np.bincount(doc, minlength=n).astype(np.float64)
        n_chars = np.bincount(sym.doc, weights=sym.scored, minlength=n)
        safe = np.maximum(n_words, 1)
        max_char, top_char = _top(char, doc, n)
        max_word, top_word = _top(word, doc, n)
        rows = np.stack([
            np.bincount(sym.doc, weights=r, minlength=n) / np.maximum(n_chars, 1), max_char,
            np.bincount(doc, weights=np.maximum(char - MARGIN, 0), minlength=n) / safe, top_char, np.log(safe), max_word,
            top_word, np.bincount(doc, weights=word, minlength=n) / safe], axis=1)
        rows[n_words == 0] = 0.0
        out[group] = rows
        words.n[group] = n_words
        if len(model.field):
            _ask(words, group, doc, h, word, known, model.field)
    return out, words


def _ask(words: Words, group: list[int], doc: np.ndarray, h: np.ndarray, word: np.ndarray, known: np.ndarray,
         field: np.ndarray) -> None:
    """Enter the largest known ratios and the distinct words to look up of a group of texts."""
    words.unknown[group] = np.bincount(doc[~known], minlength=len(group))
    d, v = doc[known], word[known]
    order = np.lexsort((-v, d))
    d, v = d[order], v[order]
    first = np.arange(len(d)) - np.searchsorted(d, d) < 3
    for i, value in zip(d[first].tolist(), v[first].tolist(), strict=True):
        words.top[group[i]].append(value)
    rest = np.nonzero(~known)[0]
    rest = rest[_may_hold(field, h[rest])]
    d, key = doc[rest], h[rest]
    order = np.lexsort((key, d))
    d, key = d[order], key[order]
    new = np.nonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (key[1:] != key[:-1]))))[0] if len(d) else order
    count = np.diff(np.append(new, len(d)))
    edge = np.searchsorted(d[new], np.arange(len(group) + 1))
    for i, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
        words.asked[group[i]] = key[new[a:b]], count[a:b]


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """(logistic weights on the features, constant last; longest text seen, as log words).

    More evidence never lowers a score: evidence weights are held at 0 or
    above, the weight of the text's length at 0 or below (longer texts have
    larger extremes by chance). Without both classes it is a fixed cut.
    """
    w = np.zeros(x.shape[1] + 1)
    if not len(y) or y.min() == y.max():
        w[FEATURES.index("max_char")], w[-1] = 1.0, -MARGIN - 2.0
        return w, 0.0
    longest = float(x[:, LENGTH].max())
    scale = np.maximum(x.std(axis=0), 1e-9)
    a = np.concatenate([x / scale, np.ones((len(x), 1))], axis=1)
    sign = np.ones(len(w))
    sign[LENGTH] = -1.0
    sign[-1] = 0.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        free = (sign == 0) | (w * sign > 0) | (grad * sign < 0)
        part = a[:, free]
        hess = (part * (p * (1 - p) + 1e-6)[:, None]).T @ part + (ridge + 1e-6) * np.eye(int(free.sum()))
        step = np.zeros(len(w))
        step[free] = np.linalg.solve(hess, grad[free])
        new = w - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        new = np.where((sign != 0) & (new * sign < 0), 0.0, new)
        done = np.abs(new - w).max() < 1e-7
        w = new
        if done:
            break
    w[:-1] /= scale
    return w, longest


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str) -> DataFrame:
    """(doc_id, text, fold, label): each document with its label (null: none, or of the held-out fold).

    Repeated labels of an id are one label, toxic if any says so. A label
    table of a checked size is broadcast, a larger one joined by shuffle.
    """
    marks = labels.where(col(label_col).isNotNull() & col(label_id).isNotNull()).groupBy(
        col(label_id).alias("label_id")).agg(F.max(col(label_col).cast("int")).alias("label"))
    marks = scratch_table(marks, "toxicity-labels")
    if marks.count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    joined = src.join(marks, src["doc_id"] == marks["label_id"], "left")
    f = F.coalesce(fold(F.col("doc_id")), F.lit(HELD_OUT))
    return joined.select("doc_id", "text", f.cast("int").alias("fold"),
                         F.when(f != HELD_OUT, F.col("label")).alias("label"))


class Fitted(NamedTuple):
    """Labelled documents, the model counted on them with the ratios of the words it does not hold, and the curve."""
    known: DataFrame
    model: Model
    rare: DataFrame
    weights: np.ndarray
    longest: float


def fit_documents(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str,
                  calibration_rows: int) -> Fitted:
    """The curve is fitted on rows whose labels a first model has not counted; the model used counts them too."""
    known = labelled(docs, labels, id_col, text_col, label_id, label_col)
    held = F.col("fold") == CALIBRATION
    counts = scratch_table(gram_and_word_counts(known.select(
        "text", F.coalesce("label", F.lit(-1)).cast("int").alias("y"), held.alias("held"))), "toxicity-counts")
    judged = known.where(held & F.col("label").isNotNull())
    rows = judged.count()
    if rows > calibration_rows:
        share = 1.2 * calibration_rows / rows + 1e-3
        judged = judged.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    curve = calibrate(features_of(judged, *train(counts, hold_back=True)), calibration_rows)
    return Fitted(known, *train(counts), *curve)


def features_of(known: DataFrame, model: Model, rare: DataFrame) -> DataFrame:
    """(doc_id, fold, label, digest, FEATURES) per document."""
    shared = known.sparkSession.sparkContext.broadcast(model)
    kind = known.schema["doc_id"].dataType.simpleString()
    own = ["row", "doc_id", "fold", "label", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(text_slices, batches)):
            x, words = text_evidence(batch.column("text").to_pylist(), shared.value)
            edge = pa.array(np.cumsum([0, *[len(k) for k, _ in words.asked]]), pa.int32())
            asked, times = (np.concatenate([NONE, *[w[i] for w in words.asked]]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in own] + [pa.array(x[:, i]) for i in range(x.shape[1])]
                + [pa.array(words.n), pa.array(words.unknown), pa.array(words.top, pa.list_(pa.float64())),
                   pa.ListArray.from_arrays(edge, pa.array(asked, pa.int64())),
                   pa.ListArray.from_arrays(edge, pa.array(times, pa.int32()))],
                names=[*own, *FEATURES, "n_words", "unknown", "top", "asked", "times"])

    src = known.withColumn("row", F.monotonically_increasing_id()).withColumn("digest", digest(F.col("text")))
    found = scratch_table(src.mapInArrow(tidy(run, _forget), f"row bigint, doc_id {kind}, fold int, label int, digest binary, "
                                         + ", ".join(f"{f} double" for f in FEATURES)
                                         + ", n_words double, unknown bigint, top array<double>, asked array<bigint>, times array<int>"),
                          "toxicity-evidence")
    shared.destroy()   # the evidence is written; executors need not hold the model beside later stages
    if len(model.field):
        found = with_rare_words(found, rare)
    return found.select("doc_id", "fold", "label", "digest", *FEATURES)


def digest(text: Column) -> Column:
    """Names a text; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def with_rare_words(found: DataFrame, rare: DataFrame) -> DataFrame:
    """Word features over all words: the asked words meet the (key, ratio) table by a join on the word.

    A document's state is bounded by its own words. A word in very many
    documents is a skewed join side that AQE can split.
    """
    asked = (found.where(F.size("asked") > 0).select("row", F.explode(F.arrays_zip("asked", "times")).alias("a"))
             .select("row", F.col("a.asked").alias("key"), F.col("a.times").alias("times")))
    # dealt by row before they are gathered: single values are smaller than partial lists
    met = asked.join(rare, "key").select("row", "times", "ratio").repartition("row").groupBy("row").agg(
        F.sum(F.col("times") * F.col("ratio").cast("double")).alias("rare_sum"), F.sum("times").alias("met"),
        F.flatten(F.collect_list(F.array_repeat(F.col("ratio").cast("double"), F.least("times", F.lit(3))))).alias("ratios"))
    rest = found.drop("asked", "times").join(met, "row", "left")
    none = F.array().cast("array<double>")
    zeros = F.array_repeat(F.lit(0.0), F.least(F.lit(3), F.col("unknown") - F.coalesce("met", F.lit(0))).cast("int"))
    top = F.slice(F.sort_array(F.concat("top", F.coalesce("ratios", none), zeros), asc=False), 1, 3)
    return rest.withColumn("top", top).withColumns({
        "max_word": F.coalesce(F.get("top", F.lit(0)), F.lit(0.0)),
        "top_word": F.aggregate("top", F.lit(0.0), lambda a, v: a + v),
        "mean_word": F.col("mean_word") + F.coalesce("rare_sum", F.lit(0.0)) / F.greatest("n_words", F.lit(1.0))})


def calibrate(features: DataFrame, calibration_rows: int) -> tuple[np.ndarray, float]:
    """The curve from at most ``calibration_rows`` rows, chosen by a hash."""
    sample = (features.orderBy(F.xxhash64("doc_id"), *FEATURES).limit(calibration_rows).toPandas())
    return fit_curve(sample[list(FEATURES)].to_numpy(np.float64), sample["label"].to_numpy(np.float64))


def _logit(w: np.ndarray, longest: float) -> Column:
    values = [F.least(F.col(f), F.lit(longest)) if i == LENGTH else F.col(f) for i, f in enumerate(FEATURES)]
    return sum((f * float(v) for f, v in zip(values, w, strict=False)), F.lit(float(w[-1])))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_id: str = "doc_id", label_col: str = "toxic", calibration_rows: int = 100_000) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, mean_log_ratio.

    Labels are read only for rows whose id is outside the held-out fold. Null
    and empty texts score what a text without evidence scores. A null id is
    never labelled and counts as held out. Without any labels the ratios are
    0 and the curve is fixed. Repeated rows come back repeated, other columns
    are not read.
    """
    known, model, rare, w, longest = fit_documents(docs, labels, id_col, text_col, label_id, label_col, calibration_rows)
    features = features_of(known, model, rare)
    score = 1 / (1 + F.exp(-F.greatest(F.least(_logit(w, longest), F.lit(30.0)), F.lit(-30.0))))
    return features.select("doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), score.alias("score"),
                           F.col("mean_char").alias("mean_log_ratio")).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "mean_log_ratio")


def keep_ordinary(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  calibration_rows: int = 100_000) -> DataFrame:
    """``docs`` without the documents predicted toxic; all columns and their order stay.

    Equal texts score the same, so documents go by the digest of their text: a
    checked number of digests is broadcast, more are joined by shuffle.
    """
    known, model, rare, w, longest = fit_documents(docs, labels, id_col, text_col, "doc_id", "toxic", calibration_rows)
    toxic = scratch_table(features_of(known, model, rare).where(_logit(w, longest) >= 0).select("digest").distinct(), "toxicity-found")
    if toxic.count() <= BROADCAST_LABELS:
        toxic = F.broadcast(toxic)
    return docs.join(toxic, digest(col(text_col)) == toxic["digest"], "left_anti")
