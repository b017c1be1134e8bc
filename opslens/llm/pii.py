"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans (email, ip, card, phone) come from fixed patterns and always stay.
The method adds spans of further kinds. Each span, base or candidate, gets
votes (-1, 0, 1) from six labelers: strict regex, validity check, gazetteer,
supporting context, opposing context, boundary. Votes and a coarse shape make
a *pattern*; the number of patterns is bounded (``PATTERNS`` per kind), so the
corpus reduces to pattern counts by one pre-aggregated groupBy over all rows.
From those counts expectation-maximisation estimates each labeler's
reliability for personal and other spans and a prior per kind, and a logistic
classifier is fitted to the posteriors, weighted by the counts.

Texts are read once, whole; only small span lists are kept and aggregated.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col, scratch_table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "handle", "iban", "local_phone", "secret", "ssn")
LABELERS = ("strict", "valid", "gazetteer", "support", "oppose", "boundary")
LENGTHS = (8, 16, 24, 40)                      # shape: length classes
PATTERNS = 3 ** len(LABELERS) * (len(LENGTHS) + 1) * 9
KIND_AT = {k: i for i, k in enumerate(KINDS)}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A whole digit run starts each address, so no run is tried twice.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# A whole run is one span, however long.
SECRET = re.compile(r"(?i:(?<![a-z0-9])(token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)"
                    r"\x20{0,2}[=:]\x20{0,2}[\"']?)([A-Za-z0-9_./+=-]{8,}+)")
HEX = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])")
HANDLE = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
                    r"(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3,4}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Gazetteers and cues.
TOP_DOMAINS = frozenset("com org net edu gov info biz io co de fr es it nl uk us ch at eu".split())
RESERVED_IP = ("0.", "10.", "127.", "169.254.", "192.168.", "224.", "255.")
ISSUERS = ("34", "37", "4", "50", "51", "52", "53", "54", "55", "6011", "62", "65", "2221", "35")
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "40", "41", "43", "44", "45", "46", "47", "48",
           "49", "52", "55", "61", "81", "82", "86", "90", "91")
IBAN_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
SUPPORT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "address", "login"), "card": ("card", "visa", "credit"),
    "phone": ("call", "tel", "phone", "fax", "mobile"), "account": ("account", "acct", "card", "konto", "customer"),
    "handle": ("mail", "contact", "write"), "iban": ("iban", "bank", "konto", "transfer"),
    "local_phone": ("call", "tel", "phone", "fax", "mobile"), "secret": ("token", "secret", "password", "key", "auth"),
    "ssn": ("ssn", "social", "security")}
OPPOSE = ("version", "isbn", "issn", "doi", "page", "vol", "figure", "price", "total", "order", "sha", "md5", "commit",
          "checksum", "uuid")
CONTEXT = 40
CUES = re.compile(r"[a-z0-9]+")


class Span(NamedTuple):
    kind: int
    start: int
    end: int
    pattern: int


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` so that long runs are read once."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        last = m.end() if m else at + 1
        at = text.find("@", last)


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(base spans, number runs of card length that fail the card check)."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    failed = []
    for m in CARD.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19:
            if luhn(digits):
                out.append(("card", *m.span()))
            else:
                failed.append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out, failed


def _iban_ok(value: str) -> bool:
    v = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def _votes(kind: str, text: str, start: int, end: int, named: bool) -> list[int]:
    """The six labelers' votes on one span, in the order of ``LABELERS``."""
    value = text[start:end]
    before = CUES.findall(text[max(0, start - CONTEXT):start].lower())
    strict = valid = gaz = 0
    if kind in ("email", "handle"):
        top = re.split(r"[^a-z0-9]+", value.lower().replace("dot", "."))
        top = [t for t in top if t][-1:] or [""]
        strict = 1 if len(value) <= 254 and ".." not in value else -1
        gaz = 1 if top[0] in TOP_DOMAINS else 0
        valid = 1 if 2 <= len(top[0]) <= 24 and top[0].isalpha() else -1
    elif kind == "ip":
        strict = 1 if all(p == str(int(p)) for p in value.split(".") if len(p) < 9) else -1
        valid, gaz = 1, -1 if value.startswith(RESERVED_IP) else 0
    elif kind in ("card", "account"):
        digits = re.sub(r"[^0-9]", "", value)
        strict = 1 if len(digits) in (15, 16) else -1 if len(set(digits)) < 4 else 0
        valid = 1 if luhn(digits) else -1
        gaz = 1 if digits.startswith(ISSUERS) else -1
    elif kind in ("phone", "local_phone"):
        digits = re.sub(r"[^0-9]", "", value)
        strict = 1 if re.fullmatch(r"\+?[0-9]{0,3}\s?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-]?[0-9]{4}", value) else 0
        valid = 1 if len(set(digits)) >= 4 else -1
        gaz = 1 if kind == "phone" and digits.startswith(CALLING) else 0
    elif kind == "iban":
        strict, valid = 1, 1 if _iban_ok(value) else -1
        gaz = 1 if value[:2] in IBAN_COUNTRIES else -1
    elif kind == "secret":
        strict = 1 if re.fullmatch(r"(?:[0-9a-f]{20,}|[0-9A-F]{20,}|[A-Za-z0-9_./+=-]{20,})", value) else -1
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        valid = 1 if mixed and _entropy(value) >= 3.0 else -1
        gaz = 1 if named else 0
    elif kind == "ssn":
        strict = 1
        valid = -1 if value.startswith(("000", "666", "9")) or "-00-" in value or value.endswith("0000") else 1
    support = 1 if any(w.endswith(SUPPORT[kind]) for w in before) else 0
    oppose = -1 if any(w in OPPOSE for w in before) else 0
    around = text[max(0, start - 1):start], text[end:end + 1]
    boundary = -1 if any(c.isalnum() or c == "_" for c in around if c) else 1
    return [strict, valid, gaz, support, oppose, boundary]


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalnum() else 2


def _pattern(votes: list[int], text: str, start: int, end: int) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v + 1
    length = sum(end - start > n for n in LENGTHS)
    return (code * (len(LENGTHS) + 1) + length) * 9 + 3 * _side(text[start - 1:start] if start else "") + _side(text[end:end + 1])


def find_spans(text: str | None) -> list[Span]:
    """Base spans and candidates of one text (null: none), by start, then kind as listed.

    A candidate that overlaps a base span or an earlier kept candidate is not one,
    but a secret may hold base spans (a long run holds card numbers by chance).
    """
    if not text:
        return []
    base, failed = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    more: list[tuple[str, int, int, bool]] = []
    if "=" in text or ":" in text:
        more += [("secret", *m.span(2), True) for m in SECRET.finditer(text)]
    more += [("secret", *m.span(), False) for m in HEX.finditer(text)]
    if "at" in text and ("[" in text or "(" in text):
        more += [("handle", *m.span(), False) for m in HANDLE.finditer(text)]
    more += [("iban", *m.span(), False) for m in IBAN.finditer(text)]
    more += [("ssn", *m.span(), False) for m in SSN.finditer(text)]
    more += [("local_phone", *m.span(), False) for m in LOCAL_PHONE.finditer(text)]
    more += [("account", s, e, False) for s, e in failed]
    out = [(k, s, e, False) for k, s, e in base]
    if more:
        out += _free(more, taken)
    spans = [Span(KIND_AT[k], s, e, _pattern(_votes(k, text, s, e, n), text, s, e)) for k, s, e, n in out]
    return sorted(spans, key=lambda x: (x.start, x.kind, x.end))


def _free(more: list[tuple[str, int, int, bool]], taken: list[tuple[int, int]]) -> list[tuple[str, int, int, bool]]:
    """Candidates free of ``taken`` and of candidates that start earlier (longer first): one merged sweep."""
    items = [(s, -e, 0, None) for s, e in taken] + [(c[1], -c[2], 1, c) for c in more]
    kept, reach = [], -1
    starts = np.array([s for s, _ in taken] or [np.iinfo(np.int64).max])
    for s, neg, is_more, cand in sorted(items, key=lambda x: x[:3]):
        e = -neg
        if is_more:
            nxt = np.searchsorted(starts, s)
            inside = taken[nxt:np.searchsorted(starts, e)]
            if s < reach or inside and not (cand[0] == "secret" and (s, e) not in inside and max(b for _, b in inside) <= e):
                continue
            kept.append(cand)
        reach = max(reach, e)
    return kept


def decode(pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(votes shifted to 0..2, shape) of pattern codes."""
    shapes = (len(LENGTHS) + 1) * 9
    code, shape = pattern // shapes, pattern % shapes
    votes = np.stack([code // 3 ** (len(LABELERS) - 1 - i) % 3 for i in range(len(LABELERS))], axis=1)
    return votes, shape


class Model(NamedTuple):
    """``reliability[labeler, class, vote]``, ``prior[kind]`` and the classifier's weights."""
    reliability: np.ndarray
    prior: np.ndarray
    weights: np.ndarray


def features(kind: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """One-hot kind, votes, length and neighbours, and a constant."""
    votes, shape = decode(pattern)
    parts = [np.ones((len(kind), 1)), np.eye(len(KINDS))[kind]]
    parts += [np.eye(3)[votes[:, i]] for i in range(len(LABELERS))]
    parts += [np.eye(len(LENGTHS) + 1)[shape // 9], np.eye(3)[shape % 9 // 3], np.eye(3)[shape % 3]]
    return np.concatenate(parts, axis=1)


def expectation_maximisation(kind: np.ndarray, pattern: np.ndarray, count: np.ndarray,
                             rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(reliability, prior, posterior): two latent classes, labelers independent given the class."""
    votes, _ = decode(pattern)
    n, width = votes.shape
    post = 1 / (1 + np.exp(-1.5 * (votes - 1).sum(axis=1)))  # start: the vote count
    reliability, prior = np.zeros((width, 2, 3)), np.full(len(KINDS), 0.5)
    for _ in range(rounds):
        for y, p in enumerate((1 - post, post)):
            for i in range(width):
                seen = np.bincount(votes[:, i], weights=p * count, minlength=3) + (1.0, 0.5, 1.0)
                reliability[i, y] = seen / seen.sum()
        pos, all_ = (np.bincount(kind, weights=w, minlength=len(KINDS)) for w in (post * count, count))
        prior = (pos + 1.0) / (all_ + 2.0)
        log = np.stack([np.log(1 - prior)[kind], np.log(prior)[kind]], axis=1)
        for i in range(width):
            log += np.log(reliability[i][:, votes[:, i]]).T
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -60, 60)))
        if np.abs(new - post).max(initial=0.0) < 1e-9:
            break
        post = new
    return reliability, prior, post


def fit(kind: np.ndarray, pattern: np.ndarray, count: np.ndarray, ridge: float = 1.0) -> Model:
    """EM over the pattern counts, then weighted logistic regression on its posteriors (Newton steps)."""
    if not len(kind):
        return Model(np.full((len(LABELERS), 2, 3), 1 / 3), np.full(len(KINDS), 0.5), np.zeros(features(
            np.zeros(1, int), np.zeros(1, int)).shape[1]))
    reliability, prior, post = expectation_maximisation(kind, pattern, count)
    x, w = features(kind, pattern), np.zeros(features(kind[:1], pattern[:1]).shape[1])
    scale = count / count.sum() * min(count.sum(), 1e6)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (scale * (p - post)) + ridge * w
        hess = (x * (scale * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(reliability, prior, w)


def accepted(spans: list[Span], model: Model) -> list[Span]:
    """Base spans and the candidates the classifier takes for personal data."""
    more = [s for s in spans if s.kind >= len(BASE_KINDS)]
    if not more:
        return spans
    x = features(np.array([s.kind for s in more]), np.array([s.pattern for s in more]))
    good = {s for s, ok in zip(more, x @ model.weights >= 0, strict=True) if ok}
    return [s for s in spans if s.kind < len(BASE_KINDS) or s in good]


SPANS = "array<struct<kind:int,start:int,end:int,pattern:int>>"


def spans_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, spans): base spans and candidates of each row's whole text."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "spans": [
                [tuple(s) for s in find_spans(t)] for t in pdf["text"]]})

    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    return src.mapInPandas(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def train(spans: DataFrame) -> Model:
    """The model from all spans of the corpus; at most kinds * ``PATTERNS`` counts reach the driver."""
    counts = (spans.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.pattern")
              .agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "pattern").toPandas())
    return fit(counts["kind"].to_numpy(np.int64), counts["pattern"].to_numpy(np.int64), counts["n"].to_numpy(np.float64))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Positions are code points, ends exclusive. Null and empty texts have no
    spans. Repeated rows come back repeated, null ids are kept, an empty table
    gives no rows, other columns are not read.
    """
    found = scratch_table(spans_of(docs, id_col, text_col), "pii-spans")
    model = train(found)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for raw in pdf["spans"]:
                spans = accepted([Span(s["kind"], s["start"], s["end"], s["pattern"]) for s in raw], model)
                base = [s for s in spans if s.kind < len(BASE_KINDS)]
                per = [sum(s.kind == k for s in base) for k in range(len(BASE_KINDS))]
                rows.append((*per, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans),
                             len(spans) - len(base)))
            names = [*(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_added"]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    counts = ", ".join(f"n_{k} bigint" for k in BASE_KINDS)
    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInPandas(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added bigint")


def redact(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = None) -> DataFrame:
    """``docs`` with every accepted span replaced by its kind in brackets; null texts stay null.

    The model is trained on these documents. All columns are kept, their order too.
    """
    found = scratch_table(spans_of(docs.select(F.lit(0).alias("doc_id"), col(text_col).alias("text")), "doc_id", "text"),
                          "pii-spans")
    model = train(found)

    @F.pandas_udf("string")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([redacted(t, model) for t in batch], dtype=object)

    out = docs.withColumn(text_col, clean(col(text_col)))
    return out if n_chars_col is None else out.withColumn(
        n_chars_col, F.when(col(text_col).isNull(), col(n_chars_col)).otherwise(
            F.char_length(col(text_col)).cast(docs.schema[n_chars_col].dataType)))


def redacted(text: str | None, model: Model) -> str | None:
    """One text without its personal data; of overlapping spans the first start (longest) covers the rest."""
    if not text:
        return text
    out, at = [], 0
    for s in sorted(accepted(find_spans(text), model), key=lambda s: (s.start, -s.end)):
        if s.end <= at:
            continue
        if s.start >= at:
            out.append(text[at:s.start] + f"[{KINDS[s.kind].upper()}]")
        at = s.end
    return "".join(out) + text[at:]
