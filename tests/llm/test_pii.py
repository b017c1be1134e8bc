"""PII: base spans against plain regexes, EM and classifier on simulated votes, redaction."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from opslens.llm import pii as P

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for k, rx in PLAIN.items():
        for m in re.finditer(rx, text):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 12 <= len(d) <= 19 and P.luhn(d), "phone": 9 <= len(d) <= 15}[k]:
                out.append((m.start(), P.BASE_KINDS.index(k), m.end()))
    return sorted(out)


def got(text):
    return [(s.start, s.kind, s.end) for s in P.find_spans(text) if s.kind < len(P.BASE_KINDS)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+-() 4É9_%", max_size=60))
def test_base_spans_equal_plain_regexes(text):
    assert got(text) == plain(text)


def test_written_cases():
    for text in ("a@b.c+d@e.f", "a@@b.c", "@b.c", "1.2.3.4.5.6.7.8", "999.1.1.1", "001.02.3.4", "4111 1111-1111 1111 x",
                 "+1 (487) 555-7209", "+1 2", "é+4915112345678", "x" * 50_000, "1" * 50_000, "1." * 20_000, "a." * 20_000 + "@b.co"):
        assert got(text) == plain(text)
    assert P.find_spans(None) == P.find_spans("") == []


def test_em_finds_the_good_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.4
    right = (0.95, 0.9, 0.85, 0.8, 0.55, 0.5)
    votes = np.stack([np.where(rng.random(len(truth)) < r, truth, ~truth) * 2 for r in right], axis=1)
    code = votes @ (3 ** np.arange(5, -1, -1)) * 45
    pattern, at, count = np.unique(code, return_inverse=True, return_counts=True)
    kind = np.full(len(pattern), 4)
    reliability, prior, post = P.expectation_maximisation(kind, pattern, count.astype(float))
    assert ((post[at] > 0.5) == truth).mean() > 0.97
    assert abs(prior[4] - 0.4) < 0.02
    assert [round(reliability[i, 1, 2], 1) for i in (0, 3)] == [0.9, 0.8] or abs(reliability[0, 1, 2] - 0.95) < 0.02
    model = P.fit(kind, pattern, count.astype(float))
    agree = (P.features(kind, pattern) @ model.weights >= 0) == (post > 0.5)
    assert (agree * count).sum() / count.sum() > 0.99


def test_find_and_redact(docs_of):
    secret = 'token = "' + "0123456789abcdef" * 2 + '01234567"'
    texts = [None, "", f"mail bob@x.com {secret} ip 10.0.0.1", "card 4111 1111 1111 1111 call +1 (487) 555-7209",
             "z" * 100_000 + " a@b.co", "É é@b.co ü@x.de"] + [f"word {i} {secret}" for i in range(30)]
    rows = list(enumerate(texts)) + [(None, texts[2]), (2, texts[2])]
    found = P.find_pii(docs_of(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = texts[2 if r.doc_id is None else r.doc_id] or ""
        base = plain(text)
        joined = ",".join(f"{P.BASE_KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    assert any("secret:" in r.spans for r in found)
    clean = P.redact(docs_of(rows), n_chars_col="n_chars")
    assert clean.columns == docs_of(rows).columns
    by_id = {r.doc_id: r for r in clean.collect()}
    assert by_id[3].text == "card [CARD] call [PHONE]" and by_id[0].text is None and by_id[1].text == ""
    assert "bob@" not in by_id[2].text and by_id[3].n_chars == len(by_id[3].text)
    assert P.find_pii(docs_of([])).count() == 0 and P.redact(docs_of([])).count() == 0


def test_long_secrets_are_whole_spans():
    """A secret of any length is one span and goes as a whole."""
    rng = np.random.default_rng(7)
    yes = P.Model(np.zeros(0), np.zeros(0), np.ones(P.features(np.zeros(1, int), np.zeros(1, int)).shape[1]))
    kind = P.KIND_AT["secret"]
    for n in (8, 64, 65, 128, 129, 300, 10_000):
        named = "".join(rng.choice(list("abcdefghijkABCDEFGHIJK0123456789_-"), n))
        text = f"x token={named} y"
        assert [(s.start, s.end) for s in P.find_spans(text) if s.kind == kind] == [(8, 8 + n)], n
        assert P.redacted(text, yes) == "x token=[SECRET] y"
        for digits in ("0123456789abcdef", "0123456789ABCDEF"):
            run = "a" if digits[-1] == "f" else "A"
            run += "".join(rng.choice(list(digits), n - 1))
            text = f"x {run} y"
            if n >= 32:
                assert [(s.start, s.end) for s in P.find_spans(text) if s.kind == kind] == [(2, 2 + n)], n
                assert P.redacted(text, yes) == "x [SECRET] y"
    text = "token=4111111111111111 z"
    assert [P.KINDS[s.kind] for s in P.find_spans(text)] == ["card"]
    text = f"{'ab' * 50}4111111111111111{'cd' * 50}"
    assert sorted(P.KINDS[s.kind] for s in P.find_spans(text)) == ["card", "secret"]
    assert len(P.find_spans("f" * 200_000 + " " + "token=" + "Z9" * 100_000)) == 2


def test_long_handles_are_whole_spans():
    yes = P.Model(np.zeros(0), np.zeros(0), np.ones(P.features(np.zeros(1, int), np.zeros(1, int)).shape[1]))
    for n, labels in ((1, 2), (64, 2), (65, 5), (100, 6), (300, 12), (10_000, 40)):
        handle = "b" * n + " (at) " + " (dot) ".join(["site" * 20] * labels)
        text = f"mail {handle}, thanks"
        assert [(s.start, s.end) for s in P.find_spans(text) if P.KINDS[s.kind] == "handle"] == [(5, 5 + len(handle))]
        assert P.redacted(text, yes) == "mail [HANDLE], thanks"
    assert P.find_spans("a." * 100_000 + " (at) x") == [] and P.find_spans("x (at) " * 20_000) == []


def test_further_kinds_are_accepted_in_their_context_and_rejected_in_others(docs_of):
    def iban(i):
        body = f"3704004405320130{i:02d}"
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    texts = []
    for i in range(60):
        texts += [f"contact: bob{i}x (at) site{i} (dot) com", f"bank transfer to iban {iban(i)} now",
                  f"social security ssn {200 + i}-45-{1000 + i}", f"please call (487) 555-{1000 + i}"]
    decoys = []
    for i in range(60):
        decoys += [f"order {900 + i % 90}-00-{1000 + i} total price", f"isbn 487 555 {1000 + i}9 page"]
    rows = list(enumerate(texts + decoys))
    got = {r.doc_id: r.spans for r in P.find_pii(docs_of(rows)).collect()}
    for k, kind in enumerate(("handle", "iban", "ssn", "local_phone")):
        mine = [got[i] for i in range(k, len(texts), 4)]
        assert sum(f"{kind}:" in s for s in mine) >= 0.95 * len(mine), kind
    assert sum("ssn:" in got[i] or "local_phone:" in got[i] for i in range(len(texts), len(rows))) <= 0.05 * len(decoys)
