"""License scan: base columns against a plain word search, suppression against all pairs of detections."""

import itertools
import re

import pytest

from opslens.llm import licenses as L

TEXTS = [None, "", "   ", "CC BY", "cc-by cc by, Cc\nBY 4.0", "All rights reserved. all RIGHTS reserved",
         "general public license general  PUBLIC licence", "écc by", "cc byé", "É cc by Ü", "Kcc by",
         "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
         "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
         "SPDX-License-Identifier: BSD-3-Clause", "permission is hereby granted, free of charge, to any person",
         "gehe mit der License", "in the public domain", "a" * 60_000 + " all rights reserved " * 400,
         "the mozilla public license version 2.0 and the mozilla public license", "copyright 2020 x all rights reserved"]


def words(text):
    return re.findall(L.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(text):
    w, places, labels = words(text), [], set()
    for phrase, label in L.BASE:
        p = phrase.split()
        hits = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def plain_labels(text):
    """All rules on all texts, then containment over all pairs."""
    spaced = "".join(f" {w} " for w in words(text))
    found = []
    for at, rule in enumerate(L.rules()):
        for m in re.finditer(L.pattern(rule.signature), spaced):
            found.append((len(spaced[:m.start()].split()), len(spaced[:m.end()].split()), rule.level, at, rule.label))
    kept = [d for d in found if not any(
        e is not d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and ((e[0], -e[1], e[2], e[3]) < (d[0], -d[1], d[2], d[3]))
        for e in found)]
    base = set(plain_base(text)[4].split(",")) - {""}
    best = max([L.CONFIDENCE[d[2]] for d in kept] + [L.BASE_CONFIDENCE if base else 0.0])
    return ",".join(sorted({d[4] for d in kept} | base)), best


def test_base_labels_and_scores(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[3]), (3, TEXTS[3])]
    got = L.scan_licenses(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[3 if r.doc_id is None else r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(text)
        if len(text or "") < 50_000:
            assert (r.labels, r.score) == plain_labels(text), text
    assert L.scan_licenses(docs_of([])).count() == 0


def test_known_notices(docs_of):
    got = {r.doc_id: r.labels for r in L.scan_licenses(docs_of(list(enumerate(TEXTS)))).collect()}
    assert got[11] == "apache-2.0" and got[12] == "mit" and got[13] == "gpl,gpl-3.0"
    assert got[14] == "cc-by,cc-by-nc-4.0" and got[15] == "bsd-3-clause" and got[17] == ""


def test_every_rule_passes_the_gates():
    """A text that a rule matches must pass the stems and hold the rule's keywords."""
    stems = re.compile(L.STEMS)
    for rule in L.rules():
        sample = rule.signature.replace("[sc]", "s")
        sample = re.sub(r"\((@\|?)+\)", "licensed under", sample)
        sample = " ".join(re.sub(r"\(([^|)]*)[^)]*\)", r"\1", t).rstrip("?") for t in sample.split() if not t.startswith("{"))
        sample = sample.replace("[0-9]", "1").replace("[123]", "1").replace("?", "")
        assert stems.search(sample), sample
    assert len(L.rules()) > 200


def test_rules_are_regexes_of_both_engines(spark):
    patterns = [(L.pattern(r.signature),) for r in L.rules()]
    assert spark.createDataFrame(patterns, "p string").selectExpr("regexp_count(' a ', p) as n").agg({"n": "sum"}).first()[0] == 0


@pytest.mark.parametrize("n", [1, 3])
def test_no_python_in_the_plan(docs_of, n):
    plan = L.scan_licenses(docs_of([(i, "mit license") for i in range(n)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def forms(signature):
    """The shortest texts of a signature, one for each of its alternatives."""
    parts = []
    for token in signature.split():
        if token.startswith("{") or token.endswith("?"):
            continue
        if token.startswith("(@"):
            parts.append([f for n in L.NOTICES for f in forms(n)])
            continue
        m = re.fullmatch(r"\(([^)]*)\)(.*)", token)
        words = [w + m[2] for w in m[1].split("|")] if m else [token]
        words = [w.replace("[0-9]", "1").replace("[123]", "1") for w in words]
        words = [w.replace("[sc]", c) for w in words for c in ("s", "c")]
        parts.append(sorted({f for w in words for f in (w.replace("?", ""), re.sub(r".\?", "", w))}))
    return [" ".join(p) for p in itertools.product(*parts)]


def test_every_alternative_of_every_rule_passes_both_gates():
    stems, n = re.compile(L.STEMS), 0
    for rule in L.rules():
        for text in forms(rule.signature):
            spaced = "".join(f" {w} " for w in text.split())
            assert re.search(L.pattern(rule.signature), spaced), (rule, text)
            assert stems.search(text), (rule, text)
            assert all(set(k.split("|")) & set(text.split()) for k in rule.keywords), (rule, text)
            n += 1
        assert rule.keywords
    assert n > 1000


def test_signatures_fire_on_their_own_words(docs_of):
    texts = ["Licensed under the GPLv3.", "GPLv2", "LGPLv3", "see AGPLv3", "FreeBSD License", "Expat License",
             "Internet Systems Consortium License", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0",
             "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0",
             "Permission to use, copy, modify, and/or distribute this software for any purpose",
             "In no event will the authors be held liable"]
    got = {r.doc_id: (r.labels, r.score) for r in L.scan_licenses(docs_of(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_labels(t) for t in texts]
    assert got[0] == ("gpl-3.0", 1.0) and got[4][0] == "bsd-2-clause" and got[9] == ("isc", 1.0)
