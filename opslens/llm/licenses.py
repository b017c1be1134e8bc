"""License scan: ordered signature rules behind a keyword prefilter, in DataFrame functions only.

A text is a sequence of words (A-Z lower-cased). A signature is written as
word patterns and compiled to one regex over the words, each of which stands
between two blanks, so neighbouring matches never share a character and no
look-around is needed:

    word      one word (a regex without blanks)
    word?     an optional word
    {n}       up to n words of any kind

Three gates keep the regexes away from almost all text: a cheap regex for the
few word beginnings every rule needs, the set of keywords found in the text, and per
rule the keywords it demands, which are read off its signature: words that every match holds. What is found becomes word intervals. A
detection is dropped when an interval of the same or a higher priority (a
lower level) contains it; among equal intervals the earlier rule wins. One
sweep over the sorted detections decides this.

Everything is a projection: no shuffle, no Python, a row's state is bounded by
its own text.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"          # after lower-casing A-Z
# Before it, the same words: everything but the ASCII characters that are no letter or digit. Listed one by one,
# which Java matches by a bit set, several times faster than ranges.
SEPARATORS = "".join(f"\\x{i:02X}" for i in range(128) if not chr(i).isalnum())
RAW_WORD = f"[^{SEPARATORS}]+"

# The base phrases of the contract and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Levels of priority: identifiers and notices, named mentions, weak hints; and how sure each makes us.
NOTICE, MENTION, HINT = 0, 1, 2
CONFIDENCE = (1.0, 0.75, 0.5)
BASE_CONFIDENCE = 0.625


class Rule(NamedTuple):
    label: str
    level: int
    keywords: tuple[str, ...]   # all must occur; alternatives are joined by |
    signature: str


# label, signatures of the name, identifiers as words
LICENSES = (
    ("apache-2.0", ("apache software? licen[sc]e version? v?2 0?", "apache 2 0 licen[sc]e"), "apache 2 0"),
    ("apache-1.1", ("apache software? licen[sc]e version? 1 1",), "apache 1 1"),
    ("apache", ("apache software? licen[sc]e", "apache licen[sc]ed"), ""),
    ("mit", ("mit licen[sc]e", "mit x11? licen[sc]e", "mit style licen[sc]e", "expat mit? licen[sc]e"), "mit"),
    ("bsd-2-clause", ("bsd 2 clause licen[sc]e?", "(two|simplified) clause? bsd licen[sc]e",
                             "simplified bsd licen[sc]e", "freebsd licen[sc]e"), "bsd 2 clause"),
    ("bsd-3-clause", ("bsd 3 clause licen[sc]e?", "three clause bsd licen[sc]e",
                             "(new|modified|revised) bsd licen[sc]e"), "bsd 3 clause"),
    ("bsd-4-clause", ("bsd 4 clause licen[sc]e?", "(original|old) bsd licen[sc]e"), "bsd 4 clause"),
    ("0bsd", ("zero clause bsd licen[sc]e?", "0bsd licen[sc]e?"), "0bsd"),
    ("bsd", ("bsd licen[sc]e", "bsd style licen[sc]e"), ""),
    ("gpl-3.0", ("gnu? general public licen[sc]e version? v?3 0?", "gnu? gpl version? v?3 0?", "gplv3"),
     "gpl 3 0 (only|or)? later?"),
    ("gpl-2.0", ("gnu? general public licen[sc]e version? v?2 0?", "gnu? gpl version? v?2 0?", "gplv2"),
     "gpl 2 0 (only|or)? later?"),
    ("gpl", ("gnu general public licen[sc]e", "gnu gpl", "gpl licen[sc]ed?"), ""),
    ("lgpl-3.0", ("gnu? lesser general public licen[sc]e version? v?3 0?", "lgpl version? v?3 0?", "lgplv3"),
     "lgpl 3 0 (only|or)? later?"),
    ("lgpl-2.1", ("gnu? lesser general public licen[sc]e version? v?2 1", "lgpl version? v?2 1"),
     "lgpl 2 1 (only|or)? later?"),
    ("lgpl-2.0", ("gnu? library general public licen[sc]e version? v?2 0?", "lgpl version? v?2 0"), "lgpl 2 0"),
    ("lgpl", ("gnu? lesser general public licen[sc]e", "gnu lgpl"), ""),
    ("agpl-3.0", ("gnu? affero general public licen[sc]e version? v?3? 0?", "gnu? agpl version? v?3 0?", "agplv3"),
     "agpl 3 0 (only|or)? later?"),
    ("gfdl", ("gnu? free documentation licen[sc]e version? 1? [0-9]?",), "gfdl 1 [123]"),
    ("mpl-2.0", ("mozilla public licen[sc]e version? v?2 0?", "mpl v?2 0?"), "mpl 2 0"),
    ("mpl-1.1", ("mozilla public licen[sc]e version? v?1 1", "mpl 1 1"), "mpl 1 1"),
    ("mpl", ("mozilla public licen[sc]e",), ""),
    ("epl-2.0", ("eclipse public licen[sc]e version? v?2 0?",), "epl 2 0"),
    ("epl-1.0", ("eclipse public licen[sc]e version? v?1 0?",), "epl 1 0"),
    ("cddl-1.0", ("common development and distribution licen[sc]e version? 1? 0?",), "cddl 1 0"),
    ("cpl-1.0", ("common public licen[sc]e version? 1? 0?",), "cpl 1 0"),
    ("eupl-1.2", ("european union public licen[sc]e version? v?1? 2?",), "eupl 1 2"),
    ("artistic-2.0", ("artistic licen[sc]e version? 2 0?",), "artistic 2 0"),
    ("artistic-1.0", ("artistic licen[sc]e version? 1 0?",), "artistic 1 0"),
    ("isc", ("isc licen[sc]e", "internet systems consortium licen[sc]e"), "isc"),
    ("zlib", ("zlib licen[sc]e", "zlib libpng licen[sc]e"), "zlib"),
    ("libpng", ("libpng licen[sc]e version? 2?",), "libpng 2? 0?"),
    ("bsl-1.0", ("boost software licen[sc]e version? 1? 0?",), "bsl 1 0"),
    ("busl-1.1", ("business source licen[sc]e version? 1? 1?",), "busl 1 1"),
    ("sspl-1.0", ("server side public licen[sc]e version? v?1?",), "sspl 1 0"),
    ("elastic-2.0", ("elastic licen[sc]e version? v?2? 0?",), "elastic 2 0"),
    ("unlicense", ("the unlicense", "unlicense org"), "unlicense"),
    ("wtfpl", ("wtfpl version? 2?",), "wtfpl"),
    ("psf-2.0", ("python software foundation licen[sc]e version? 2?", "psf licen[sc]e version? 2?"), "psf 2 0"),
    ("ruby", ("ruby licen[sc]e", "same licen[sc]e as ruby"), "ruby"),
    ("perl", ("same terms as perl itself?", "perl licen[sc]e"), ""),
    ("php-3.01", ("php licen[sc]e version? 3? 0?1?",), "php 3 01"),
    ("openssl", ("openssl licen[sc]e",), "openssl"),
    ("postgresql", ("postgresql licen[sc]e",), "postgresql"),
    ("curl", ("curl licen[sc]e",), "curl"),
    ("ncsa", ("ncsa open? source? licen[sc]e", "university of illinois ncsa open source licen[sc]e"), "ncsa"),
    ("ofl-1.1", ("sil? open font licen[sc]e version? 1? 1?",), "ofl 1 1"),
    ("vim", ("vim licen[sc]e",), "vim"),
    ("w3c", ("w3c software? notice? and? licen[sc]e",), "w3c"),
    ("ms-pl", ("microsoft public licen[sc]e",), "ms pl"),
    ("ms-rl", ("microsoft reciprocal licen[sc]e",), "ms rl"),
    ("odbl-1.0", ("open database licen[sc]e version? v?1? 0?",), "odbl 1 0"),
    ("odc-by-1.0", ("open data commons attribution licen[sc]e version? v?1? 0?",), "odc by 1 0"),
    ("pddl-1.0", ("public domain dedication and licen[sc]e version? v?1? 0?",), "pddl 1 0"),
    ("ogl-uk-3.0", ("open government licen[sc]e version? v?3? 0?",), "ogl uk 3 0"),
    ("cc0-1.0", ("cc0 1? 0? universal?", "creative commons zero version? v?1? 0?"), "cc0 1 0"),
    ("cc-by-nc-nd-4.0", ("cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international?"),
     "cc by nc nd 4 0"),
    ("cc-by-nc-sa-4.0", ("cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international?"),
     "cc by nc sa 4 0"),
    ("cc-by-nc-4.0", ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international?"),
     "cc by nc 4 0"),
    ("cc-by-nd-4.0", ("cc by nd 4 0", "creative commons attribution noderivatives 4 0 international?"),
     "cc by nd 4 0"),
    ("cc-by-sa-4.0", ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international?"),
     "cc by sa 4 0"),
    ("cc-by-sa-3.0", ("cc by sa 3 0", "creative commons attribution sharealike 3 0 unported?"),
     "cc by sa 3 0"),
    ("cc-by-4.0", ("cc by 4 0", "creative commons attribution 4 0 international? licen[sc]e?"), "cc by 4 0"),
    ("cc-by-3.0", ("cc by 3 0", "creative commons attribution 3 0 unported? licen[sc]e?"), "cc by 3 0"),
    ("cc", ("creative commons licen[sc]e", "creative commons attribution"), ""),
)
# Ways a notice names a license.
NOTICES = ("licen[sc]ed under {2} ", "released under {2} ", "distributed under {3} ", "under the terms of {2} ",
           "available under {2} ", "governed by {2} ", "subject to {2} ")
NOTICE_WORDS = ("under", "governed", "subject")   # of which every form has one
# Words that tell no license apart.
COMMON = frozenset("a and any as be by for held hereby in into is no of on open or the this to use user version will with "
                   "software source public 0 1 2 3 4 v1 v2 v3".split())
# Notices and hints without a license name.
OTHER = (
    ("mit", NOTICE, "permission is hereby granted free of charge to any person"),
    ("isc", NOTICE, "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", NOTICE, "redistribution and use in source and binary forms"),
    ("zlib", NOTICE, "in no event will the authors be held liable"),
    ("unlicense", NOTICE, "free and unencumbered software released into the public domain"),
    ("public-domain", MENTION, "(released|placed|dedicated) (in|into|to) the public domain"),
    ("public-domain", MENTION, "in the public domain"),
    ("public-domain", HINT, "public domain"),
    ("reserved", MENTION, "(all|some) rights? reserved"),
    ("reserved", MENTION, "alle rechte vorbehalten"),
    ("proprietary", MENTION, "proprietary and confidential"),
    ("proprietary", HINT, "without {2} prior written permission"),
    ("copyright", HINT, "copyright c? (19|20)[0-9][0-9]"),
    ("copyright", HINT, "copyright (holders?|owners?)"),
    ("licensed", HINT, "licen[sc]ed under"),
    ("licensed", HINT, "see licen[sc]e (file|txt|md)"),
    ("licensed", HINT, "end user licen[sc]e agreement"),
)


def rules() -> list[Rule]:
    """The ordered rules, built from the tables above: notices first, then names, then hints."""
    out = []
    for label, names, ident in LICENSES:
        if ident:
            out.append(rule(label, NOTICE, f"spdx licen[sc]e identifier {ident}"))
        for name in names:
            lead = "(" + "|".join("@" for _ in NOTICES) + ")"  # one alternative per notice form
            out.append(rule(label, NOTICE, f"{lead} {name}"))
        out += [rule(label, MENTION, name) for name in names]
    return out + [rule(label, level, sig) for label, level, sig in OTHER]


def rule(label: str, level: int, signature: str) -> Rule:
    return Rule(label, level, demanded(signature), signature)


def demanded(signature: str) -> tuple[str, ...]:
    """Keywords of a signature: for each word that every match holds, its spellings; common words only if it has no other."""
    out = []
    for token in signature.split():
        if token.startswith("(@"):
            out.append("|".join(NOTICE_WORDS))
        elif not token.startswith("{") and not token.endswith("?") and (words := spellings(token)):
            out.append("|".join(words))
    return tuple(k for k in out if COMMON.isdisjoint(k.split("|"))) or tuple(out)


def spellings(token: str) -> list[str]:
    """All words that a word pattern matches; none for a pattern with other signs than (a|b), [sc] and x?."""
    out = []
    for word in (token[1:-1] if token.startswith("(") and token.endswith(")") else token).split("|"):
        forms = [""]
        for char, optional in re.findall(r"(\[sc\]|[a-z0-9])(\??)", word):
            forms = [f + c for f in forms for c in (("s", "c") if char == "[sc]" else (char, "") if optional else (char,))]
        if re.fullmatch(r"(?:(?:\[sc\]|[a-z0-9])\??)+", word) is None:
            return []
        out += forms
    return sorted(out)


def _words(signature: str) -> str:
    out = ""
    for token in signature.split():
        if token.startswith("{"):
            out += f"(?: [^ ]+ ){{0,{token[1:-1]}}}"
        elif token.startswith("(@"):
            out += "(?:" + "|".join(_words(n) for n in NOTICES) + ")"
        elif token.endswith("?") and not token.endswith("\\?"):
            out += f"(?: (?:{token[:-1]}) )?" if not token.endswith(")?") else f"(?: {token[:-1]} )?"
        else:
            out += f" (?:{token}) "
    return out


def pattern(signature: str) -> str:
    """Regex of a signature over words that each stand between two blanks."""
    return _words(signature)


# Word beginnings of which every rule and base phrase needs at least one.
STEMS = (f"(?:^|[{SEPARATORS}])" r"(?i:unlicen|licen[sc]|public|rights|rechte|reserved|copyright|permission"
         r"|redistribution|warranty|unencumbered|proprietary|spdx|wtfpl|[al]?gpl|cc|creative|0?bsd|mpl|gnu|perl|liable)")


def keyword_list(found: list[Rule]) -> list[str]:
    return sorted({w for r in found for k in r.keywords for w in k.split("|")})


def _marked(text: Column, regex: Column) -> Column:
    """Words of the text with a start and an end mark around each match."""
    return F.split(F.trim(F.regexp_replace(text, regex, F.lit(" \x01 $1 \x02 "))), F.lit(" +"))


def _marks(tokens: Column, mark: str, skip: int) -> Column:
    """Word positions of the marks: the k-th stands behind 2k + skip other marks."""
    at = F.filter(F.transform(tokens, lambda w, i: F.when(w == mark, i)), lambda i: i.isNotNull())
    return F.transform(at, lambda i, k: i - 2 * k - skip)


def _spans(text: Column, rule: Column) -> Column:
    """Detections of one rule: start, minus end, level, order, label; ready to be sorted."""
    tokens = _marked(text, rule["regex"])
    pairs = F.arrays_zip(_marks(tokens, "\x01", 0).alias("s"), _marks(tokens, "\x02", 1).alias("e"))
    return F.transform(pairs, lambda p: F.struct(
        p["s"].alias("s"), (-p["e"]).alias("e"), rule["level"].alias("level"), rule["at"].alias("at"),
        rule["label"].alias("label")))


def _sweep(found: Column) -> Column:
    """Labels and best level of the detections that no interval of their level or a higher priority contains."""
    start = F.struct(F.lit(0).alias("m0"), F.lit(0).alias("m1"), F.lit(0).alias("m2"),
                     F.lit(99).alias("best"), F.array().cast("array<string>").alias("labels"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["e"]
        over = F.when(d["level"] == 0, acc["m0"]).when(d["level"] == 1, F.greatest(acc["m0"], acc["m1"])).otherwise(
            F.greatest(acc["m0"], acc["m1"], acc["m2"]))
        keep = over < end

        def top(level: int) -> Column:
            m = acc[f"m{level}"]
            return F.when(d["level"] == level, F.greatest(m, end)).otherwise(m).alias(f"m{level}")

        return F.struct(top(0), top(1), top(2),
                        F.when(keep, F.least(acc["best"], d["level"])).otherwise(acc["best"]).alias("best"),
                        F.when(keep, F.array_union(acc["labels"], F.array(d["label"])))
                        .otherwise(acc["labels"]).alias("labels"))

    return F.aggregate(F.array_sort(found), start, step)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts every place of a base phrase, ``first_word`` and
    ``last_word`` are the smallest and largest start (null without any). The
    label lists are distinct, sorted and comma-joined ('' when empty); base
    labels always stay in ``labels``. ``score`` is 0 without a detection, else
    the confidence of the best level kept. Null texts count as empty. Repeated
    rows come back repeated, an empty table gives no rows, other columns are
    not read.
    """
    ordered = rules()
    doc = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    # words with a blank on either side, only for texts that pass the first gate
    spaced = F.when(F.col("text").rlike(STEMS), F.concat(
        F.lit(" "), F.trim(F.regexp_replace(F.translate("text", UPPER, LOWER),
                                            F.lit(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit("  "))), F.lit(" ")))
    doc = doc.select("doc_id", F.regexp_count("text", F.lit(RAW_WORD)).cast("bigint").alias("n_words"),
                     spaced.alias("spaced"))

    words = F.split(F.trim("spaced"), F.lit(" +"))
    keys = F.array_intersect(words, F.array(*[F.lit(k) for k in keyword_list(ordered)]))
    table = F.array(*[F.struct(
        F.lit(r.label).alias("label"), F.lit(r.level).alias("level"), F.lit(i).alias("at"),
        F.lit(f"({pattern(r.signature)})").alias("regex"),
        F.array(*[F.array(*[F.lit(w) for w in k.split("|")]) for k in r.keywords])
        .alias("needs")) for i, r in enumerate(ordered)])
    doc = doc.withColumn("keys", F.when(F.col("spaced").isNotNull(), keys))
    asked = F.filter(table, lambda r: F.forall(r["needs"], lambda any_of: F.arrays_overlap(any_of, F.col("keys"))))
    found = F.flatten(F.transform(asked, lambda r: _spans(F.col("spaced"), r)))
    doc = doc.withColumn("kept", F.when(F.size("keys") > 0, _sweep(found)))

    for i, (phrase, _) in enumerate(BASE):
        at = _marks(_marked(F.col("spaced"), F.lit(f"({pattern(phrase)})")), "\x01", 0)
        # the phrase's first word as a cheap gate
        doc = doc.withColumn(f"b{i}", F.coalesce(F.when(F.col("spaced").contains(pattern_text(phrase)), at),
                                                 F.array().cast("array<int>")))
    places = F.concat(*[F.col(f"b{i}") for i in range(len(BASE))])
    base_labels = F.array_sort(F.array_compact(F.array(*[
        F.when(F.size(f"b{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(BASE)])))
    by_level = F.array(*[F.lit(c) for c in CONFIDENCE])
    best = F.when(F.col("kept.best") < len(CONFIDENCE), F.element_at(by_level, F.col("kept.best") + 1)).otherwise(0.0)
    return doc.withColumn("places", places).withColumn("base", base_labels).select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").cast("bigint").alias("first_word"),
        F.array_max("places").cast("bigint").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(
            "base", F.coalesce("kept.labels", F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(best, F.when(F.size("places") > 0, BASE_CONFIDENCE).otherwise(0.0)).alias("score"))


def pattern_text(phrase: str) -> str:
    """A plain phrase as it stands among spaced words."""
    return "".join(f" {w} " for w in phrase.split())
