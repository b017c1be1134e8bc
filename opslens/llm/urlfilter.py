"""URL filter: host and path rules first, then a weighted vocabulary found by Aho-Corasick.

A strict term rejects a URL alone; soft terms reject it when at least
``soft_min`` different ones occur. A term counts only where it stands alone:
the characters before and after it must not be ASCII letters or digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import col

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_CHARS = frozenset(LOWER + "0123456789")

# The rules of the contract: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

# Our vocabulary, by language (the languages of the rules' paths and of the documents).
STRICT_BY_LANGUAGE = {
    "en": ("porn", "porno", "xxx", "hentai", "milf", "camgirls", "escorts", "viagra", "cialis", "casino", "casinos",
           "warez", "keygen", "phishing", "malware", "onlinecasino", "sexcam", "nudes", "bestiality", "payday-loans"),
    "es": ("putas", "prostitutas", "pornografia", "tragaperras", "casino-en-linea", "sexo-gratis"),
    "fr": ("putes", "prostituees", "pornographie", "machines-a-sous", "casino-en-ligne", "sexe-gratuit"),
    "de": ("nutten", "huren", "pornofilme", "sexfilme", "spielautomaten", "onlinekasino", "spielhalle")}
SOFT_BY_LANGUAGE = {
    "en": ("adult", "adults", "sex", "sexy", "nude", "erotic", "escort", "dating", "hookup", "webcam", "fetish",
           "bet", "bets", "betting", "poker", "slots", "jackpot", "gambling", "lottery", "roulette", "bonus", "pills",
           "pharmacy", "steroids", "weightloss", "loan", "loans", "payday", "crypto", "forex", "torrent", "torrents",
           "crack", "cracked", "serial", "nulled", "proxy", "clickbait", "freebies", "replica", "rolex", "popunder"),
    "es": ("adultos", "sexo", "desnuda", "desnudas", "erotico", "citas", "ligar", "apuesta", "apuestas", "ruleta", "loteria",
           "premios", "farmacia", "pastillas", "adelgazar", "prestamo", "prestamos", "descargar-gratis", "replicas"),
    "fr": ("adultes", "sexe", "nue", "nues", "erotique", "rencontres", "pari", "paris-sportifs", "loterie", "gros-lot",
           "pharmacie", "pilules", "maigrir", "pret-rapide", "credit-facile", "telecharger-gratuit", "contrefacon"),
    "de": ("erwachsene", "nackt", "nackte", "erotik", "seitensprung", "wette", "wetten", "sportwetten", "lotterie", "gewinnspiel",
           "apotheke", "pillen", "abnehmen", "kredit", "sofortkredit", "gratis-download", "faelschung")}
STRICT = tuple(t for terms in STRICT_BY_LANGUAGE.values() for t in terms)
SOFT = tuple(t for terms in SOFT_BY_LANGUAGE.values() for t in terms)


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring_index(_after(url), "/", 1)).otherwise("")
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def _after(url: Column) -> Column:
    return F.substr(url, F.locate("://", url) + 3)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    rest = F.when(F.locate("://", url) > 0,
                  F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)).otherwise("")
    slash = F.locate("/", rest)
    return F.coalesce(F.when(slash > 0, F.substr(rest, slash)).otherwise(""), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits host and path; null when none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def build_automaton(strict: Sequence[str], soft: Sequence[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in soft:
        found.add_word(term, (term, False))
    for term in strict:
        found.add_word(term, (term, True))
    if len(found):
        found.make_automaton()
    return found


def count_terms(text: str, automaton: ahocorasick.Automaton) -> tuple[int, int]:
    """(strict hits, different soft terms) standing alone in an A-Z lower-cased text."""
    strict, soft = 0, set()
    if not len(automaton):
        return 0, 0
    for end, (term, is_strict) in automaton.iter(text):
        start = end - len(term) + 1
        if start and text[start - 1] in WORD_CHARS or end + 1 < len(text) and text[end + 1] in WORD_CHARS:
            continue
        if is_strict:
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", *,
               rules: Sequence[tuple[str, str, str]] = RULES, strict: Sequence[str] = STRICT,
               soft: Sequence[str] = SOFT, soft_min: int = 2) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, n_strict, n_soft.

    The longest rule that fits decides; without one the vocabulary does. Null
    URLs and URLs without ``://`` have empty host and path and fit no rule; a
    null URL holds no terms. Repeated rows come back repeated, an empty table
    gives no rows, other columns are not read. One pass, no shuffle.
    """
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("n_strict long, n_soft long")
    def terms(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = build_automaton(strict, soft)
        for batch in urls:
            yield pd.DataFrame([count_terms(u, automaton) for u in batch.fillna("")],
                               columns=["n_strict", "n_soft"])

    url = F.col("url")
    parts = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"))
    parts = parts.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"),
                         terms(F.translate(url, UPPER, LOWER)).alias("terms"))
    decided = parts.withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules))
    reject = (F.col("terms.n_strict") >= 1) | (F.col("terms.n_soft") >= soft_min)
    return decided.select(
        "page_id", "host", "path", F.col("by_rule.rule").alias("rule"),
        F.coalesce(F.col("by_rule.verdict"), F.when(reject, "block").otherwise("allow")).alias("verdict"),
        F.col("terms.n_strict").alias("n_strict"), F.col("terms.n_soft").alias("n_soft"))
