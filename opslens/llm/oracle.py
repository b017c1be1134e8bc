"""DuckDB SQL for the queries of ``queries`` that SQL can express."""

from __future__ import annotations

from opslens.llm import licenses as L
from opslens.llm import urlfilter as U


def _alone(term: str) -> str:
    return f"regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


def url_filter_sql() -> str:
    """Rules by longest match, then one strict or two different soft terms standing alone."""
    by_length = sorted(U.RULES, key=lambda r: -len(r[0] + r[1]))
    rule = " ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in by_length)
    verdict = " ".join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in by_length)
    soft = " + ".join(f"{_alone(t)}::BIGINT" for t in U.SOFT)
    # a strict hit is counted by cutting the text at everything that is not a letter or digit or one of the terms
    strict = " + ".join(
        f"length(regexp_extract_all(regexp_replace(low, '([^a-z0-9])', '\\1\\1', 'g'), "
        f"'(^|[^a-z0-9]){t.replace('-', '--')}($|[^a-z0-9])'))" for t in U.STRICT)
    return f"""
WITH u AS (SELECT page_id, coalesce(translate(url, '{U.UPPER}', '{U.LOWER}'), '') AS low,
                  CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{U.UPPER}', '{U.LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u),
t AS (SELECT *, ({strict})::BIGINT AS n_strict, ({soft})::BIGINT AS n_soft FROM h)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN n_strict >= 1 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict,
       n_strict, n_soft
FROM t"""


def warc_sql() -> str:
    """Equal payloads by digest; SHA-1 in base32, five bits at a time."""
    chars = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, {10 * part + 1}, 10))::BIGINT) >> {35 - 5 * k}) & 31)::INT + 1, 1)"
        for part in range(4) for k in range(8))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, {chars} AS payload_digest,
             min(page_id) OVER (PARTITION BY hex) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""


def _places(source: str, rules: str) -> str:
    """Word intervals of all matches: marks around each match, counted off against the words before them."""
    return f"""
SELECT doc_id, rule_no, level, label, min(pos) AS s, max(pos) AS e FROM (
  SELECT *, i - row_number() OVER m AS pos, (row_number() OVER m + 1) // 2 AS nth FROM (
    SELECT doc_id, rule_no, level, label, generate_subscripts(t, 1) AS i, unnest(t) AS tok FROM (
      SELECT doc_id, rule_no, level, label, string_split_regex(trim(regexp_replace(
               spaced, '(' || rx || ')', ' ' || chr(1) || ' \\1 ' || chr(2) || ' ', 'g')), ' +') AS t
      FROM {source}, {rules} WHERE regexp_matches(spaced, rx)))
  WHERE tok IN (chr(1), chr(2)) WINDOW m AS (PARTITION BY doc_id, rule_no ORDER BY i))
GROUP BY doc_id, rule_no, level, label, nth"""


def license_sql() -> str:
    """All rules on all texts, containment over all pairs of a text's detections."""
    rules = ", ".join(f"({i}, {r.level}, '{r.label}', '{L.pattern(r.signature)}')" for i, r in enumerate(L.rules()))
    base = ", ".join(f"({i}, 0, '{label}', '{L.pattern(phrase)}')" for i, (phrase, label) in enumerate(L.BASE))
    sure = " ".join(f"WHEN {i} THEN {c}E0" for i, c in enumerate(L.CONFIDENCE))
    return f"""
WITH rules(rule_no, level, label, rx) AS (VALUES {rules}), phrases(rule_no, level, label, rx) AS (VALUES {base}),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{L.UPPER}', '{L.LOWER}'),
                                        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
d AS (SELECT doc_id, len(words) AS n_words, ' ' || array_to_string(words, '  ') || ' ' AS spaced FROM w),
found AS ({_places("d", "rules")}),
kept AS (SELECT doc_id, level, label FROM found d WHERE NOT EXISTS (
  SELECT 1 FROM found e WHERE e.doc_id = d.doc_id AND e.level <= d.level AND e.s <= d.s AND e.e >= d.e
    AND (e.s < d.s OR e.e > d.e OR e.level < d.level OR e.rule_no < d.rule_no))),
places AS ({_places("d", "phrases")}),
b AS (SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
        SELECT doc_id, label FROM kept UNION ALL SELECT doc_id, label FROM places) GROUP BY doc_id),
best AS (SELECT doc_id, min(level) AS level FROM kept GROUP BY doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(CASE best.level {sure} ELSE 0.0E0 END, CASE WHEN n_base > 0 THEN {L.BASE_CONFIDENCE}E0 ELSE 0.0E0 END) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN best USING (doc_id)"""


ORACLE: dict[str, str] = {"op2_warc_revisits": warc_sql(), "op5_license_rules": license_sql(),
                         "op7_url_vocabulary": url_filter_sql()}
