"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

import re

from quire.llm.licenses import PHRASES, TEMPLATES

FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def template_pattern(markup: str) -> str:
    """A template's markup as a regular expression over " word word ", by text substitution alone."""
    flat = " " + " ".join(markup.split())
    flat = re.sub(r" \[\[((?: \w+)+) \]\]", r"(?:\1)?", flat)
    return re.sub(r" \{\{[^:}]*:(\d+)\}\}", r"(?: [^ ]+){0,\1}", flat) + " "


def _op5() -> str:
    """Every 100-byte window in hexadecimal, in blocks of 500 starts; windows that share a hash are compared whole."""
    return """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, o, substr(h, 2 * o + 1, 1198) AS h FROM d, unnest(range(0, greatest(length(h) // 2 - 99, 0), 500)) AS t(o)),
w AS (SELECT doc_id, o + i AS p, substr(h, 2 * i + 1, 200) AS s FROM b, unnest(range(least(500, length(h) // 2 - 99))) AS t(i)),
often AS (SELECT hash(s) AS k FROM w GROUP BY hash(s) HAVING count(*) > 1),
hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w WHERE hash(s) IN (SELECT k FROM often)) WHERE k > 1),
gone AS (SELECT doc_id, p AS a, p + 100 AS b, CASE WHEN p <= max(p + 100) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM hit),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a ROWS UNBOUNDED PRECEDING) AS run FROM gone),
spans AS (SELECT doc_id, min(a) AS a, max(b) AS b FROM numbered GROUP BY doc_id, run),
edges AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last FROM spans GROUP BY doc_id),
held AS (SELECT e.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS s FROM edges e JOIN d ON e.doc_id = d.doc_id GROUP BY e.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(s, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id LEFT JOIN held ON d.doc_id = held.doc_id"""


def _op8() -> str:
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({FOLD}, {ALNUM}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({FOLD}, {ALNUM}) AS w FROM benchmark),
n AS (SELECT *, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM n, unnest(range(1, len(w) - k + 2)) AS t(i)),
ks AS (SELECT DISTINCT k FROM win),
places AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM d, ks, unnest(range(1, greatest(len(w) - k + 2, 1))) AS t(i)),
found AS (SELECT doc_id, i, win.k, item_id FROM places JOIN win USING (k, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, k FROM found), unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""


def _op9() -> str:
    esc = r"replace(replace({}, '\', '\\'), '<|', '<\|')"
    said = "'<|im_end|><|im_start|>assistant ok'"
    return rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', {said}), (-1, 1, 'assistant', {said}))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
  CAST(sum(12 + length({esc.format('role')}) + 1 + length({esc.format('text')}) + 11) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


def _op10() -> str:
    conditions, labels = [], []
    for phrase, label in PHRASES.items():
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split()))
        conditions.append(f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {test}), lambda i: i - 1)")
        labels.append((label, f"regexp_matches(s, ' {phrase} ')"))
    base = ", ".join(f"CASE WHEN {c} THEN '{x}' END" for x, c in labels)
    own: dict[str, list[str]] = {}
    for label, markup in TEMPLATES:
        own.setdefault(label, []).append(f"regexp_matches(s, '{template_pattern(markup)}')")
    more = ", ".join(f"CASE WHEN {' OR '.join(c)} THEN '{x}' END" for x, c in own.items())
    tidy = "array_to_string(list_sort(list_distinct(list_filter({}, lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({FOLD}, {ALNUM}) AS w FROM documents),
e AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS s FROM d),
f AS (SELECT doc_id, len(w) AS n, flatten([{', '.join(conditions)}]) AS p, {tidy.format(f'[{base}]')} AS base_labels,
  {tidy.format(f'[{base}, {more}]')} AS labels, len(list_filter([{more}], lambda x: x IS NOT NULL)) > 0 AS own FROM e)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base, CAST(list_min(p) AS BIGINT) AS first_word,
  CAST(list_max(p) AS BIGINT) AS last_word, base_labels, labels,
  CAST(CASE WHEN own THEN 1.0 WHEN base_labels <> '' THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score FROM f"""


def oracle_sql() -> dict[str, str]:
    return {"op5_suffix_dedup": _op5(), "op8_decontamination": _op8(), "op9_chat_format": _op9(), "op10_license_scan": _op10()}
