"""DuckDB SQL with the results of the queries, written from their semantics."""

from __future__ import annotations

from quire.operators.chunking import SNIPPET_CHARS
from quire.operators.metrics import CONFIDENCE, PIPELINE_SECONDS
from quire.operators.validation import REQUEST, RULES
from quire.plans.engine import PROMPTS
from quire.plans.queries import ENTITY_TEXT, KINDS, PAGE_AREA, QUERY_TEXT, SUFFIXES
from quire.sources.routing import READERS

WS = r"[\x09-\x0D\x1C-\x20\x85\xA0]"
STRIP = rf"regexp_replace({{}}, '\A{WS}+|{WS}+\z', '', 'g')"
RSTRIP = rf"regexp_replace({{}}, '{WS}+\z', '')"
KIND = f"(['{"', '".join(KINDS)}'])[CAST(doc_id % 4 AS INT) + 1]"
HASHED = "h AS (SELECT doc_id, sha256(text) AS content_hash FROM documents)"
PAGES = """pages_ AS (SELECT doc_id AS document_id, CAST(i AS INT) + 1 AS page_number, substr(text, CAST(i AS INT) * 3000 + 1, 3000) AS native_text
  FROM documents, unnest(range(0, greatest((length(text) + 2999) // 3000, 1))) AS t(i))"""
LINES = f"""{PAGES},
lines AS (SELECT document_id, page_number, i - 1 AS line, l[i] AS text FROM (SELECT *, string_split(native_text, chr(10)) AS l FROM pages_), unnest(range(1, len(l) + 1)) AS t(i)),
tops AS (SELECT *, greatest(CAST(ceil(length(text) / 100.0) AS INT), 1) AS rows_, contains(text, '|') AS pipe FROM lines),
runs AS (SELECT *, coalesce(sum(rows_) OVER (PARTITION BY document_id, page_number ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS top,
  line - row_number() OVER (PARTITION BY document_id, page_number, pipe ORDER BY line) AS run FROM tops),
marked AS (SELECT *, pipe AND count(*) OVER (PARTITION BY document_id, page_number, pipe, run) >= 3 AS tab FROM runs),
parts AS (SELECT document_id, page_number, min(line) AS line, min(top) AS top, sum(rows_) AS rows_, any_value(tab) AS tab, string_agg(text, chr(10) ORDER BY line) AS text
  FROM marked WHERE tab OR {STRIP.format('text')} <> '' GROUP BY document_id, page_number, CASE WHEN tab THEN -1000000 - run ELSE line END, tab),
regions AS (SELECT document_id, page_number, CAST(row_number() OVER (PARTITION BY document_id, page_number ORDER BY line) - 1 AS INT) AS region_index,
  CASE WHEN tab THEN 'table' ELSE 'text' END AS region_type, text, CAST(120 + 36 * top AS DOUBLE) AS y0, CAST(120 + 36 * top + 36 * rows_ AS DOUBLE) AS y1 FROM parts)"""
FOLD = f"""fold AS (
  SELECT document_id, page_number, region_index, region_type, text, 0 AS grp, CASE WHEN region_type = 'text' THEN length(text) ELSE -1 END AS held FROM regions WHERE region_index = 0
  UNION ALL
  SELECT r.document_id, r.page_number, r.region_index, r.region_type, r.text,
    CASE WHEN r.region_type = 'text' AND f.held >= 0 AND f.held + length(r.text) <= 1500 THEN f.grp ELSE f.grp + 1 END,
    CASE WHEN r.region_type <> 'text' THEN -1 WHEN f.held >= 0 AND f.held + length(r.text) <= 1500 THEN f.held + length(r.text) ELSE length(r.text) END
  FROM fold f JOIN regions r ON r.document_id = f.document_id AND r.page_number = f.page_number AND r.region_index = f.region_index + 1),
c AS (SELECT document_id, page_number, grp, any_value(region_type) AS content_type, {STRIP.format("string_agg(text, ' ' ORDER BY region_index)")} AS raw_text, CAST(count(*) AS INT) AS n_regions, page_number || '/' || min(region_index) AS cropped_image_path FROM fold GROUP BY document_id, page_number, grp)"""
#: Each content once, under its hash.
ONCE = "once AS (SELECT sha256(text) AS doc_id, any_value(text) AS text, min(CAST(doc_id AS VARCHAR)) AS source_path FROM documents GROUP BY text)"
PAGES_ONCE, LINES_ONCE = (x.replace("FROM documents, unnest", "FROM once, unnest") for x in (PAGES, LINES))
CHUNKS = f"""q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
chunks AS (SELECT printf('%012d', d.doc_id) AS chunk_id, d.doc_id, source AS document_id, {KIND.replace('doc_id', 'd.doc_id')} AS content_type, text AS overview,
  coalesce(CAST(quality AS DOUBLE), 0.5) AS confidence_score, d.doc_id AS reading_order_index FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id)"""
PARSED = rf"""piped AS (SELECT doc_id, list_transform(list_filter(string_split(text, chr(10)), lambda x: contains(x, '|')), lambda x: {STRIP.format('x')}) AS l FROM documents WHERE contains(text, '|')),
tail AS (SELECT doc_id, l, l[2:] AS r FROM piped),
seps AS (SELECT doc_id, l, r, list_position(list_transform(r, lambda x: regexp_full_match(x, '\|?[\s\-:]+(?:\|[\s\-:]+)*\|?\s*')), true) AS p FROM tail),
body AS (SELECT doc_id, l[1] AS h, CASE WHEN p > 0 THEN list_concat(r[1:p - 1], r[p + 1:]) ELSE r END AS r FROM seps),
parsed AS (SELECT doc_id, list_transform(string_split(trim(h, '|'), '|'), lambda c: {STRIP.format('c')}) AS headers,
  list_transform(r, lambda x: list_transform(string_split(trim(x, '|'), '|'), lambda c: {STRIP.format('c')})) AS rows_ FROM body)"""
MENTIONS = """m AS (SELECT DISTINCT doc_id AS chunk_id, w AS text, CASE WHEN length(w) > 8 THEN 'ORG' ELSE 'PERSON' END AS type
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{4,}')) AS w FROM documents))"""
TURNS = "t AS (SELECT conv_id AS document_id, conv_id || '-' || turn AS chunk_id, turn FROM conversations)"
WORDS = sorted(set(QUERY_TEXT.split()))
COUNTED = f"s AS (SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda w: w IN ('{"', '".join(WORDS)}'))) AS score FROM documents)"
COSINE = "v AS (SELECT vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS similarity_score FROM embeddings)"
FUSED = f"""{CHUNKS}, {COUNTED}, {COSINE},
lists AS (
  SELECT doc_id AS chunk_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 'text' AS adapter, 0 AS o FROM (SELECT * FROM s WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 20)
  UNION ALL SELECT vec_id, row_number() OVER (ORDER BY similarity_score DESC, vec_id), 'vector', 1 FROM (SELECT * FROM v ORDER BY similarity_score DESC, vec_id LIMIT 20)
  UNION ALL SELECT doc_id, row_number() OVER (ORDER BY doc_id), 'structured', 2 FROM (SELECT * FROM chunks WHERE confidence_score >= 0.5 ORDER BY doc_id LIMIT 20)),
f AS (SELECT chunk_id, sum(1.0 / (60 + rank)) AS score, string_agg(adapter, ',' ORDER BY o, rank) AS sources, min(o * 1000 + rank) AS first_seen, arg_min(adapter, o * 1000 + rank) AS first_adapter FROM lists GROUP BY chunk_id),
top AS (SELECT * FROM f ORDER BY round(score, 12) DESC, first_seen LIMIT 20)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _route() -> str:
    name = f"'in/doc_' || doc_id || (['{"', '".join(SUFFIXES)}'])[CAST(doc_id % {len(SUFFIXES)} AS INT) + 1]"
    cases = " ".join(f"WHEN s IN ('{"', '".join(x)}') THEN '{r}'" for r, x in READERS.items())
    groups = " ".join(f"WHEN s IN ('{"', '".join(READERS[r])}') THEN '{r}'" for r in ("image", "excel", "email", "text"))
    return f"""WITH p AS (SELECT doc_id, lower(regexp_extract({name}, '(\\.[^.]+)$', 1)) AS s FROM documents)
SELECT doc_id, CASE {cases} ELSE 'text' END AS reader, CASE {groups} WHEN s = '' THEN 'unknown' ELSE substr(s, 2) END AS format FROM p"""


def _prompt() -> str:
    quoted = lambda x: "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    cases = " ".join(f"WHEN kind = '{k}' THEN {quoted(chr(10).join((a, '', b)))}" for k, (a, b) in PROMPTS.items())
    tail = "\n\n".join(("", "Be exact.", 'Also extract the following schema fields as JSON keys:\n  "total": "the sum"', "Restrict entity types to: ORG|PERSON|DATE|MONEY|LOCATION|PRODUCT. Return them in the 'entities' key as described above."))
    return f"SELECT doc_id, CASE {cases} ELSE 'Extract all content from this region.' END || {quoted(tail)} AS prompt FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'unknown' ELSE {KIND} END AS kind FROM documents)"


def _hints() -> str:
    hint = {r.name: f"CORRECTION REQUIRED ({r.name}): {r.hint}".replace("'", "''") for r in RULES}
    both = f"'{hint['latex_present']}' || chr(10) || '{hint['overview_present']}'"
    return f"SELECT doc_id, source || chr(10) || chr(10) || '{REQUEST}' || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN {both} ELSE '{hint['row_column_count']}' END AS prompt FROM documents"


def _histogram(value: str, source: str, buckets: tuple[float, ...], label: str = "") -> str:
    bounds = ", ".join(f"({b}::DOUBLE)" for b in buckets) + ", (NULL::DOUBLE)"
    head = f"{label}, " if label else ""
    return f"SELECT {head}le, count(*) FILTER (WHERE le IS NULL OR {value} <= le) AS n FROM {source}, (VALUES {bounds}) AS b(le) WHERE {value} IS NOT NULL GROUP BY {head}le"


def _html(visible: bool) -> str:
    """Character data by a token pattern: scripts and styles whole, comments, tags, and what lies between them."""
    tokens = r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<[!/]?[A-Za-z][^>]*>|[^<]+"
    html = "regexp_replace(html, '(?s)<head>.*?</head>', '', 'g')" if visible else "html"
    raw = "NULL" if visible else "regexp_replace(x, '^<[^>]*>|</[a-z]+>$', '', 'g')"
    plain = "x"
    for name, char in (("quot", '"'), ("copy", "\u00a9"), ("middot", "\u00b7"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        plain = f"regexp_replace({plain}, '&{name};?', '{char}', 'g')"
    return f"""WITH t AS (SELECT page_id, regexp_extract_all({html}, '{tokens}') AS l FROM pages)
SELECT page_id, array_to_string(list_filter(list_transform(l, lambda x: CASE WHEN regexp_matches(x, '^<s(cript|tyle)') THEN {raw} WHEN x[1] = '<' THEN NULL ELSE {plain} END), lambda x: x <> ''), ' ') AS text FROM t"""


def _ingest() -> str:
    """Chunks of each content with the rule extractor's overview, and the snippets across page breaks."""
    told = f"coalesce(nullif(regexp_extract(raw_text, '(?s)\\A(.*?[.!?]){WS}', 1), ''), raw_text)"
    return rf"""WITH RECURSIVE {ONCE}, {LINES_ONCE},
{FOLD},
k AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY page_number, grp) - 1 AS i FROM c),
ends AS (SELECT document_id, page_number, min(i) AS a, max(i) AS z, arg_min(raw_text, i) AS first, {RSTRIP.format('arg_max(raw_text, i)')} AS last FROM k WHERE content_type = 'text' GROUP BY document_id, page_number),
pairs AS (SELECT p.document_id, p.page_number, p.z, n.a, p.last, n.first FROM ends p JOIN ends n ON n.document_id = p.document_id AND n.page_number = p.page_number + 1 WHERE NOT regexp_matches(p.last, '[.!?]\z') AND p.last <> ''),
fore AS (SELECT document_id, z AS i, '[...continues on page ' || (page_number + 1) || ': ' || substr(first, 1, {SNIPPET_CHARS}) || ']' AS s FROM pairs),
back AS (SELECT document_id, a AS i, '[...continued from page ' || page_number || ': ' || right(last, {SNIPPET_CHARS}) || ']' AS s FROM pairs)
SELECT sha256(k.document_id || '|' || page_number || '|' || k.i) AS chunk_id, k.document_id, page_number, CAST(k.i AS INT) AS chunk_index, content_type,
  coalesce(nullif(substr({told}, 1, 200), ''), 'Empty region.') AS overview, 1.0::DOUBLE AS confidence_score, coalesce(fore.s, back.s) AS page_break_context
FROM k LEFT JOIN fore ON k.document_id = fore.document_id AND k.i = fore.i LEFT JOIN back ON k.document_id = back.document_id AND k.i = back.i"""


def oracle_sql() -> dict[str, str]:
    entity = ENTITY_TEXT
    turn_tables = rf"""c AS (SELECT conv_id AS document_id, turn AS page_number, CASE WHEN role = 'system' THEN 'text' ELSE 'table' END AS kind, right(text, 200) AS ending, conv_id || '-' || turn AS chunk_id FROM conversations),
k AS (SELECT a.*, a.kind = 'table' AND coalesce(b.kind = 'table', false) AND NOT regexp_matches(coalesce(b.ending, ''), '(?i)\b(total|grand total|subtotal|sum|average)\b') AS is_continuation
  FROM c a LEFT JOIN c b ON a.document_id = b.document_id AND a.page_number = b.page_number + 1)"""
    region_box = "SELECT document_id, page_number, region_index"
    return {
        "doc_content_hash": _with(HASHED, "SELECT * FROM h"),
        "doc_dedup_survivors": _with(HASHED, "SELECT min(doc_id) AS doc_id, content_hash FROM h GROUP BY content_hash"),
        "doc_unseen": _with(HASHED, "SELECT * FROM h WHERE content_hash NOT IN (SELECT content_hash FROM h WHERE doc_id % 2 = 0)"),
        "route_formats": _route(),
        "text_paginate": _with(PAGES, "SELECT * FROM pages_"),
        "quality_tier": _with(PAGES, f"SELECT document_id, round(avg(length({STRIP.format('native_text')}) / {PAGE_AREA}::DOUBLE), 9) AS density, CASE WHEN avg(length({STRIP.format('native_text')}) / {PAGE_AREA}::DOUBLE) < 0.3 THEN 'high_detail' ELSE 'standard' END AS quality_tier FROM pages_ WHERE page_number <= 5 GROUP BY document_id"),
        "scanned_pages": _with(PAGES, f"SELECT document_id, page_number, length({STRIP.format('native_text')}) < 50 AS is_scanned FROM pages_"),
        "html_strip": _html(False),
        "html_strip_visible": _html(True),
        "csv_to_text": "SELECT doc_id, 'id, lang, text' || chr(10) || doc_id || ', ' || lang || ', ' || text AS text FROM documents",
        "mail_pages": _with(PAGES, "SELECT CAST(document_id AS VARCHAR) AS source_path, page_number, native_text, 'Document ' || document_id AS subject, CASE WHEN page_number = 1 THEN source || '@example.org' END AS sender FROM pages_ JOIN documents ON document_id = doc_id"),
        "virtual_regions": _with(LINES, "SELECT * FROM regions"),
        "bbox_derived": _with(LINES, f"{region_box}, 2240.0::DOUBLE AS width, y1 - y0 AS height, 2240.0 * (y1 - y0) AS area, 1240.0::DOUBLE AS cx, (y0 + y1) / 2 AS cy FROM regions"),
        "crop_box_path": _with(LINES, f"{region_box}, 112.0::DOUBLE AS x0, greatest(y0 - 8, 0) AS y0, 2368.0::DOUBLE AS x1, least(y1 + 8, 3508) AS y1, printf('crops/%d/page_%03d_region_%02d_%s.png', document_id, page_number, region_index, region_type) AS path FROM regions"),
        "detector_classes": "SELECT p_partkey, CASE p_size % 13 WHEN 3 THEN 'table' WHEN 4 THEN 'figure' WHEN 5 THEN 'caption' WHEN 6 THEN 'caption' WHEN 7 THEN 'header' WHEN 8 THEN 'footer' WHEN 10 THEN 'formula' ELSE 'text' END AS region_type FROM part",
        "resolution_guard": "SELECT p_partkey, round(p_size * 60 * 300 / 3508.0::DOUBLE, 6) AS dpi, CASE WHEN p_size * 60 * 300 / 3508.0::DOUBLE < 150 THEN 2 ELSE 1 END AS factor FROM part",
        "skew_angle": "SELECT l_suppkey AS page_id, coalesce(-median(CASE WHEN abs(l_quantity - 25.5) < 5 THEN l_quantity - 25.5 END), 0.0) AS rotation FROM lineitem GROUP BY l_suppkey",
        "chunk_merge": f"""WITH RECURSIVE {LINES},
{FOLD}
SELECT document_id, page_number, CAST(row_number() OVER (PARTITION BY document_id ORDER BY page_number, grp) - 1 AS INT) AS chunk_index, content_type, raw_text, n_regions, cropped_image_path FROM c""",
        "ingest_documents": _ingest(),
        "stored_documents": f"WITH {ONCE}, {PAGES_ONCE} SELECT document_id, document_id AS content_hash, any_value(source_path) AS source_path, max(page_number) AS total_pages, 'complete' AS processing_status FROM pages_ JOIN once ON document_id = doc_id GROUP BY document_id",
        "stored_chunks": f"""WITH RECURSIVE {ONCE}, {LINES_ONCE},
{FOLD}
SELECT document_id, page_number, CAST(row_number() OVER (PARTITION BY document_id ORDER BY page_number, grp) - 1 AS INT) AS chunk_index, content_type, raw_text, 1.0::DOUBLE AS confidence_score FROM c""",
        "stored_regions": f"WITH {ONCE}, {LINES_ONCE} SELECT document_id, page_number, region_index, region_type, y0, y1 FROM regions",
        "stored_graph": f"""WITH RECURSIVE {ONCE}, {LINES_ONCE},
{FOLD},
n AS (SELECT (SELECT count(*) FROM once) AS d, (SELECT count(*) FROM c) AS k, (SELECT count(*) FROM regions) AS r, (SELECT count(DISTINCT document_id) FROM c) AS f)
SELECT unnest(['documents', 'chunks', 'regions', 'has_chunk', 'has_region', 'next_chunk']) AS kind, unnest([d, k, r, k, r, k - f]) AS n FROM n""",
        "stored_vectors": f"""WITH RECURSIVE {ONCE}, {LINES_ONCE},
{FOLD},
k AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY page_number, grp) - 1 AS i FROM c)
SELECT sha256(document_id || '|' || page_number || '|' || i) AS chunk_id, document_id, content_type, page_number, 64 AS dim FROM k""",
        "stem_rank": r"""WITH t AS (SELECT doc_id, list_transform(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: CASE WHEN regexp_matches(w, '(ss|us)$') THEN w
  WHEN regexp_matches(w, '.{3}ies$') THEN w[:-4] || 'y' WHEN regexp_matches(w, '.{3}sses$') THEN w[:-3] WHEN regexp_matches(w, '.{3}ings$') THEN w[:-5] WHEN regexp_matches(w, '.{3}ing$') THEN w[:-4] WHEN regexp_matches(w, '.{3}edly$') THEN w[:-5]
  WHEN regexp_matches(w, '.{3}ed$') THEN w[:-3] WHEN regexp_matches(w, '.{3}ly$') THEN w[:-3] WHEN regexp_matches(w, '.{3}es$') THEN w[:-3] WHEN regexp_matches(w, '.{3}s$') THEN w[:-2] ELSE w END) AS l FROM documents),
s AS (SELECT doc_id, CAST(len(list_filter(l, lambda w: w IN ('licens', 'reserv'))) AS INT) AS score FROM t)
SELECT doc_id, score, CAST(row_number() OVER (ORDER BY score DESC, doc_id) AS INT) AS rank FROM s WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 50""",
        "json_contained": "SELECT doc_id FROM documents WHERE lang = 'de' AND source = 'src1'",
        "json_path_or": "SELECT event_id FROM events WHERE json_valid(props) AND (CAST(json_extract(props, '$.k') AS DOUBLE) > 90 OR NOT coalesce(CAST(json_extract(props, '$.k') AS DOUBLE) >= 10, false))",
        "dedup_hit_count": _with(HASHED, "SELECT CAST(sum(n - CASE WHEN known THEN 0 ELSE 1 END) AS BIGINT) AS n FROM (SELECT count(*) AS n, bool_or(doc_id % 2 = 0) AS known FROM h GROUP BY content_hash)"),
        "sheet_grid_cells": _with(
            f"{PARSED}, g AS (SELECT doc_id, list_concat([headers], rows_) AS g FROM parsed), r AS (SELECT doc_id, i - 1 AS row, g[i] AS cells FROM g, unnest(range(1, len(g) + 1)) AS t(i))",
            "SELECT doc_id, CAST(row AS INT) AS row, CAST(j - 1 AS INT) AS col, CAST((j - 1) * 200 AS INT) AS x0, CAST(row * 40 AS INT) AS y0, CAST(j * 200 AS INT) AS x1, CAST((row + 1) * 40 AS INT) AS y1, substr(cells[j], 1, 24) AS text FROM r, unnest(range(1, len(cells) + 1)) AS t(j)",
        ),
        "caption_attach": f"""WITH i AS (SELECT conv_id, turn, role, {STRIP.format('text')} AS text, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS anchor FROM conversations)
SELECT conv_id, anchor, string_agg(text, ' ' ORDER BY turn) AS caption FROM i WHERE role = 'assistant' AND anchor IS NOT NULL AND text <> '' GROUP BY conv_id, anchor""",
        "page_break_bridge": _with(
            f"{PAGES}, e AS (SELECT document_id, page_number, native_text, {RSTRIP.format('native_text')} AS r FROM pages_), p AS (SELECT a.document_id, a.page_number, a.r, b.native_text AS nxt FROM e a JOIN e b ON a.document_id = b.document_id AND b.page_number = a.page_number + 1 WHERE a.r <> '' AND right(a.r, 1) NOT IN ('.', '!', '?')), "
            "u AS (SELECT document_id || '-' || page_number AS chunk_id, 2 AS rank, '[...continues on page ' || (page_number + 1) || ': ' || substr(nxt, 1, 50) || ']' AS context FROM p UNION ALL SELECT document_id || '-' || (page_number + 1), 1, '[...continued from page ' || page_number || ': ' || right(r, 50) || ']' FROM p)",
            "SELECT chunk_id, arg_max(context, rank) AS page_break_context FROM u GROUP BY chunk_id",
        ),
        "md_table_parse": _with(PARSED, "SELECT doc_id, array_to_string(headers, '␟') AS headers, CAST(len(rows_) AS INT) AS n_rows, array_to_string(flatten(rows_), '␟') AS cells FROM parsed"),
        "md_table_cells": _with(
            PARSED,
            'SELECT doc_id, 0 AS "row", CAST(c AS INT) - 1 AS col, headers[c] AS value, true AS is_header FROM parsed, unnest(range(1, len(headers) + 1)) AS t(c) UNION ALL SELECT doc_id, CAST(i AS INT), CAST(c AS INT) - 1, rows_[i][c], false FROM parsed, unnest(range(1, len(rows_) + 1)) AS t(i), unnest(range(1, len(rows_[i]) + 1)) AS u(c)',
        ),
        "md_table_build": _with(PARSED, "SELECT doc_id, array_to_string(list_concat(['| ' || array_to_string(headers, ' | ') || ' |', '| ' || array_to_string(list_transform(headers, lambda x: '---'), ' | ') || ' |'], list_transform(rows_, lambda r: '| ' || array_to_string(r, ' | ') || ' |')), chr(10)) AS markdown FROM parsed"),
        "figure_reclassify": "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: contains(x, '|'))) >= 3 AS is_table FROM documents",
        "table_continuation": _with(turn_tables, "SELECT document_id, page_number, is_continuation, CASE WHEN is_continuation THEN 0.9 ELSE 0.0 END::DOUBLE AS continuation_confidence FROM k"),
        "table_merge": _with(
            f"{turn_tables}, g AS (SELECT *, sum(CASE WHEN is_continuation THEN 0 ELSE 1 END) OVER (PARTITION BY document_id ORDER BY page_number ROWS UNBOUNDED PRECEDING) AS g FROM k WHERE kind = 'table')",
            "SELECT arg_min(chunk_id, page_number) AS chunk_id, min(page_number) AS page_number, string_agg(chunk_id, ',' ORDER BY page_number) AS rows, CASE WHEN count(*) > 1 THEN min(page_number) ELSE -1 END AS continued_from_page, CASE WHEN count(*) > 1 THEN 0.9 ELSE 0.0 END::DOUBLE AS merge_confidence FROM g GROUP BY document_id, g",
        ),
        "table_cell_match": _with(PARSED, "SELECT doc_id FROM parsed WHERE len(list_filter(flatten(rows_), lambda v: v > 'm')) > 0"),
        "prompt_build": _prompt(),
        "answer_parse": "SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN text ELSE '' END AS raw_text, CASE WHEN doc_id % 4 < 2 THEN source ELSE '' END AS overview, CASE WHEN doc_id % 4 < 2 THEN lang END AS language FROM documents",
        "completion_content": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS content FROM documents",
        "validate_rules": _with(
            f"{PARSED}, q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id), a AS (SELECT d.doc_id, {KIND.replace('doc_id', 'd.doc_id')} AS kind, quality, lang, headers, rows_ FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id LEFT JOIN parsed p ON d.doc_id = p.doc_id)",
            "SELECT doc_id, array_to_string(list_filter([CASE WHEN kind = 'table' AND len(headers) > 0 AND len(list_filter(rows_, lambda r: len(r) <> len(headers))) > 0 THEN 'row_column_count' END, CASE WHEN kind = 'formula' AND lang <> 'en' THEN 'latex_present' END, CASE WHEN quality IS DISTINCT FROM 1 THEN 'overview_present' END], lambda x: x IS NOT NULL), ',') AS failed FROM a",
        ),
        "correction_hints": _hints(),
        "review_status": _with(CHUNKS, "SELECT document_id, CASE WHEN bool_or(confidence_score < 0.5) THEN 'review_required' ELSE 'complete' END AS processing_status FROM chunks WHERE content_type <> 'formula' GROUP BY document_id"),
        "adapt_v1_v2": "SELECT doc_id, source AS cropped_image_path, 0 AS n_entities, CAST(CASE WHEN doc_id % 3 > 0 THEN n_chars ELSE 0 END AS INT) AS reading_order_index, false AS correction_applied, 2 AS schema_version FROM documents",
        "upsert_columns": "SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN upper(lang) ELSE lang END AS lang, n_chars + CASE WHEN doc_id % 3 > 0 THEN 1 ELSE 0 END AS n_chars FROM documents",
        "point_ids": "SELECT doc_id, CAST(CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 16)) AS UBIGINT) AS VARCHAR) AS point_id FROM documents",
        "embed_sources": f"""WITH c AS (SELECT doc_id AS chunk_id, {KIND} AS kind, CASE WHEN lang = 'en' THEN source END AS path, CASE WHEN doc_id % 8 < 4 THEN lang END AS about, text FROM documents)
SELECT chunk_id, CASE WHEN kind = 'figure' AND path IS NOT NULL THEN 'image' WHEN kind = 'figure' AND about IS NOT NULL THEN 'description' ELSE 'overview' END AS embed_kind,
  CASE WHEN kind = 'figure' AND path IS NOT NULL THEN path WHEN kind = 'figure' AND about IS NOT NULL THEN about ELSE text END AS embed_input FROM c""",
        "manifest_outcomes": "SELECT CAST(doc_id AS VARCHAR) AS document_id, sink, status, error FROM documents, (VALUES ('mongo', 'ok', NULL), ('postgres', 'error', 'OSError: sink is closed')) AS s(sink, status, error)",
        "structured_filter_page": _with(CHUNKS, "SELECT chunk_id, document_id, confidence_score FROM chunks WHERE doc_id >= 10 AND content_type IN ('text', 'table') AND confidence_score >= 0.5 ORDER BY chunk_id LIMIT 50"),
        "keyset_page2": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'F') ORDER BY o_orderkey LIMIT 50 OFFSET 50",
        "filter_total": _with(CHUNKS, "SELECT count(*) AS total FROM chunks WHERE doc_id >= 10 AND content_type IN ('text', 'table') AND confidence_score >= 0.5"),
        "mongo_filter": _with(CHUNKS, "SELECT chunk_id, document_id, confidence_score FROM chunks WHERE (document_id IN ('src1', 'src2', 'src3') OR doc_id BETWEEN 100 AND 159) AND doc_id <> 101 AND content_type IN ('text', 'figure') AND confidence_score >= 0.5 AND list_contains(string_split_regex(lower(overview), '[^a-z0-9]+'), 'the')"),
        "json_path_filter": "SELECT event_id FROM events WHERE CAST(json_extract(props, '$.k') AS DOUBLE) > 50",
        "json_key_exists": "SELECT event_id, coalesce(json_exists(props, '$.k'), false) AS has_k, coalesce(json_exists(props, '$.k.z'), false) AS has_z FROM events",
        "fulltext_rank": _with(COUNTED, "SELECT doc_id, CAST(score AS INT) AS score, CAST(row_number() OVER (ORDER BY score DESC, doc_id) AS INT) AS rank FROM (SELECT * FROM s WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 50)"),
        "vector_topk": _with(COSINE, "SELECT * FROM v ORDER BY similarity_score DESC, vec_id LIMIT 20"),
        "vector_min_score": _with(COSINE, "SELECT * FROM v WHERE similarity_score >= 0.1"),
        "vector_filtered": _with(COSINE, "SELECT * FROM v WHERE label = 3 ORDER BY similarity_score DESC, vec_id LIMIT 20"),
        "vector_page2": _with(COSINE, "SELECT * FROM v ORDER BY similarity_score DESC, vec_id LIMIT 20 OFFSET 20"),
        "graph_mentions": _with(MENTIONS, "SELECT * FROM m"),
        "entity_dedup": _with(MENTIONS, "SELECT text, type, count(*) AS n_chunks FROM m GROUP BY text, type"),
        "next_chunk": _with(TURNS, "SELECT * FROM (SELECT chunk_id AS from_id, lead(chunk_id) OVER (PARTITION BY document_id ORDER BY turn) AS to_id FROM t) WHERE to_id IS NOT NULL"),
        "chain_order": _with(TURNS, "SELECT document_id, chunk_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY turn) - 1 AS INT) AS position FROM t"),
        "chain_heads": _with(TURNS, "SELECT document_id, arg_min(chunk_id, turn) AS chunk_id FROM t GROUP BY document_id"),
        "table_row_nodes": _with(PARSED, "SELECT doc_id AS chunk_id, CAST(i AS INT) - 1 AS row_index, array_to_string(rows_[i], '␟') AS cells FROM parsed, unnest(range(1, len(rows_) + 1)) AS t(i)"),
        "entity_traverse_d1": _with(MENTIONS, f"SELECT DISTINCT chunk_id FROM m WHERE text = '{entity}'"),
        "entity_traverse_d3": _with(MENTIONS, f"SELECT DISTINCT c.chunk_id FROM m c JOIN m b ON c.text = b.text AND c.type = b.type JOIN m a ON a.chunk_id = b.chunk_id WHERE a.text = '{entity}' AND a.type = 'PERSON'"),
        "entity_docs": _with(MENTIONS, f"SELECT source AS document_id, 'in/' || source AS source_path, count(*) AS n_chunks FROM documents WHERE doc_id IN (SELECT chunk_id FROM m WHERE text = '{entity}') GROUP BY source"),
        "traverse_all": _with(CHUNKS, "SELECT chunk_id, document_id, reading_order_index FROM chunks WHERE document_id = 'src3' ORDER BY reading_order_index LIMIT 50 OFFSET 5"),
        "fused_rrf": _with(FUSED, "SELECT chunk_id, round(score, 9) AS rrf_score FROM top"),
        "fused_sources": _with(FUSED, "SELECT chunk_id, sources FROM f"),
        "fused_representative": _with(FUSED, "SELECT chunk_id, first_adapter, source, lang FROM top JOIN documents ON chunk_id = doc_id"),
        "metrics_by_status": _with(CHUNKS + ", st AS (SELECT document_id, CASE WHEN bool_or(confidence_score < 0.5) THEN 'review_required' ELSE 'complete' END AS processing_status FROM chunks GROUP BY document_id)", "SELECT processing_status, count(*) AS n FROM st GROUP BY processing_status"),
        "metrics_regions_by_type": _with(LINES, "SELECT region_type, count(*) AS n FROM regions GROUP BY region_type"),
        "confidence_histogram": _with(CHUNKS, _histogram("confidence_score", "chunks", CONFIDENCE)),
        "latency_histogram": _histogram("value", "events", PIPELINE_SECONDS, "event_type"),
        "stream_ingest_dedup": _with(HASHED, "SELECT DISTINCT content_hash, 'complete' AS processing_status FROM h"),
    }
