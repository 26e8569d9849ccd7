"""The same results in ANSI SQL, for the queries of :mod:`catalog_text`."""

from __future__ import annotations

# Whitespace and line breaks as RE2 character classes.
WS = (
    r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
NL = r"\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{WS}]+|[{WS}]+\z', '', 'g')"


def title(text: str) -> str:
    return strip(rf"regexp_replace(regexp_extract({text}, '\A[^{NL}]*'), '\A[# ]+', '')")


def tidy(x: str) -> str:
    x = rf"regexp_replace({x}, '\r\n|[{NL}]', chr(10), 'g')"
    x = rf"regexp_replace({x}, '[{WS}]*\n[{WS}]*\n', chr(10) || chr(10), 'g')"
    inner = WS.replace(r"\n", "")
    x = rf"regexp_replace({x}, '[{inner}]+\n', chr(10), 'g')"
    return strip(x)


DOCS = f"""docs AS (
  SELECT 'doc/' || doc_id AS url, text AS content, {title('text')} AS title
  FROM documents WHERE regexp_matches(text, '[^{WS}]'))"""


def windows(source: str, name: str) -> str:
    """Fixed windows of 800 with overlap 150, keyed, at least 50 long."""
    return f"""{name}_w AS (
  SELECT url, st // 650 AS chunk_index, {strip('substr(content, st + 1, 800)')} AS chunk_text
  FROM (SELECT url, content,
               unnest(generate_series(0, greatest(length(content) - 151, 0), 650)) AS st
        FROM {source})),
{name} AS (
  SELECT substr(sha256(url || '::' || chunk_index), 1, 16) AS chunk_id, url,
         chunk_index::BIGINT AS chunk_index, chunk_text
  FROM {name}_w WHERE length(chunk_text) >= 50)"""


SHOWN = "chunk_id, url, chunk_index, length(chunk_text)::BIGINT AS n_chars, md5(chunk_text) AS text_md5"


def _canonical(url: str) -> str:
    x = rf"regexp_replace({url}, '\A[A-Za-z][A-Za-z0-9+.-]*://', '')"
    x = rf"regexp_replace({x}, '[?#].*\z', '')"
    x = rf"regexp_replace({x}, '\A(www|m)\.', '')"
    x = rf"regexp_replace({x}, '/+\z', '')"
    return rf"regexp_replace({x}, '\.html?\z', '')"


def _without(tag: str, x: str) -> str:
    return rf"regexp_replace({x}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', '', 'g')"


def _root(x: str) -> str:
    parts = [
        rf"nullif(regexp_extract({x}, '(?is)<{t}\b[^>]*>(.*?)(?:</{t}\s*>|\z)', 1), '')"
        for t in ("main", "article", "body")
    ]
    return f"coalesce({', '.join(parts)}, {x})"


def _kept(html: str) -> str:
    x = rf"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style", "nav", "header", "footer", "noscript"):
        x = _without(tag, x)
    return x


def _entities(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


_LINES = r"regexp_replace(r, '(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table)\b[^>]*>', chr(10), 'g')"
PLAIN_PAGES = f"""kept AS (SELECT page_id, {_kept('html')} AS k FROM pages),
roots AS (SELECT page_id, {_root('k')} AS r FROM kept),
plain AS (
  SELECT page_id, {tidy(_entities(f"regexp_replace({_LINES}, '<[^>]*>', '', 'g')"))} AS t FROM roots)"""

# The pages use these elements only inside their article: h1, p, b, br. A bold run
# ends with its paragraph, and a paragraph ends where the next block begins.
_MD = r"regexp_replace(r, '<h1>(.*?)</h1>', chr(10) || chr(10) || '# \1' || chr(10) || chr(10), 'g')"
_MD = rf"regexp_replace({_MD}, '\*', '\\*', 'g')"
_MD = rf"regexp_replace({_MD}, '_', '\\_', 'g')"
_MD = rf"regexp_replace({_MD}, '(?s)<b>\s*(.*?)\s*((?:<br>\s*)*(?:<p>|</p>|\z))', '**\1**\2', 'g')"
_MD = rf"regexp_replace({_MD}, '<br>', chr(10), 'g')"
_MD = rf"regexp_replace({_MD}, '</?p>', chr(10) || chr(10), 'g')"
# HTML reads these four names also where the semicolon is missing.
for _name, _char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
    _MD = f"regexp_replace({_MD}, '&{_name};?', '{_char}', 'g')"
MARKDOWN_PAGES = f"""kept AS (SELECT page_id, url, {_kept('html')} AS k FROM pages),
roots AS (SELECT page_id, url, {_root('k')} AS r FROM kept),
md AS (SELECT page_id, url, {tidy(_MD)} AS content FROM roots)"""

SNAPSHOTS = f"""old_docs AS (SELECT 'doc/' || doc_id AS url, text AS content FROM documents),
{MARKDOWN_PAGES},
new_docs AS (
  SELECT 'doc/' || doc_id AS url, regexp_replace(text, '[0-9]', '#', 'g') AS content FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL SELECT 'page/' || page_id, content FROM md),
{windows('old_docs', 'old')},
{windows('new_docs', 'new')}"""

# Recursive splitting. Segments are cut at the coarsest separator they hold; cuts
# of 800 and more are cut again. Neighbouring shorter cuts form runs, and a fold
# over each run gives chunks of at most 800 that share at most 150.
_SEPARATORS = "[chr(10) || '## ', chr(10) || '### ', chr(10) || chr(10), chr(10), '. ', ' ', '']"


def recursive(source: str, key: str, name: str) -> str:
    return f"""{name}_seg AS (
  SELECT {key} AS k, -1::BIGINT AS parent, -1::BIGINT AS parent_level, 1::BIGINT AS st,
         length(content)::BIGINT AS n, 0::BIGINT AS level, true AS is_long
  FROM {source}
  UNION ALL
  SELECT k, st, level, begins::BIGINT, pn::BIGINT, (c + 1)::BIGINT, pn >= 800 FROM (
    SELECT k, st, level, c, pn, st + coalesce(sum(pn) OVER (
             PARTITION BY k, st ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
    FROM (
      SELECT k, st, level, c, unnest(range(len(parts))) AS i,
             unnest(list_transform(parts, lambda x, j: length(x) + CASE WHEN j = 1 THEN 0 ELSE length(sep) END)) AS pn
      FROM (
        SELECT k, st, level, c, {_SEPARATORS}[c + 1] AS sep, string_split(seg, {_SEPARATORS}[c + 1]) AS parts
        FROM (
          SELECT *, list_filter(range(7), lambda i: i >= level AND contains(seg, {_SEPARATORS}[i + 1]))[1] AS c
          FROM (SELECT k, st, level, substr(content, st, n) AS seg
                FROM {name}_seg JOIN {source} ON {key} = k WHERE is_long)))))
  WHERE pn > 0),
{name}_runs AS (
  SELECT k, parent, parent_level, run, list(st ORDER BY st) AS starts, list(st + n ORDER BY st) AS ends FROM (
    SELECT *, sum(is_long::INT) OVER (PARTITION BY k, parent, parent_level ORDER BY st) AS run
    FROM {name}_seg WHERE parent >= 0)
  WHERE NOT is_long GROUP BY ALL),
{name}_folded AS (
  SELECT k, list_reduce(
    list_transform(list_zip(starts, ends), lambda p: {{'s': p[1], 'e': p[2], 'l': p[1], 'o': []::STRUCT(a BIGINT, b BIGINT)[]}}),
    lambda acc, p: CASE WHEN p.e - acc.l > 800 AND p.s > acc.l THEN {{'s': p.s, 'e': p.e,
        'l': list_min(list_filter(starts, lambda x: x > acc.l AND p.s - x <= 150 AND p.e - x <= 800)),
        'o': list_append(acc.o, {{'a': acc.l, 'b': p.s}})}}
      ELSE {{'s': p.s, 'e': p.e, 'l': acc.l, 'o': acc.o}} END) AS f
  FROM {name}_runs),
{name}_spans AS (
  SELECT k, unnest(list_append(f.o, {{'a': f.l, 'b': f.e}})) AS span FROM {name}_folded),
{name}_pieces AS (
  SELECT k, row_number() OVER (PARTITION BY k ORDER BY span.a) - 1 AS chunk_index, chunk_text FROM (
    SELECT k, span, {strip('substr(content, span.a, span.b - span.a)')} AS chunk_text
    FROM {name}_spans JOIN {source} ON {key} = k)
  WHERE chunk_text <> ''),
{name} AS (
  SELECT substr(sha256(url || '::' || chunk_index), 1, 16) AS chunk_id, url,
         chunk_index::BIGINT AS chunk_index, chunk_text
  FROM {name}_pieces JOIN {source} ON {key} = k WHERE length(chunk_text) >= 50)"""


WORDS = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def words(x: str) -> str:
    return WORDS.format(x)


ORACLES = {
    "bronze_documents": f"""WITH {DOCS}
SELECT url, title, length(content)::BIGINT AS n_chars, md5(content) AS content_md5 FROM docs""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*)::BIGINT AS n_rows FROM {t}"
        for t in ("documents", "pages", "conversations", "events", "labels", "embeddings", "benchmark")
    ),
    "preview_rows": """SELECT doc_id, lang, source, n_chars FROM documents
ORDER BY n_chars, doc_id LIMIT 10""",
    "partitioned_table": "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'",
    "page_names": rf"""WITH c AS (SELECT page_id, url, {_canonical('url')} AS canonical FROM pages),
f AS (SELECT *, replace(canonical, '/', '__') || '.html' AS file_name FROM c)
SELECT page_id, canonical,
       regexp_replace(canonical, '\A([^/]+)/(en|fr|de|es)(/|\z)', '\1\3') AS canonical_no_locale,
       file_name,
       regexp_matches(url, '\.(html|htm|md)\z')::BIGINT AS url_names_a_page_file,
       regexp_matches(file_name, '\.(html|htm|md)\z')::BIGINT AS is_page_file,
       'https://' || replace(regexp_replace(file_name, '\.[^.]*\z', ''), '__', '/') AS rebuilt_url
FROM f""",
    "page_plain_text": f"""WITH {PLAIN_PAGES}
SELECT page_id, length(t)::BIGINT AS n_chars, md5(t) AS text_md5 FROM plain""",
    "page_markdown": f"""WITH {MARKDOWN_PAGES}
SELECT page_id, {title('content')} AS title, length(content)::BIGINT AS n_chars,
       md5(content) AS content_md5
FROM md WHERE regexp_matches(content, '[^{WS}]')""",
    "page_chunks": f"""WITH RECURSIVE {MARKDOWN_PAGES},
pages_md AS (SELECT * FROM md WHERE regexp_matches(content, '[^{WS}]')),
{recursive('pages_md', 'page_id', 'c')} SELECT {SHOWN} FROM c""",
    "chunk_recursive": f"WITH RECURSIVE {DOCS}, {recursive('docs', 'url', 'c')} SELECT {SHOWN} FROM c",
    "utf8_repaired": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "page_load_times": f"""WITH {MARKDOWN_PAGES}
SELECT url, md5(CASE WHEN length(content) > 0 THEN {title('content')} ELSE url END) AS title_md5, true AS loaded_now FROM md
WHERE regexp_matches(content, '[^{WS}]')""",
    "chunk_measured": rf"""WITH RECURSIVE {DOCS},
t AS (
  SELECT url, regexp_extract(content, '\A[ \t\n\r\f\v]*') AS lead, regexp_extract_all(content, '[^ \t\n\r\f\v]+[ \t\n\r\f\v]*') AS w FROM docs),
l AS (
  SELECT url, lead, w, len(w) AS n, list_transform(w, lambda x: CASE
    WHEN len(regexp_extract_all(x, '\n')) > 1 THEN 0 WHEN contains(x, chr(10)) THEN 1 WHEN regexp_matches(x, '[.!?][ \t\n\r\f\v]+\z') THEN 2 ELSE 3 END) AS lv
  FROM t WHERE len(w) > 0),
c AS (
  SELECT url, 0::BIGINT AS chunk_index, 0::BIGINT AS first, CASE WHEN n <= 64 THEN n
    ELSE list_aggregate([struct_pack(a := lv[i], b := -i) FOR i IN range(32, 65)], 'min').b * -1 END::BIGINT AS last FROM l
  UNION ALL
  SELECT url, chunk_index + 1, last - 8, CASE WHEN n - (last - 8) <= 64 THEN n
    ELSE list_aggregate([struct_pack(a := lv[i], b := -i) FOR i IN range(last - 8 + 32, last - 8 + 65)], 'min').b * -1 END::BIGINT
  FROM c JOIN l USING (url) WHERE last < n)
SELECT url, chunk_index, (last - first)::BIGINT AS n_tokens,
       md5(CASE WHEN first = 0 THEN lead ELSE '' END || array_to_string(w[first + 1 : last], '')) AS text_md5
FROM c JOIN l USING (url)""",
    "catalogue_table": f"""WITH {DOCS}, {windows('docs', 'chunks')},
t AS (
  SELECT '-' AS speaker, chunk_id, chunk_text FROM chunks
  UNION ALL SELECT role, substr(sha256('conversation/' || conv_id || '::' || turn), 1, 16), coalesce(text, '') FROM conversations)
SELECT speaker, count(*) AS n_rows, count(DISTINCT chunk_id) AS n_keys, sum(length(chunk_text))::BIGINT AS n_chars FROM t GROUP BY 1""",
    "chunk_sql_function": f"WITH RECURSIVE {DOCS}, {recursive('docs', 'url', 'c')} SELECT {SHOWN} FROM c",
    "chunk_fixed_window": f"WITH {DOCS}, {windows('docs', 'chunks')} SELECT {SHOWN} FROM chunks",
    "chunk_token_window": f"""WITH {DOCS},
t AS (SELECT url, list_filter(string_split_regex(content, '[{WS}]+'), lambda w: w <> '') AS tokens FROM docs),
s AS (SELECT url, tokens, unnest(generate_series(0, greatest(len(tokens) - 21, 0), 80)) AS st FROM t)
SELECT url, (st // 80)::BIGINT AS chunk_index,
       md5(array_to_string(tokens[st + 1 : st + 100], ' ')) AS text_md5 FROM s""",
    "chunk_sections_sized": f"""WITH RECURSIVE lines AS (
  SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM documents),
parts AS (
  SELECT doc_id, unnest(list_concat(
    ['# ' || source || chr(10) || '```' || chr(10) || '## ' || lang || chr(10) || '```' || chr(10) || '> ' || l[1]],
    list_transform(l[2:], lambda x: '## ' || x))) AS part,
    unnest(generate_series(0, len(l) - 1)) AS section, len(l) AS n
  FROM lines),
secs AS (
  SELECT doc_id, section, doc_id || '/' || section AS sid, 'doc' AS url,
         part || CASE WHEN section < n - 1 THEN chr(10) ELSE '' END AS content
  FROM parts),
{recursive('secs', 'sid', 'p')}
SELECT doc_id, section::BIGINT AS section,
       (row_number() OVER (PARTITION BY doc_id ORDER BY section, chunk_index) - 1)::BIGINT AS chunk_index, md5(chunk_text) AS text_md5
FROM p_pieces JOIN secs ON sid = k""",
    "chunk_sections": f"""WITH lines AS (
  SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM documents),
parts AS (
  SELECT doc_id, unnest(list_concat(
    ['# ' || source || chr(10) || '```' || chr(10) || '## ' || lang || chr(10) || '```' || chr(10) || '> ' || l[1]],
    list_transform(l[2:], lambda x: '## ' || x))) AS part,
    unnest(list_concat([source], l[2:])) AS heading,
    unnest(generate_series(0, len(l) - 1)) AS chunk_index
  FROM lines)
SELECT doc_id, chunk_index::BIGINT AS chunk_index, md5(heading) AS heading_md5,
       md5({strip('part')}) AS text_md5 FROM parts""",
    "chunk_duplicate_keys": f"""WITH {DOCS}, {windows('docs', 'chunks')},
k AS (SELECT chunk_id, count(*) AS copies FROM chunks GROUP BY 1)
SELECT sum(copies)::BIGINT AS n_rows, count(*)::BIGINT AS n_keys,
       count(*) FILTER (copies > 1)::BIGINT AS duplicate_keys FROM k""",
    "chunk_duplicate_texts": f"""WITH {DOCS}, {windows('docs', 'chunks')}
SELECT md5(chunk_text) AS text_md5, count(*)::BIGINT AS copies FROM chunks
GROUP BY 1 HAVING count(*) > 1""",
    "chunk_length_summary": f"""WITH {DOCS}, {windows('docs', 'chunks')},
n AS (SELECT length(chunk_text)::DOUBLE AS n FROM chunks)
SELECT count(*)::BIGINT AS n, round(avg(n), 6) AS mean, min(n) AS min,
       round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS p50,
       round(quantile_cont(n, 0.75), 6) AS p75, max(n) AS max FROM n""",
    "text_statistics": rf"""WITH m AS (
  SELECT lang, source, length(text) AS chars, {words('text')} AS w,
         greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS sentences FROM documents),
c AS (SELECT *, len(w) AS words, length(array_to_string(w, '')) AS letters FROM m)
SELECT lang, source, count(*)::BIGINT AS n, sum(words)::BIGINT AS words,
       sum(sentences)::BIGINT AS sentences,
       round(sum(letters)::DOUBLE / nullif(sum(words), 0), 6) AS letters_per_word,
       round(sum(words)::DOUBLE / sum(sentences), 6) AS words_per_sentence,
       round(avg(chars), 6) AS mean_chars, round(sum(chars)::DOUBLE / 4, 6) AS token_estimate
FROM c GROUP BY 1, 2""",
    "snapshot_diff": f"""WITH {SNAPSHOTS}
SELECT coalesce(o.chunk_id, n.chunk_id) AS chunk_id,
       CASE WHEN o.chunk_id IS NULL THEN 'insert' WHEN n.chunk_id IS NULL THEN 'delete'
            WHEN o.chunk_text <> n.chunk_text THEN 'update' ELSE 'same' END AS change_type
FROM old o FULL OUTER JOIN new n ON o.chunk_id = n.chunk_id""",
    "snapshot_apply": f"WITH {SNAPSHOTS} SELECT {SHOWN} FROM new",
    "change_feed": f"""WITH {SNAPSHOTS}
SELECT coalesce(o.chunk_id, n.chunk_id) AS chunk_id,
       CASE WHEN o.chunk_id IS NULL THEN 'insert' WHEN n.chunk_id IS NULL THEN 'delete' ELSE 'update' END AS change_type,
       md5(n.chunk_text) AS text_md5
FROM old o FULL OUTER JOIN new n ON o.chunk_id = n.chunk_id
WHERE o.chunk_text IS DISTINCT FROM n.chunk_text""",
    "index_reconcile": """WITH s AS (SELECT doc_id AS k FROM documents), i AS (SELECT vec_id AS k FROM embeddings)
SELECT (SELECT count(*) FROM s)::BIGINT AS source_rows, (SELECT count(*) FROM i)::BIGINT AS index_rows,
       ((SELECT count(*) FROM s) - (SELECT count(*) FROM i))::BIGINT AS row_gap,
       (SELECT count(DISTINCT k) FROM s WHERE k NOT IN (SELECT k FROM i))::BIGINT AS missing_in_index,
       (SELECT count(DISTINCT k) FROM i WHERE k NOT IN (SELECT k FROM s))::BIGINT AS orphans_in_index""",
    "last_message": """SELECT conv_id, turn, role, md5(text) AS question_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations)
WHERE r = 1""",
    "chat_question": "SELECT conv_id, turn, md5(text) AS question_md5 FROM conversations",
    "chat_answer": "SELECT conv_id, turn, md5(text) AS answer_md5 FROM conversations",
    "refusal_flags": """SELECT conv_id, turn, contains(lower(text), 'of the')::BIGINT AS refused
FROM conversations""",
    "injection_flags": r"""SELECT doc_id, regexp_matches(text, '(?i)ignore (all |any )?(the )?(previous|prior|above) instructions'
  || '|disregard (all |any )?(the )?(previous|prior|above)|you are now (a|an|the) |system prompt'
  || '|do not (tell|reveal|mention)|<\|[a-z_]+\|>|all rights reserved|api[_ -]?key|password')::BIGINT AS quarantined
FROM documents""",
    "golden_append": f"""WITH j AS (
  SELECT CASE WHEN length(text) > 0 THEN {title('text')} ELSE source END AS request,
         lang AS expected_response, quality = 1 AND toxic = 0 AS good
  FROM labels JOIN documents USING (doc_id)),
g AS (SELECT request, expected_response FROM j WHERE good)
SELECT * FROM g UNION ALL
SELECT request, min(expected_response) FROM j
WHERE NOT good AND request NOT IN (SELECT request FROM g) GROUP BY 1""",
    "traffic_sample": """SELECT event_id, event_type, value FROM events
WHERE ('0x' || substr(sha256(event_id::VARCHAR), 1, 8))::BIGINT < (0.1 * 4294967296)::BIGINT""",
    "sampled_keys": """SELECT event_id,
  substr(sha256('event/' || event_type || '::' || event_id), 1, 16) AS chunk_id FROM events""",
}
