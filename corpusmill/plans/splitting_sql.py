"""SQL of the splitters, put together from common table expressions; the statements begin WITH RECURSIVE."""

from __future__ import annotations

from corpusmill.functions.text import KOREAN_SEPARATORS, SEPARATORS
from corpusmill.operators.recursive import OVERLAP, SIZE
from corpusmill.plans import inputs as i


def _list(separators: list[str]) -> str:
    return "[" + ", ".join("'" + s.replace("\n", "\\n") + "'" for s in separators).replace("'\\n\\n'", "chr(10) || chr(10)").replace("'\\n'", "chr(10)") + "]"


def is_korean(text: str) -> str:
    return f"(length(regexp_replace({text}, '[^가-힣]', '', 'g')) / greatest(length({text}), 1) > 0.1)"


def recursive(source: str, out: str, size: int = SIZE, overlap: int = OVERLAP) -> str:
    """CTEs that end in `out` (key, ord, chunk): the recursive splitter on `source` (key, text, korean); chunks go by ord.

    An item is a text and the separators left for it. Its pieces are short (to be merged with their short neighbours, a run), or
    long: these are items again, or whole chunks if no separator is left. A run's chunks are found one after the other:
    f is the first piece of a chunk, e the piece that doesn't fit it any more, c the lengths of the pieces summed up.
    """
    after = f"list_filter(range({{0}}, n), lambda x: c[x + 2] - c[{{1}} + 1] > {size})[1]"
    dropped = f"len(list_filter(range(f, e), lambda d: c[e + 1] - c[d + 1] > {overlap} OR (c[e + 2] - c[d + 1] > {size} AND c[e + 1] > c[d + 1])))"
    return f"""
{out}_it(key, ord, n_long, piece, kind, seps) AS (
  SELECT key, CAST([] AS BIGINT[]), CAST(0 AS BIGINT), text, 1, CASE WHEN korean THEN {_list(KOREAN_SEPARATORS)} ELSE {_list(SEPARATORS)} END FROM {source} WHERE text <> ''
  UNION ALL
  SELECT key, list_append(ord, x), n_long, piece, CASE WHEN length(piece) < {size} THEN 0 WHEN sep = '' OR len(rest) = 0 THEN 2 ELSE 1 END, rest FROM (
    SELECT key, ord, sep, rest, x, piece, count(*) FILTER (WHERE length(piece) >= {size}) OVER (PARTITION BY key, ord ORDER BY x) AS n_long FROM (
      SELECT key, ord, sep, rest, unnest(range(1, len(parts) + 1)) AS x, unnest(parts) AS piece FROM (
        SELECT key, ord, sep, list_slice(seps, pos + 1, len(seps)) AS rest, CASE WHEN sep = '' THEN string_split(piece, '') ELSE list_concat([string_split(piece, sep)[1]], list_transform(list_slice(string_split(piece, sep), 2, len(string_split(piece, sep))), lambda p: sep || p)) END AS parts FROM (
          SELECT *, seps[pos] AS sep FROM (SELECT *, list_position(list_transform(seps, lambda s: s = '' OR contains(piece, s)), true) AS pos FROM {out}_it WHERE kind = 1)
    ))) WHERE piece <> '')
), {out}_run AS (
  SELECT key, list_slice(ord, 1, len(ord) - 1) AS above, n_long, list(piece ORDER BY ord) AS p, min(ord) AS first, count(*) AS n FROM {out}_it WHERE kind = 0 GROUP BY ALL
), {out}_sum AS (
  SELECT *, list_transform(range(0, n + 1), lambda x: coalesce(list_sum(list_transform(list_slice(p, 1, x), lambda q: length(q))), 0)) AS c FROM {out}_run
), {out}_cut(key, above, n_long, first, p, c, n, f, e) AS (
  SELECT key, above, n_long, first, p, c, n, CAST(0 AS BIGINT), {after.format("0", "0")} FROM {out}_sum
  UNION ALL
  SELECT key, above, n_long, first, p, c, n, f, {after.format("e + 1", "f")} FROM (SELECT key, above, n_long, first, p, c, n, f + {dropped} AS f, e FROM {out}_cut WHERE e IS NOT NULL)
), {out} AS (
  SELECT key, list_append(first, f) AS ord, trim(array_to_string(list_slice(p, f + 1, coalesce(e, n)), ''), {i.SPACES}) AS chunk FROM {out}_cut WHERE trim(array_to_string(list_slice(p, f + 1, coalesce(e, n)), ''), {i.SPACES}) <> ''
  UNION ALL SELECT key, ord, piece FROM {out}_it WHERE kind = 2
)"""


TABLES = r"\|.+\|\n[\|\-\s:]+\|\n(?:\|.+\|\n)+"
FENCES = r"```[\s\S]*?```"
HEADER = r"^(#{1,6}\s+\S|\d+\.\s+\S|[A-Z][A-Z\s]{2,}:$|\d+\.\d+[\s.])"


def parts(source: str, out: str, pattern: str, kind: str) -> str:
    """CTE `out`: source (key, text) cut into matches of a pattern and the text between: key, part_index, content_type, text."""
    return rf"""
{out} AS (
  SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY o) - 1 AS INTEGER) AS part_index, content_type, text FROM (
    SELECT key, 2 * x AS o, 'text' AS content_type, trim(gap, {i.SPACES}) AS text FROM (SELECT key, unnest(string_split_regex(text, '{pattern}')) AS gap, generate_subscripts(string_split_regex(text, '{pattern}'), 1) AS x FROM {source})
    UNION ALL
    SELECT key, 2 * x + 1, '{kind}', trim(found, {i.SPACES}) FROM (SELECT key, unnest(regexp_extract_all(text, '{pattern}')) AS found, generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS x FROM {source})
  ) WHERE text <> '')"""


def sections(source: str, out: str) -> str:
    """CTE `out`: the sections of source (key, text): key, section_index, section_header, text."""
    return rf"""
{out} AS (
  SELECT key, CAST(k AS INTEGER) AS section_index, section_header, text FROM (
    SELECT key, k, trim(string_agg(line, chr(10) ORDER BY x), {i.SPACES}) AS text, CASE WHEN k = 0 THEN '' ELSE trim(arg_min(line, x), {i.SPACES}) END AS section_header FROM (
      SELECT *, sum(CASE WHEN regexp_matches(trim(line, {i.SPACES}), '{HEADER}') AND x > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY x) AS k FROM (
        SELECT key, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS x FROM {source})
    ) GROUP BY key, k
  ) WHERE length(text) >= 100)"""


#: The columns of chunks that the splitters set, as they are where none has.
BARE = "CAST(NULL AS VARCHAR) AS content_type, CAST(NULL AS INTEGER) AS part_index, CAST(NULL AS INTEGER) AS section_index, CAST(NULL AS VARCHAR) AS section_header, CAST(NULL AS VARCHAR) AS section_type"

T1 = f"""WITH RECURSIVE {i.PAGES}, fl AS (SELECT path, arg_min({is_korean('text')}, page_no) AS korean FROM pg GROUP BY 1),
src AS (SELECT doc_id AS key, text, korean FROM pg JOIN fl USING (path)), {recursive('src', 'ch')}
SELECT path, CAST(page_no AS INTEGER) AS page_no, chunk AS text, 'semantic' AS split_strategy, {BARE} FROM ch JOIN pg ON doc_id = key"""

T4 = f"""WITH RECURSIVE {i.DECORATED}, src AS (SELECT doc_id AS key, text FROM dp), {parts('src', 'pa', FENCES, 'code')},
gap AS (SELECT {{'d': key, 'i': part_index}} AS key, text, {is_korean('text')} AS korean FROM pa WHERE content_type = 'text'), {recursive('gap', 'ch')},
al AS (SELECT key.d AS doc_id, 'text' AS content_type, key.i AS part_index, chunk AS text FROM ch UNION ALL SELECT key, content_type, part_index, text FROM pa WHERE content_type = 'code')
SELECT path, CAST(page_no AS INTEGER) AS page_no, al.text, 'code_aware' AS split_strategy, content_type, part_index, CAST(NULL AS INTEGER) AS section_index, CAST(NULL AS VARCHAR) AS section_header, CAST(NULL AS VARCHAR) AS section_type FROM al JOIN dp USING (doc_id)"""

T5 = f"""WITH RECURSIVE {i.DECORATED}, src AS (SELECT doc_id AS key, text FROM dp), {parts('src', 'pa', TABLES, 'table')},
ps AS (SELECT {{'d': key, 'i': part_index}} AS key, text, content_type FROM pa), {sections('ps', 'se')},
sk AS (SELECT se.*, path, page_no FROM se JOIN dp ON doc_id = key.d), fl AS (SELECT path, arg_min({is_korean('text')}, [page_no, key.i, section_index]) AS korean FROM sk GROUP BY 1),
s2 AS (SELECT {{'d': key.d, 'i': key.i, 's': section_index}} AS key, text, korean FROM sk JOIN fl USING (path)), {recursive('s2', 'ch')}
SELECT path, CAST(page_no AS INTEGER) AS page_no, chunk AS text, 'section_aware' AS split_strategy, content_type, CAST(ch.key.i AS INTEGER) AS part_index, section_index, section_header, 'content' AS section_type
FROM ch JOIN sk ON ch.key.d = sk.key.d AND ch.key.i = sk.key.i AND ch.key.s = sk.section_index JOIN ps ON ps.key = sk.key"""


def by_strategy(pages: str, strategies: str, size: int = SIZE) -> str:
    """CTEs that end in `nu`: the chunks of `pages` (doc_id, path, page_no, text) by `strategies` (path, strategy), numbered."""
    return f"""
st AS (SELECT {pages}.*, strategy, split_part(strategy, ' ', 1) AS first, strategy LIKE '%semantic%' AS again FROM {pages} JOIN {strategies} USING (path)),
ts AS (SELECT doc_id AS key, text FROM st WHERE first = 'table_aware'), {parts('ts', 'tp', TABLES, 'table')},
cs AS (SELECT doc_id AS key, text FROM st WHERE first = 'code_aware'), {parts('cs', 'cp', FENCES, 'code')},
ss AS (SELECT doc_id AS key, text FROM st WHERE first = 'section_aware'), {sections('ss', 'sp')},
on1 AS (
  SELECT key AS doc_id, content_type, part_index, CAST(NULL AS INTEGER) AS section_index, NULL AS section_header, text FROM tp UNION ALL SELECT key, content_type, part_index, NULL, NULL, text FROM cp
  UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, st.text FROM st WHERE first IN ('table_aware', 'code_aware') AND doc_id NOT IN (FROM (SELECT key FROM tp UNION ALL SELECT key FROM cp))
  UNION ALL SELECT key, NULL, NULL, section_index, section_header, text FROM sp UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, text FROM st WHERE first LIKE 'semantic%'
), on2 AS (
  SELECT on1.*, path, page_no, first, again, coalesce(part_index, section_index, 0) AS at1, again OR (first = 'code_aware' AND coalesce(content_type = 'text', false)) AS cut FROM on1 JOIN st USING (doc_id)
), fl AS (SELECT path, arg_min({is_korean('text')}, [page_no, at1]) AS korean FROM on2 WHERE again GROUP BY 1),
rs AS (SELECT {{'d': doc_id, 'a': at1}} AS key, text, CASE WHEN first = 'code_aware' THEN {is_korean('text')} ELSE korean END AS korean FROM on2 LEFT JOIN fl USING (path) WHERE cut), {recursive('rs', 'ch', size)},
nu AS (
  SELECT doc_id, path, CAST(page_no AS INTEGER) AS page_no, text, CASE WHEN first LIKE 'semantic%' THEN 'semantic' ELSE first END AS split_strategy, content_type, part_index, section_index, section_header,
    CASE WHEN first = 'section_aware' THEN 'content' END AS section_type, row_number() OVER (PARTITION BY path ORDER BY page_no, at1, ord) - 1 AS chunk_index, count(*) OVER (PARTITION BY path) AS chunk_total FROM (
    SELECT doc_id, path, page_no, at1, ord, chunk AS text, first, content_type, part_index, section_index, section_header FROM on2 JOIN ch ON key.d = doc_id AND key.a = at1
    UNION ALL SELECT doc_id, path, page_no, at1, CAST([] AS BIGINT[]), text, first, content_type, part_index, section_index, section_header FROM on2 WHERE NOT cut))"""


NUMBERED = "path, page_no, text, split_strategy, content_type, part_index, section_index, section_header, section_type, chunk_index, chunk_total"
