"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM d
), f AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    len(lines) AS n_lines, len(regexp_extract_all(text, '\p{{Lu}}')) AS capitals
  FROM w
), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w
), windows AS (
  SELECT doc_id, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS win
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), counted AS (
  SELECT doc_id, pos, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS twice FROM windows
), covered AS (
  SELECT doc_id, twice OR coalesce(lag(twice, 1) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS inside
  FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), repeats AS (
  SELECT doc_id, CAST(count(*) FILTER (WHERE inside) AS BIGINT) AS n FROM covered GROUP BY doc_id
), base AS (
  SELECT f.*, coalesce(repeats.n, 0) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(repeats.n, 0) > 50 * n_words AS base_failed
  FROM f LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * capitals > 3 * word_chars
    OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM base
"""

MIX_SOURCES = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS top
  FROM sums
), filled AS (
  SELECT *, coalesce(sum(top) OVER o, 0) AS used, coalesce(sum(weight) OVER u, 0) AS open,
    (SELECT sum(source_size) FROM sums) AS everything,
    row_number() OVER (ORDER BY top / weight, source NULLS LAST) AS place
  FROM weighed WINDOW o AS (ORDER BY top / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    u AS (ORDER BY top / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT arg_min((1.5::DOUBLE * everything - used::DOUBLE) / open::DOUBLE, place) AS level
  FROM filled WHERE (1.5::DOUBLE * everything - used::DOUBLE) / open::DOUBLE <= top / weight
), targets AS (
  SELECT source, source_size, least(top, weight * coalesce(level, 1e300)) AS target FROM weighed, level
), drawn AS (
  SELECT doc_id, source, size, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(text)), 1, 13)
    AS BIGINT)::DOUBLE / 4503599627370496::DOUBLE AS draw
  FROM d
), rates AS (
  SELECT doc_id, size, source_size, target, draw,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM drawn JOIN targets ON drawn.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
"""

LINE_DEDUP = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), counting AS (
  SELECT * FROM l WHERE regexp_matches(line, '{WORD}')
), windows AS (
  SELECT doc_id, pos AS first, lead(pos, 2) OVER o AS last,
    line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS win
  FROM counting WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, first, last FROM windows WHERE win IS NOT NULL
  WINDOW o AS (PARTITION BY win ORDER BY doc_id NULLS FIRST, first)
  QUALIFY NOT (doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER o AND first <= first_value(last) OVER o)
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM later
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id
), cuts AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM covered GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
  coalesce(cuts.n, 0) AS n_removed
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN cuts USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages
), same AS (
  SELECT *, bytes >= 1000 AND page_id IS DISTINCT FROM max(page_id) OVER (PARTITION BY digest) AS again,
    max(page_id) OVER (PARTITION BY digest) AS largest
  FROM p
)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN again AND largest IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN largest END AS refers_to
FROM same
"""

TOPK_SEARCH = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER o AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW o AS (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) QUALIFY row_number() OVER o <= 20
"""

_TAG = r"(?i)<(?:link|meta)\b[^>]*>"
_HREF = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
_TARGET = r"""(?i)\bcontent\s*=\s*(?:"[^"]*?url\s*=\s*''?([^"'']*)|''[^'']*?url\s*=\s*"?([^"'']*))"""
_SCHEME = "[A-Za-z][A-Za-z0-9+.-]*"


def _split(url: str) -> str:
    """SQL for host and path of a URL."""
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"
    capitals = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return (f"translate(regexp_extract({rest}, '^[^/?#]*'), {capitals}) AS host, "
            f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) AS path, "
            f"regexp_extract({rest}, '^[^/?#]*([^#]*)', 1) AS after, "
            f"lower(string_split({url}, '://')[1]) AS scheme")


_RULE = """CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END"""
_VERDICT = "CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END"
_NODE = "CASE WHEN host <> '' THEN scheme || '://' || host || CASE WHEN after = '' THEN '/' ELSE after END END"

URL_FILTERS = rf"""
WITH RECURSIVE p AS (
  SELECT page_id, coalesce(url, '') AS url, html, {_split("coalesce(url, '')")} FROM pages
), own AS (
  SELECT page_id, url, html, host, path, {_NODE} AS node, {_RULE} AS rule FROM p
), tags AS (
  SELECT url, node, unnest(regexp_extract_all(coalesce(html, ''), '{_TAG}')) AS tag FROM own
), named AS (
  SELECT url, node, trim(replace(regexp_extract(tag, '{_HREF}', 1) || regexp_extract(tag, '{_HREF}', 2)
    || regexp_extract(tag, '{_HREF}', 3), '&amp;', '&'), ' ') AS target
  FROM tags WHERE regexp_matches(tag, '(?i)\brel\s*=\s*["'']?canonical\b')
  UNION ALL
  SELECT url, node, trim(replace(regexp_extract(tag, '{_TARGET}', 1) || regexp_extract(tag, '{_TARGET}', 2), '&amp;', '&'), ' ')
  FROM tags WHERE regexp_matches(tag, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')
), whole AS (
  SELECT node, CASE
    WHEN target = '' OR starts_with(target, '#') THEN NULL
    WHEN regexp_matches(target, '^{_SCHEME}://') THEN target
    WHEN regexp_matches(target, '^{_SCHEME}:') THEN NULL
    WHEN starts_with(target, '//') THEN regexp_extract(url, '^({_SCHEME})://', 1) || ':' || target
    WHEN starts_with(target, '/') THEN regexp_extract(url, '^{_SCHEME}://[^/?#]*') || target
    WHEN starts_with(target, '?') THEN regexp_extract(url, '^[^?#]*') || target
    WHEN regexp_matches(url, '^{_SCHEME}://[^/?#]*/') THEN regexp_extract(url, '^({_SCHEME}://[^/?#]*(?:/[^?#]*/|/)?)', 1) || target
    ELSE regexp_extract(url, '^{_SCHEME}://[^/?#]*') || '/' || target END AS target
  FROM named
), ends AS (
  SELECT node AS a, {_split("target")} FROM whole WHERE target IS NOT NULL
), edges AS (
  SELECT a, {_NODE} AS b FROM ends WHERE a IS NOT NULL AND {_NODE} <> a
), both_ways AS (
  SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reach AS (
  SELECT a AS node, b AS other FROM both_ways
  UNION
  SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
), others AS (
  SELECT node, other, {_split("other")} FROM reach
), judged AS (
  SELECT node, {_RULE} AS rule FROM others
), blocked AS (
  SELECT node FROM judged GROUP BY node
  HAVING bool_or(({_VERDICT}) = 'block') AND NOT coalesce(bool_or(({_VERDICT}) = 'allow'), false)
)
SELECT page_id, host, path, rule,
  coalesce({_VERDICT}, CASE WHEN node IN (SELECT node FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM own
"""

# CRC-32 bit by bit, lowest bit of each byte first; the polynomial is a fixed value.
_CRC32 = """xor(4294967295, list_reduce(flatten(list_transform(range(octet_length(encode(seed))),
    lambda i: list_transform(range(8), lambda k: (('0x' || substr(hex(encode(seed)), 2 * i + 1, 2))::BIGINT >> k) & 1))),
    lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)), 4294967295))"""

SPELLING_VARIANTS = rf"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS seed, run, count(*) AS n FROM found WHERE length(run) >= 5 GROUP BY ALL
), seeded AS (
  SELECT run, n, {_CRC32} AS h FROM counted
), planted AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM seeded
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM planted WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gaps AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS pos FROM v
), shorter AS (
  SELECT word, pos, word[:pos - 1] || word[pos + 1:] AS rest FROM gaps
), near AS (
  SELECT a.word AS word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT a.word, a.rest FROM shorter a JOIN v ON v.word = a.rest
  UNION SELECT a.rest, a.word FROM shorter a JOIN v ON v.word = a.rest
), best AS (
  SELECT near.word, other, count(*) OVER (PARTITION BY near.word) AS n_near, o.n AS other_n
  FROM near JOIN v o ON o.word = other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) = 1
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
    CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS tail, form FROM formed
  UNION ALL
  SELECT chains.word, formed.word, formed.form FROM chains JOIN formed ON formed.word = chains.form
)
SELECT formed.word, n, CAST(n_near AS BIGINT) AS n_near, formed.form, form_n, chains.tail AS root
FROM formed JOIN chains ON chains.word = formed.word AND chains.form IS NULL
"""

_ITEM_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATE = rf"""
WITH d AS (
  SELECT doc_id, coalesce({_ITEM_WORDS}, []) AS words FROM documents
), items AS (
  SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark
), cut AS (
  SELECT item_id, words, least(10, len(words)) AS size, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS first
  FROM items WHERE len(words) > 0
), grams AS (
  SELECT DISTINCT item_id, size, array_to_string(words[first:first + size - 1], ' ') AS gram FROM cut
), sizes AS (
  SELECT DISTINCT size FROM grams
), windows AS (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS first FROM d, sizes WHERE len(words) >= size
), hits AS (
  SELECT doc_id, first, w.size, item_id
  FROM (SELECT doc_id, first, size, array_to_string(words[first:first + size - 1], ' ') AS gram FROM windows) w
  JOIN grams ON grams.size = w.size AND grams.gram = w.gram
), covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(first, first + size)) AS pos FROM hits) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(listed.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": QUALITY_RULES,
    "op2_mix_sources": MIX_SOURCES,
    "op4_line_dedup": LINE_DEDUP,
    "op7_warc": WARC,
    "op8_topk_search": TOPK_SEARCH,
    "op10_url_filters": URL_FILTERS,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_decontaminate": DECONTAMINATE,
}
