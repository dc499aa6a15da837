"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayscout.llm import (
    conversation_repair,
    conversation_trie,
    exact,
    hilbert,
    licenses,
    ngram_join,
    packing,
    pieces,
    pii,
    quality,
    token_counts,
    urls,
    winnow,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


#: (host + path, allow?)
URL_RULES = (
    ("com/", True),
    ("example.com/en/", False),
    ("www.example.com/en/", True),
    ("net/es/", False),
    ("net/fr/", False),
)


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(table(spark, folder, "pages"), URL_RULES)


_URL_RULES_SQL = ", ".join(
    f"('{r[: r.index('/')]}', '{r[r.index('/') :]}', '{'allow' if ok else 'block'}')" for r, ok in URL_RULES
)
ORACLES["op2_url_filter"] = f"""
WITH rest AS (
  SELECT page_id,
    CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS u FROM pages
), cut AS (
  SELECT page_id,
    translate(regexp_extract(u, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), rules(rule_host, rule_path, said) AS (VALUES {_URL_RULES_SQL}),
hits AS (
  SELECT page_id, rule_host || rule_path AS rule, said,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS n
  FROM cut JOIN rules
    ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
)
SELECT c.page_id, c.host, c.path, h.rule, coalesce(h.said, 'allow') AS verdict
FROM cut c LEFT JOIN hits h ON h.page_id = c.page_id AND h.n = 1
"""


@query
def op3_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, folder, "documents"))


ORACLES["op3_block_naming"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s
  FROM documents
), g AS (
  SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id,
    count(*) OVER (PARTITION BY s) AS group_size, sha256(s) AS text_sha256 FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@query
def op4_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.edited_fingerprints(table(spark, folder, "documents"))


@query
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


@query
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


_TEMPLATE_SQL = ", ".join(
    f"('{name}', {licenses.template_bigrams(text)!r})" for name, text in licenses.TEMPLATES.items()
)
ORACLES["op6_license_scan"] = f"""
WITH templates(license, grams) AS (VALUES {_TEMPLATE_SQL}),
lines AS (
  SELECT doc_id, p.i - 1 AS segment,
    trim(regexp_replace(lower(p.s), '[^a-z0-9]+', ' ', 'g')) AS s
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
    unnest(list_transform(parts, lambda x, i: {{'s': x, 'i': i}})) AS u(p)
), words AS (
  SELECT doc_id, segment, string_split(s, ' ') AS w FROM lines
  WHERE length(s) - length(replace(s, ' ', '')) BETWEEN 1 AND 40
), grams AS (
  SELECT doc_id, segment, list_transform(w[1:len(w) - 1], lambda x, i: x || ' ' || w[i + 1]) AS g FROM words
), bags AS (
  SELECT doc_id, segment, list_transform(g, lambda x, i:
    x || CASE WHEN len(list_filter(g[1:i - 1], lambda y: y = x)) > 0
      THEN '#' || len(list_filter(g[1:i - 1], lambda y: y = x)) ELSE '' END) AS b FROM grams
), scored AS (
  SELECT doc_id, segment, license,
    2.0::DOUBLE * len(list_intersect(b, grams)) / (len(b) + len(grams)) AS score
  FROM bags, templates
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, segment ORDER BY score DESC, license) AS n FROM scored
)
SELECT doc_id, CAST(segment AS INTEGER) AS segment, license, score FROM best WHERE n = 1 AND score >= 0.8
"""


@query
def op7_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert.document_shards(table(spark, folder, "documents"), 16)


@query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path(), 1024, 2)


@query
def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, folder, "documents"))


ORACLES["op9_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS hits
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * hits >= 75 * (p.n + q.n - hits)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON r.x = d.doc_id
"""


@query
def op10_sampled_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"), 1.0, 7)


@query
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_path(), 1024)


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, folder, "conversations"))
    return conversation_repair.repair_report(damaged, "copies")


#: unsigned CRC-32 of the ASCII text {0}, with the table of 256 entries crc_table.t
_CRC32_SQL = (
    "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,"
    " list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)),"
    " lambda h, b: xor(h >> 8, t[1 + (xor(h, b) & 255)])))"
)
_CRC_TABLE_SQL = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    [n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))) AS t
)"""
#: ways to a state by one row: (from state, letter, allowed if)
_WAYS = {
    0: [(0, "D", "TRUE")],
    1: [(1, "D", "TRUE"), (0, "K", "i = 's'")],
    2: [(2, "D", "TRUE")] + [(p, k, c) for p in (0, 1, 3) for k, c in (("K", "i = 'u'"), ("R", "TRUE"))],
    3: [(3, "D", "TRUE"), (2, "K", "i = 'a'"), (2, "R", "TRUE")],
}


def _least(ways: list[str]) -> str:
    return f"list_min([{', '.join(ways)}])"


def _row_sql(q: int) -> str:
    cost = {"D": "4", "K": "x", "R": "3 + x"}
    return _least(
        [
            f"CASE WHEN s{p} IS NOT NULL AND {ok}{'' if k == 'D' else ' AND NOT gone'}"
            f" THEN {{'c': s{p}.c + {cost[k]}, 'a': s{p}.a || '{k}'}} END"
            for p, k, ok in _WAYS[q]
        ]
    )


def _insert_sql(q: int) -> str:
    way = lambda p, n: f"CASE WHEN s{p} IS NOT NULL THEN {{'c': s{p}.c + {3 * n}, 'a': s{p}.a || '{'I' * n}'}} END"
    return _least({0: ["s0"], 1: ["s1"], 2: ["s2", way(0, 1), way(1, 1), way(3, 1)], 3: ["s3", way(2, 1), way(0, 2), way(1, 2)]}[q])


_STATES = range(4)
ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC_TABLE_SQL}, coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32_SQL.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS code
  FROM conversations, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded WHERE code <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    NOT regexp_matches(text, '[^ 	-
]') AS blank,
    NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut, substr(role, 1, 1) AS i
  FROM damaged
), rows_ AS (
  SELECT *, blank OR seen > 1 AS gone, CASE WHEN NOT blank AND seen = 1 AND cut THEN 3 ELSE 0 END AS x,
    lag(i) OVER (PARTITION BY conv_id ORDER BY n) || i AS pair FROM placed
), counts AS (
  SELECT conv_id, max(n) AS last,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen > 1) AS duplicate,
    count(*) FILTER (x > 0) AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR) AS s1,
    {{'c': 3::BIGINT, 'a': 'I'}} AS s2, {{'c': 6::BIGINT, 'a': 'II'}} AS s3 FROM ids
  UNION ALL
  SELECT conv_id, n, {", ".join(f"{_insert_sql(q)} AS s{q}" for q in _STATES)} FROM (
    SELECT w.conv_id, r.n, {", ".join(f"{_row_sql(q)} AS s{q}" for q in _STATES)}
    FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.n + 1)
), found AS (
  SELECT w.conv_id, list_min([s0, s3]) AS s FROM walk w JOIN counts k
    ON k.conv_id IS NOT DISTINCT FROM w.conv_id AND k.last = w.n
), letters AS (
  SELECT conv_id, generate_subscripts(string_split(s.a, ''), 1) AS p, unnest(string_split(s.a, '')) AS k
  FROM found
), edits AS (
  SELECT *, sum(CASE WHEN k = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY p) AS n,
    sum(CASE WHEN k = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY p) AS place
  FROM letters
), kept AS (
  SELECT e.conv_id, e.place, e.k, r.role, CASE WHEN e.k = 'I' THEN '' ELSE r.text END AS text,
    max(CASE WHEN e.k = 'K' AND r.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS with_s
  FROM edits e LEFT JOIN rows_ r ON e.k <> 'I' AND r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.n = e.n
  WHERE e.k <> 'D'
), repaired AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN k = 'K' THEN role WHEN (place - with_s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY place)) AS h FROM kept GROUP BY conv_id
)
SELECT i.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank,
  coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
  coalesce(f.s.c, 0) AS cost, coalesce(f.s.a, '') AS audit, coalesce(h.h, sha256('')) AS repaired_sha256
FROM ids i LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN repaired h ON h.conv_id IS NOT DISTINCT FROM i.conv_id
"""


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, folder, "conversations")).drop("ref_conv_id", "ref_turn")


ORACLES["op12_prefix_trie"] = rf"""
WITH {_CRC_TABLE_SQL}, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 20 AS base, {_CRC32_SQL.format("CAST(c.conv_id AS VARCHAR)")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns) c, crc_table
), sized AS (
  SELECT c.*, (SELECT count(*) FROM turns t WHERE t.conv_id = c.base AND t.n <= c.h) AS head FROM convs c
), rebuilt AS (
  SELECT c.conv_id, t.n AS depth, t.role, t.text FROM sized c JOIN turns t ON t.conv_id = c.base AND t.n <= c.h
  UNION ALL
  SELECT c.conv_id, c.head + t.n - c.h, t.role, t.text FROM sized c JOIN turns t ON t.conv_id = c.conv_id AND t.n > c.h
), paths AS (
  SELECT conv_id, depth, string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
      OVER (PARTITION BY conv_id ORDER BY depth) AS path,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM sized
), members AS (
  SELECT *, lag(path) OVER w AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM paths WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
  SELECT depth, path, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY depth, path
), childed AS (
  SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.parent = n.path) AS n_children FROM nodes n
)
SELECT v.conv_id, v.depth, any_value(p.conv_id) AS parent_conv_id, v.n_convs, v.n_children,
  count(*) FILTER (w.n_children = 0) AS n_leaves, CAST(sum((w.n_convs - 1) * w.words) AS BIGINT) AS saved_tokens,
  v.ends_sha256
FROM childed v JOIN childed w ON w.depth >= v.depth AND starts_with(w.path, v.path)
LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.path = v.parent
GROUP BY v.conv_id, v.depth, v.path, v.n_convs, v.n_children, v.ends_sha256
"""
