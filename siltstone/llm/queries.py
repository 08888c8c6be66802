"""One query per operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

import html
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import (
    bpe_tree,
    conversation_trie,
    cross_polytope,
    embedding_dedup,
    language_id,
    license_scan,
    mixing,
    ngram_join,
    periodic_runs,
    recurrent_lm,
    suffix_dedup,
    token_counts,
    warc,
)
from siltstone.llm.common import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, sql: str | None = None):
    """Register a function of one table; rows come from all of it."""

    def register(build: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(configure(spark).read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_language_id", "documents")
def op1(documents: DataFrame) -> DataFrame:
    return language_id.identify(documents)


def _sql_string(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _warc_sql() -> str:
    """Patterns of its own: any tag told by its name, links from whole tags, references piece by piece."""
    hidden = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<noscript\b.*?</noscript\s*>"
    blocks = "address article aside blockquote br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul"
    block = rf"(?i)</?({blocks.replace(' ', '|')})\b[^>]*>"
    names = ", ".join(f"{_sql_string(n)}: {_sql_string(html.unescape(f'&{n};'))}" for n in sorted({*name2codepoint, "apos"}))
    code = "CASE WHEN r[2:2] IN ('x', 'X') THEN ('0x' || r[3:])::BIGINT ELSE r[2:]::BIGINT END"
    char = f"CASE WHEN r[1:1] <> '#' THEN (MAP {{{names}}})[r] WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr(({code})::INT) END"
    urn = "'<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>'"
    return rf"""
WITH base AS (
    SELECT page_id, url, html AS payload, md5('response|' || page_id || '|' || url) AS h FROM pages
), response AS (
    SELECT page_id, {urn} AS refers_to, url AS target_uri, payload, regexp_replace(payload, {_sql_string(hidden)}, ' ', 'g') AS seen FROM base
), parts AS (
    SELECT *, string_split(regexp_replace(regexp_replace(regexp_replace(seen, '[\x09-\x0D ]+', ' ', 'g'), {_sql_string(block)}, chr(10), 'g'),
        '<[!/?a-zA-Z][^>]*>', '', 'g'), '&') AS p FROM response
), pieces AS (
    SELECT *, list_transform(p[2:], lambda x: regexp_extract(x, '^(#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|[A-Za-z][A-Za-z0-9]{{1,15}});', 1)) AS refs FROM parts
), texts AS (
    SELECT *, p[1] || array_to_string(list_transform(list_zip(p[2:], list_transform(refs, lambda r: CASE WHEN r <> '' THEN {char} END), refs),
        lambda t: coalesce(t[2] || t[1][len(t[3]) + 2:], '&' || t[1])), '') AS t FROM pieces
), kinds AS (
    SELECT page_id, refers_to, target_uri, payload, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
        array_to_string(list_concat(
            ['http-header: HTTP/1.1 200 OK', 'http-header: Content-Type: text/html; charset=utf-8',
             'http-header: Content-Length: ' || octet_length(encode(payload))],
            list_transform(list_filter(regexp_extract_all(seen, '<[aA]\s[^>]*>'), lambda x: regexp_matches(x, '(?i)\shref\s*=')),
                lambda x: 'outlink: ' || trim(regexp_extract(x, '(?i)\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), chr(34) || chr(39)))),
        chr(13) || chr(10)) AS block
    FROM texts
    UNION ALL
    SELECT page_id, refers_to, target_uri, payload, 'conversion', 'text/plain; charset=utf-8',
        trim(regexp_replace(regexp_replace(t, ' *\n[ \n]*', chr(10), 'g'), '^\n+|\n+$', '', 'g')) FROM texts
), named AS (
    SELECT *, md5(record_type || '|' || refers_to) AS h FROM kinds
)
SELECT page_id, record_type, {urn} AS record_id, refers_to, target_uri, '2024-01-01T00:00:00Z' AS date, content_type, block,
    octet_length(encode(block)) AS content_length, 'sha256:' || sha256(block) AS block_digest,
    'sha256:' || sha256(payload) AS payload_digest
FROM named"""


@query("op2_warc_derivatives", "pages", _warc_sql())
def op2(pages: DataFrame) -> DataFrame:
    return warc.derive(warc.responses(pages))


# Sources above three times their size stop there, smallest limit per weight first: the
# shares of the others follow from the sums over the sources after a prefix.
MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        ('0x' || md5('mix:' || doc_id)[1:15])::BIGINT AS shuffle
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
    FROM sized GROUP BY source
), prefixes AS (
    SELECT *, sum(source_size) OVER () AS total,
        coalesce(sum(3 * source_size) OVER w, 0) AS filled, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS rest
    FROM sources
    WINDOW w AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT arg_min((total - filled)::BIGINT, 3 * source_size / weight) AS num, arg_min(rest::BIGINT, 3 * source_size / weight) AS den
    FROM prefixes WHERE 3 * source_size >= weight * (total - filled)::DOUBLE / rest::DOUBLE
), targets AS (
    SELECT source, source_size, least((3 * source_size)::DOUBLE, (weight * num)::DOUBLE / den::DOUBLE) AS target FROM sources, level
), laid AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY shuffle, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    (SELECT sum(greatest(0, least(start + e.range * source_size + size, floor(target)) - least(start + e.range * source_size, floor(target))))
     FROM range(3) e)::BIGINT AS taken
FROM laid"""


@query("op3_source_mix", "documents", MIX_SQL)
def op3(documents: DataFrame) -> DataFrame:
    return mixing.mix(documents)


@query("op4_cross_polytope_neighbours", "embeddings")
def op4(embeddings: DataFrame) -> DataFrame:
    return cross_polytope.neighbours(embeddings)


@query("op5_suffix_dedup", "documents")
def op5(documents: DataFrame) -> DataFrame:
    return suffix_dedup.dedup(documents)


@query("op6_bpe_round_trip", "documents")
def op6(documents: DataFrame) -> DataFrame:
    return bpe_tree.round_trip(documents)


@query("op7_license_scan", "documents")
def op7(documents: DataFrame) -> DataFrame:
    return license_scan.scan(documents)


EMBEDDING_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), found AS (
    SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
        least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id
    FROM embeddings e
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found"""


@query("op8_embedding_near_dedup", "embeddings", EMBEDDING_SQL)
def op8(embeddings: DataFrame) -> DataFrame:
    return embedding_dedup.dedup(embeddings)


@query("op9_token_counts", "documents")
def op9(documents: DataFrame) -> DataFrame:
    return token_counts.token_counts(documents)


NGRAM_SQL = r"""
WITH RECURSIVE parted AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g
    FROM parted
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT m.a, m.b, m.n = x.n AND m.n = y.n AS same FROM met m JOIN sizes x ON m.a = x.doc_id JOIN sizes y ON m.b = y.doc_id
    WHERE m.n / (x.n + y.n - m.n) >= 0.8
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), low AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
), counted AS (
    SELECT a, count(*) AS n, count(*) FILTER (WHERE same) AS n_same FROM links GROUP BY a
)
SELECT d.doc_id, least(d.doc_id, coalesce(low.b, d.doc_id)) AS class_id, coalesce(c.n, 0) AS n_links, 1 + coalesce(c.n_same, 0) AS n_copies,
    d.doc_id <= coalesce(low.b, d.doc_id) AS kept
FROM documents d LEFT JOIN low ON d.doc_id = low.a LEFT JOIN counted c ON d.doc_id = c.a"""


@query("op10_ngram_jaccard_join", "documents", NGRAM_SQL)
def op10(documents: DataFrame) -> DataFrame:
    return ngram_join.join(documents)


@query("op12_periodic_runs", "documents")
def op12(documents: DataFrame) -> DataFrame:
    return periodic_runs.collapse(documents, planted=True)


# The CRC-32 of the id in decimal, bit by bit.
TRIE_SQL = """
WITH turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, coalesce(role, '') AS r, coalesce(text, '') AS x
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT c, count(*) AS n, c - c % 5 AS base, xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
        lambda a, d: list_reduce(list_prepend(xor(a, d), range(8)),
            lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END))) % 9 AS h
    FROM turns GROUP BY c
), rebuilt AS (
    SELECT i.c, t.pos, t.r, t.x FROM ids i JOIN turns t ON t.c = i.base AND t.pos < i.h
    UNION ALL
    SELECT i.c, t.pos - i.h + least(i.h, coalesce(b.n, 0)), t.r, t.x
    FROM ids i JOIN turns t ON t.c = i.c AND t.pos >= i.h LEFT JOIN ids b ON b.c = i.base
), paths AS (
    SELECT c, pos + 1 AS depth, string_agg(md5(length(r) || ':' || r || x), '') OVER (PARTITION BY c ORDER BY pos) AS path, octet_length(encode(x)) AS size
    FROM rebuilt
    UNION ALL SELECT c, 0, '', 0 FROM ids
), ends AS (
    SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, arg_max(path, depth) AS path FROM paths GROUP BY c) GROUP BY path
), bare AS (
    SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM paths GROUP BY path, depth
), nodes AS (
    SELECT b.*, coalesce(n, 0) AS n_children, left(path, greatest(len(path) - 32, 0)) AS above
    FROM bare b LEFT JOIN (SELECT left(path, len(path) - 32) AS up, count(*) AS n FROM bare WHERE depth > 0 GROUP BY up) ON path = up
)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
    (SELECT count(*) FROM nodes u WHERE starts_with(u.path, v.path) AND u.n_children = 0) AS n_leaves,
    (SELECT sum((u.n_convs - 1) * u.size) FROM nodes u WHERE starts_with(u.path, v.path))::BIGINT AS saved_tokens,
    sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes v LEFT JOIN bare p ON v.depth > 0 AND p.path = v.above LEFT JOIN ends e ON e.path = v.path"""


@query("op11_conversation_trie", "conversations", TRIE_SQL)
def op11(conversations: DataFrame) -> DataFrame:
    return conversation_trie.prefix_trie(conversations, rebuild=True)


@query("op13_recurrent_lm", "documents")
def op13(documents: DataFrame) -> DataFrame:
    return recurrent_lm.score(documents)
