"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.llm import audit, bpe, conversations, ctw, imatch, mixing, pii, quality, repeats, simhash, tokens, topk, urls
from harkline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_files(spark, sf):
    """Ids of every document, written to token files and read back."""
    return tokens.token_file_report(spark, table(spark, sf, "documents"), TOKENIZER, end_id=2)


@query
def op2_byte_bpe(spark, sf):
    """Tree-reduced BPE of every document, and the round trip."""
    return bpe.round_trip_report(table(spark, sf, "documents"), RANKS, public_tokenizers.PATTERN)


@query
def op6_personal_data(spark, sf):
    """Personal data in every document."""
    return pii.personal_data_report(table(spark, sf, "documents"))


@query
def op3_simhash(spark, sf):
    """Near-duplicate components of every document."""
    return simhash.near_duplicate_components(table(spark, sf, "documents"))


@query
def op5_quality(spark, sf):
    """Importance resampling of every document."""
    return quality.quality_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op7_mix(spark, sf):
    """Mix of all documents to target weights."""
    return mixing.mix_report(table(spark, sf, "documents"))


#: The rules of the query.
URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


@query
def op9_url_filter(spark, sf):
    """Verdict on every page."""
    return urls.judge(table(spark, sf, "pages"), URL_RULES)


_REST = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) END"


def _url_sql() -> str:
    """The same in SQL: components as the transitive closure of the edges."""

    def host(url):
        upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        return f"coalesce(translate(regexp_extract({_REST.format(url)}, '^[^/?#]*', 0), '{upper}', '{lower}'), '')"

    def path(url):
        return f"coalesce(regexp_extract({_REST.format(url)}, '^[^/?#]*([^?#]*)', 1), '')"

    def plain(url):
        query = f"regexp_extract({_REST.format(url)}, '^[^?#]*(\\?[^#]*)?', 1)"
        query = f"regexp_replace({query}, '([?&])(?:{urls.TRACKING})=[^&]*', '\\1', 'g')"
        query = f"regexp_replace(regexp_replace({query}, '&&+', '&', 'g'), '\\?&', '?', 'g')"
        query = f"regexp_replace({query}, '[?&]$', '')"
        trimmed = f"regexp_replace({path(url)}, '(/index\\.html?|\\.html?|/)$', '')"
        return f"CASE WHEN instr({url}, '://') > 0 THEN 'https://' || {host(url)} || {trimmed} || {query} END"

    ordered = sorted(URL_RULES, key=lambda r: (-len(r.host + r.path), r.action))
    fits = [f"(h = '{r.host}' OR ends_with(h, '.{r.host}')) AND starts_with(p, '{r.path}')" for r in ordered]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r.host}{r.path}'" for f, r in zip(fits, ordered)) + " END"
    action = "CASE " + " ".join(f"WHEN {f} THEN '{r.action}'" for f, r in zip(fits, ordered)) + " END"
    # whole links only: relative ones, `base` and character references are in the tests
    markup = "regexp_replace(coalesce(html, ''), '(?is)<!--.*?(-->|\\z)|<(script|style)\\b.*?(</(script|style)\\s*>|\\z)', ' ', 'g')"

    def linked(tag, mark, target):
        tags = f"regexp_extract_all({markup}, '(?is)<{tag}[^>]*>')"
        first = f"[x FOR x IN {tags} IF regexp_matches(x, '{mark}')][1]"
        return f"regexp_replace(regexp_extract(coalesce({first}, ''), '{target}', 1), '#.*', '')"

    link = linked("link", "(?is)\\srel\\s*=[^=]*\\bcanonical\\b", "(?is)\\shref\\s*=\\s*.?([^\"''\\s>]+)")
    refresh = linked("meta", "(?is)\\shttp-equiv\\s*=.?refresh", "(?is)\\burl\\s*=\\s*([^\"''\\s>]+)")
    return f"""
WITH RECURSIVE edge AS (
  SELECT url AS a, {plain("url")} AS b FROM pages
  UNION SELECT url, {link} FROM pages
  UNION SELECT url, {refresh} FROM pages
), known AS (SELECT a, b FROM edge WHERE instr(a, '://') > 0 AND instr(b, '://') > 0),
both_ways AS (SELECT a, b FROM known UNION SELECT b, a FROM known),
reach AS (
  SELECT a, a AS b FROM both_ways
  UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), node AS (SELECT DISTINCT a, {host("a")} AS h, {path("a")} AS p FROM both_ways),
acted AS (SELECT a, {action} AS action FROM node),
inherited AS (
  SELECT r.a, CASE WHEN count(*) FILTER (x.action = 'allow') > 0 THEN 'allow' ELSE 'block' END AS action
  FROM reach r JOIN acted x ON x.a = r.b AND x.action IS NOT NULL GROUP BY r.a
), page AS (SELECT page_id, url, {host("url")} AS h, {path("url")} AS p FROM pages)
SELECT page_id, h AS host, p AS path, {rule} AS rule,
  coalesce({action}, i.action, 'allow') AS verdict,
  CASE WHEN {action} IS NOT NULL THEN 'rule' WHEN i.action IS NOT NULL THEN 'alias' ELSE 'default' END AS "by"
FROM page LEFT JOIN inherited i ON i.a = page.url
"""


ORACLE["op9_url_filter"] = _url_sql()


@query
def op10_top_k(spark, sf):
    """Five nearest vectors of every query vector by inner product."""
    return topk.exact_top_k(table(spark, sf, "embeddings"), F.col("id") % 50 == 0, k=5)


ORACLE["op10_top_k"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS "rank", vec_id, score FROM ranked WHERE place <= 5
"""


@query
def op4_imatch(spark, sf):
    """I-Match fingerprints of every document and of its edited text."""
    return imatch.fingerprint_report(table(spark, sf, "documents"), distinct=True)


@query
def op8_language_model(spark, sf):
    """Context-tree and unigram scores of every document."""
    return ctw.score_documents(table(spark, sf, "documents"))


@query
def op11_filter_audit(spark, sf):
    """Five filters in all 120 orders, by part of the documents."""
    return audit.filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _audit_sql() -> str:
    """The same in SQL: the codes of the documents, met with every order and step."""
    words = "regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    fails = {f: f"CAST(substr(code, {i}, 1) AS INTEGER) = 1" for i, f in enumerate(audit.FILTERS, 1)}
    fails_mine = "CASE f " + " ".join(f"WHEN '{f}' THEN {c}" for f, c in fails.items()) + " END"
    earlier = " OR ".join(f"(strpos(filter_order, '{f}') < step AND {c})" for f, c in fails.items())
    others = " OR ".join(f"(f <> '{f}' AND {c})" for f, c in fails.items())
    return f"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), failed AS (
  SELECT doc_id, part,
    CAST(len({words}) < 200 AS INTEGER) || ''
    || CAST(100 * len(list_distinct({words})) < 50 * len({words}) AS INTEGER)
    || CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INTEGER)
    || CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
    || CAST(coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS INTEGER) AS code
  FROM doc
), mark AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS bad
  FROM labels GROUP BY doc_id
), cell AS (
  SELECT part, code, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad
  FROM failed LEFT JOIN mark USING (doc_id) GROUP BY part, code
), letter(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE length(a.f || b.f || c.f || d.f || e.f) = len(list_distinct([a.f, b.f, c.f, d.f, e.f]))
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f FROM orders, range(1, 6) AS r(step)
), met AS (
  SELECT part, filter_order, step, f, n, good, bad, {fails_mine} AS mine, {earlier} AS gone, {others} AS elsewhere
  FROM cell, steps
), told AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f,
    sum(CASE WHEN NOT mine AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mine AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mine AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mine AND NOT elsewhere THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mine AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mine AND NOT gone THEN bad ELSE 0 END) AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM told
"""


ORACLE["op11_filter_audit"] = _audit_sql()


@query
def op13_prefix_trie(spark, sf):
    """Trie of the first turns that rebuilt conversations share."""
    return conversations.prefix_trie(table(spark, sf, "conversations"))


#: CRC-32 of a short text: a step for each bit, with the byte's value at its first one.
_CRC_BITS = "flatten([[ascii(c), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split({0}, '')])"
_CRC = f"""xor(4294967295, list_reduce(list_prepend(4294967295, {_CRC_BITS}), lambda x, y:
  CASE WHEN xor(x, y) & 1 = 1 THEN xor(xor(x, y) >> 1, 3988292384) ELSE xor(x, y) >> 1 END))"""

ORACLE["op13_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id AS c, list(to_json([coalesce(role, ''), coalesce(text, '')])::VARCHAR ORDER BY turn NULLS FIRST, role, text) AS turns,
    list(strlen(coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS sizes
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (SELECT *, c - c % 5 AS base, {_CRC.format("c::VARCHAR")} % 9 AS h FROM own),
rebuilt AS (
  SELECT o.c, coalesce(b.turns, [])[1:o.h] || o.turns[o.h + 1:] AS turns, coalesce(b.sizes, [])[1:o.h] || o.sizes[o.h + 1:] AS sizes
  FROM headed o LEFT JOIN own b ON b.c = o.base
), prefix AS (
  SELECT c, depth, array_to_string(turns[1:depth], chr(10)) AS node, coalesce(sizes[depth], 0) AS size, depth = len(turns) AS last,
    CASE WHEN depth > 0 THEN array_to_string(turns[1:depth - 1], chr(10)) END AS above
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
), node AS (
  SELECT depth, node, any_value(above) AS above, min(c) AS owner, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM prefix GROUP BY depth, node
), child AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_node AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.owner AS parent
  FROM node n LEFT JOIN child c USING (depth, node) LEFT JOIN node p ON p.depth = n.depth - 1 AND p.node = n.above
), below AS (
  SELECT u.depth, u.node, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.size) AS saved_tokens
  FROM full_node v JOIN prefix u ON u.c = v.owner AND u.depth <= v.depth GROUP BY u.depth, u.node
)
SELECT owner AS conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM full_node JOIN below USING (depth, node)
"""


@query
def op12_repeats(spark, sf):
    """Passages of 100 bytes and more that stand earlier as well, removed from every document."""
    return repeats.repeat_report(table(spark, sf, "documents"))


#: Bytes as hexadecimal text, two characters each.
ORACLE["op12_repeats"] = """
WITH doc AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), window_at AS (
  SELECT k, i, md5_number(substr(h, 2 * i + 1, 200)) AS w
  FROM (SELECT k, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM doc)
), first_at AS (SELECT w, min((k, i)) AS f FROM window_at GROUP BY w HAVING count(*) > 1),
again AS (SELECT k, i FROM window_at JOIN first_at USING (w) WHERE (k, i) > f),
marked AS (SELECT k, i, CAST(coalesce(i > lag(i) OVER one + 100, true) AS INTEGER) AS opens FROM again WINDOW one AS (PARTITION BY k ORDER BY i)),
numbered AS (SELECT k, i, sum(opens) OVER (PARTITION BY k ORDER BY i) AS span FROM marked),
span AS (SELECT k, span, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY k, span),
gap AS (
  SELECT k, a, b, coalesce(lag(b) OVER one, 0) AS kept_from, lead(a) OVER one IS NULL AS final FROM span WINDOW one AS (PARTITION BY k ORDER BY a)
), cut AS (
  SELECT k, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)) || CASE WHEN final THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept
  FROM gap JOIN doc USING (k) GROUP BY k
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM doc LEFT JOIN cut USING (k)
"""
