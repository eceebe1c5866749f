"""The registered queries of this package: name -> (query over the driver tables, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe_automaton, decontamination, html_extract, lexical_search, licenses, prefix_trie, quality_rules, secret_scan, simhash,
    token_counts, token_files, toxicity, warc,
)
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_and_decode(table(spark, sf_dir, "documents"), TOKENIZER)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.stored(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


_TOKENS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
#: Counts agreeing words on every line of every pair, without seeds or hashes in the join.
DECONTAMINATION_SQL = f"""
WITH d AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS at
  FROM (SELECT DISTINCT doc_id, {_TOKENS} AS words FROM documents)
), i AS (
  SELECT item_id, len(words) AS item_words, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS at
  FROM (SELECT item_id, {_TOKENS} AS words FROM benchmark) WHERE len(words) > 0
), lines AS (
  SELECT doc_id, item_id, item_words, d.at - i.at AS start, list(i.at) AS places
  FROM d JOIN i USING (word) GROUP BY ALL HAVING count(*) >= least(5, item_words)
), scored AS (
  SELECT *, len(places) AS matched_words,
    list_reduce(list_transform(range(item_words), lambda k: {{'here': if(list_contains(places, k), 1, -4), 'best': 0}}),
      lambda a, x: {{'here': greatest(0, a.here + x.here), 'best': greatest(a.best, a.here + x.here)}}, {{'here': 0, 'best': 0}}).best AS stretch
  FROM lines
)
SELECT doc_id, item_id, CAST(arg_max(item_words, (matched_words, stretch, -start)) AS INT) AS item_words,
  CAST(max(matched_words) AS INT) AS matched_words, max(matched_words) / CAST(any_value(item_words) AS DOUBLE) AS similarity,
  CAST(arg_max(start, (matched_words, stretch, -start)) AS INT) AS start
FROM scored WHERE matched_words >= if(item_words < {decontamination.SPAN}, 1.0, {decontamination.LEAST_SHARE}) * item_words OR stretch >= {decontamination.LEAST_STRETCH}
GROUP BY doc_id, item_id"""

_SYMBOLS = " ".join(f"WHEN regexp_matches(core, '{pattern}') THEN '{symbols}'" for pattern, symbols in secret_scan.ENCODINGS)
_MATCHES = " UNION ALL ".join(
    "SELECT rid, {k} AS kind, regexp_extract_all(text, '{p}') AS hits, string_split_regex(text, '{p}') AS pieces FROM t".format(k=k, p=p.replace("'", "''"))
    for k, p in enumerate((secret_scan.ASSIGN, secret_scan.ACCESS, secret_scan.HEX, secret_scan.CANDIDATE))
)
_TAIL = "exp(-z * z / 2) / 2.5066282746310002 * u * (0.319381530 + u * (-0.356563782 + u * (1.781477937 + u * (-1.821255978 + u * 1.330274429))))"
#: The tests are written over rows of symbols instead of arrays.
SECRETS_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_MATCHES}),
e AS (SELECT rid, kind, unnest(hits) AS hit, unnest(pieces[1:len(hits)]) AS piece, generate_subscripts(hits, 1) AS n FROM m WHERE len(hits) > 0),
placed AS (
  SELECT rid, kind, hit, sum(length(piece) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY n) AS stop FROM e
), spans AS (SELECT rid, kind, hit, CAST(stop - length(hit) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed),
base AS (
  SELECT rid, kind, start, stop FROM spans
  WHERE kind < 3 AND (kind > 0 OR length(regexp_extract(hit, '{secret_scan.ASSIGN.replace("'", "''")}', 2)) >= 6)
), free AS (
  SELECT rid, start, stop, regexp_replace(hit, '[-_=]', '', 'g') AS core FROM spans s
  WHERE kind = 3 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = s.rid AND b.start < s.stop AND s.start < b.stop)
), fitting AS (
  SELECT *, CASE WHEN NOT regexp_matches(core, '[0-9]') OR NOT regexp_matches(core, '[A-Za-z]') THEN NULL {_SYMBOLS} END AS alphabet
  FROM free WHERE length(core) >= {secret_scan.LEAST_SYMBOLS}
), symbols AS (
  SELECT rid, start, stop, pos, CAST(instr(alphabet, core[pos]) AS DOUBLE) AS x, length(core) AS n, length(alphabet) AS size,
    CASE WHEN regexp_matches(core[pos], '[0-9]') THEN 0 WHEN regexp_matches(core[pos], '[A-Z]') THEN 1 WHEN regexp_matches(core[pos], '[a-z]') THEN 2 ELSE 3 END AS cls
  FROM (SELECT *, unnest(range(1, length(core) + 1)) AS pos FROM fitting WHERE alphabet IS NOT NULL)
), pairs AS (
  SELECT *, x - avg(x) OVER w AS c, lead(x) OVER o - avg(x) OVER w AS next, lead(cls) OVER o AS next_cls
  FROM symbols WINDOW w AS (PARTITION BY rid, start), o AS (PARTITION BY rid, start ORDER BY pos)
), squared AS (SELECT rid, start, sum(k * k) AS squares FROM (SELECT rid, start, x, count(*) AS k FROM symbols GROUP BY ALL) GROUP BY ALL),
sums AS (
  SELECT rid, start, stop, CAST(any_value(n) AS DOUBLE) AS n, CAST(any_value(size) AS DOUBLE) AS size, count(*) FILTER (next_cls <> cls) AS changes,
    greatest(-0.999, least(0.999, coalesce(sum(c * next) / nullif(sum(c * c), 0), 0.999))) AS r
  FROM pairs GROUP BY rid, start, stop
), tests AS (
  SELECT rid, start, stop, n,
    ((n * (n - 1) * 2 / size - (squares - n)) / sqrt(2 * n * (n - 1) * (2 / size) * (1 - 2 / size))
      + (changes - (n - 1) * q) / sqrt((n - 1) * q * (1 - q))
      + (0.5493061443340549 - abs(atanh(r))) * sqrt(n - 3)) / 1.7320508075688772 AS score
  FROM (SELECT *, CASE CAST(size AS INT) WHEN 16 THEN 0.234 WHEN 32 THEN 0.152 WHEN 36 THEN 0.2 ELSE 0.32 END AS q FROM sums) JOIN squared USING (rid, start)
), p AS (
  SELECT rid, start, stop, (CASE WHEN score >= 0 THEN tail ELSE 1 - tail END) * avg(n) OVER (PARTITION BY rid) / n AS v
  FROM (SELECT *, {_TAIL} AS tail FROM (SELECT *, abs(score) AS z, 1 / (1 + 0.2316419 * abs(score)) AS u FROM tests))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY v, start) AS k, count(*) OVER (PARTITION BY rid) AS family FROM p
), random AS (
  SELECT rid, 3 AS kind, start, stop FROM ranked
  QUALIFY k <= max(CASE WHEN v <= k * ({secret_scan.FALSE_DISCOVERY} / family) THEN k ELSE 0 END) OVER (PARTITION BY rid)
), marks AS (
  SELECT rid, kind, start, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop AS written
  FROM (SELECT * FROM base UNION ALL SELECT rid, kind, start, stop FROM random)
), lists AS (
  SELECT rid, string_agg(written, ',' ORDER BY start, kind) AS spans, string_agg(written, ',' ORDER BY start, kind) FILTER (kind < 3) AS base_spans,
    {', '.join(f'count(*) FILTER (kind = {k}) AS n_{name}' for k, name in enumerate(secret_scan.KINDS))}
  FROM marks GROUP BY rid
)
SELECT doc_id, {', '.join(f'coalesce(n_{name}, 0) AS n_{name}' for name in secret_scan.KINDS)},
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN lists USING (rid)"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = rf"list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')"
#: Every document against every item by a join on terms, without index or heaps.
SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS words FROM documents),
q AS (SELECT DISTINCT item, item_id, unnest(words) AS term FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS words FROM benchmark)),
s AS (SELECT count(*) FILTER (len(words) > 0) AS docs, CAST(sum(len(words)) AS BIGINT) AS terms FROM d),
tf AS (SELECT rid, doc_id, n, term, count(*) AS times FROM (SELECT rid, doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM tf, s GROUP BY term),
scored AS (
  SELECT item, item_id, rid, doc_id, CAST(sum(weight * ((1000000000 * times) // (1000 * times + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY ALL
), placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {lexical_search.TOP}"""

#: CRC-32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, CAST(4294967295 AS BIGINT)))"""
#: Nodes by the digests of whole prefixes; subtrees by all pairs of a node and those above it.
TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, digest, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, length(coalesce(text, '')) AS size
    FROM conversations WHERE conv_id IS NOT NULL)
), c AS (SELECT conv_id, conv_id - conv_id % {prefix_trie.GROUP} AS base, {_CRC} % {prefix_trie.MOST_SHARED} AS taken FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT conv_id AS base, count(*) AS had FROM t GROUP BY 1),
r AS (
  SELECT c.conv_id, pos AS depth, digest, size FROM c JOIN t ON t.conv_id = c.base AND pos <= taken
  UNION ALL SELECT conv_id, pos - taken + least(taken, coalesce(had, 0)), digest, size FROM c JOIN t USING (conv_id) LEFT JOIN b USING (base) WHERE pos > taken
), p AS (SELECT conv_id, depth, size, md5(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM r),
l AS (
  SELECT *, coalesce(lag(node) OVER w, 'root') AS above, lead(node) OVER w IS NULL AS ends FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL, conv_id NOT IN (SELECT conv_id FROM p) FROM c
), n AS (
  SELECT node, depth, any_value(size) AS size, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM l GROUP BY node, depth
), k AS (SELECT above AS node, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY above),
s AS (
  SELECT u.node, CAST(sum((v.n_convs - 1) * v.size) AS BIGINT) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM n v LEFT JOIN k ON k.node = v.node JOIN l u ON u.conv_id = v.conv_id AND u.depth <= v.depth GROUP BY u.node
)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n LEFT JOIN n a ON a.node = n.above LEFT JOIN k ON k.node = n.node JOIN s ON s.node = n.node"""

QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_secret_scan": (op1_secret_scan, SECRETS_SQL),
    "op2_token_counts": (op2_token_counts, None),
    "op3_html_extract": (op3_html_extract, None),
    "op4_decontamination": (op4_decontamination, DECONTAMINATION_SQL),
    "op5_warc": (op5_warc, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_quality_rules": (op7_quality_rules, None),
    "op8_bpe_automaton": (op8_bpe_automaton, None),
    "op9_license_scan": (op9_license_scan, None),
    "op10_simhash_near_dedup": (op10_simhash_near_dedup, None),
    "op11_prefix_trie": (op11_prefix_trie, TRIE_SQL),
    "op12_lexical_search": (op12_lexical_search, SEARCH_SQL),
    "op13_token_files": (op13_token_files, None),
}
