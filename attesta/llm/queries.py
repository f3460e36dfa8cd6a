"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import decontaminate, language, licenses, markov, minhash, mixing, neighbours, prefix_trie, secrets, substrings, suffixes, tokens, whitening
from attesta.llm.session import prepared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, table: str = "documents", sql: str | None = None):
    """Register a query over one table; others it reads from the folder itself."""
    def add(fn: Callable[[DataFrame, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(_table(prepared(spark), folder, table), folder)
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_secret_scan")
def op1(docs: DataFrame, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(docs, with_text=False))


@query("op2_token_counts")
def op2(docs: DataFrame, folder: str) -> DataFrame:
    return tokens.digest(tokens.count_tokens(docs))


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
occ AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT r, doc_id, w, unnest(range(1, CAST(len(w) - 11 AS BIGINT))) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT s, min(doc_id) AS first FROM occ GROUP BY s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM occ JOIN firsts USING (s) WHERE doc_id > first),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, CAST(len(w) + 1 AS BIGINT))) AS p FROM d),
kept AS (SELECT r, count(gone.p) AS n_removed, string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY p) AS kept FROM words LEFT JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""


@query("op3_substring_dedup", sql=OP3_SQL)
def op3(docs: DataFrame, folder: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(docs))


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
occ AS (SELECT r, doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT r, doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
firsts AS (SELECT s, min((doc_id, i)) AS first FROM occ GROUP BY s),
gone AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM occ JOIN firsts USING (s) WHERE (doc_id, i) > first),
runs AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM gone),
cuts AS (SELECT r, run, min(i) AS s, max(i) + 100 AS e FROM runs GROUP BY r, run),
parts AS (SELECT d.r, cuts.run, cuts.s, cuts.e, substr(d.h, 2 * coalesce(lag(cuts.e) OVER (PARTITION BY d.r ORDER BY cuts.run), 0) + 1, 2 * (cuts.s - coalesce(lag(cuts.e) OVER (PARTITION BY d.r ORDER BY cuts.run), 0))) AS part
          FROM d JOIN cuts ON d.r = cuts.r),
kept AS (SELECT r, count(*) AS n_spans, sum(e - s) AS n_removed, string_agg(part, '' ORDER BY run) AS head, max(e) AS tail FROM parts GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r
"""


@query("op4_suffix_dedup", sql=OP4_SQL)
def op4(docs: DataFrame, folder: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(docs))


@query("op5_minhash_dedup")
def op5(docs: DataFrame, folder: str) -> DataFrame:
    return minhash.near_duplicates(docs)


@query("op6_language_id")
def op6(docs: DataFrame, folder: str) -> DataFrame:
    return language.digest(language.classify(docs, language.train(docs)))


@query("op7_nearest_neighbours", table="embeddings")
def op7(vectors: DataFrame, folder: str) -> DataFrame:
    return neighbours.nearest(vectors, F.col("id") % 50 == 0)


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
      WHERE item_id IS NOT NULL AND text IS NOT NULL),
g AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS words
      FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM g),
occ AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM (SELECT r, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT occ.r, occ.i, occ.n, g.item FROM occ JOIN g ON occ.n = g.n AND occ.words = g.words),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""


@query("op8_decontamination", sql=OP8_SQL)
def op8(docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.digest(decontaminate.hit_words(docs, _table(docs.sparkSession, folder, "benchmark")))


OP9_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9) AS BIGINT) AS cell FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3.0::DOUBLE * sum(size) AS lim,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM d GROUP BY source),
-- share, cut what is above the limits, share the rest again among the others until none is above
rounds AS (SELECT 0 AS k, (SELECT CAST(sum(source_size) AS DOUBLE) / sum(w) FROM s) AS level
           UNION ALL
           SELECT k + 1, ((SELECT CAST(sum(source_size) AS DOUBLE) FROM s) - (SELECT coalesce(sum(lim), 0) FROM s WHERE lim < level * w)) / (SELECT sum(w) FROM s WHERE lim >= level * w)
           FROM rounds WHERE k < 200 AND EXISTS (SELECT 1 FROM s WHERE lim >= level * w)),
final AS (SELECT level FROM rounds ORDER BY k DESC LIMIT 1),
t AS (SELECT source, source_size, least(lim, level * w) AS target FROM s, final),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM t),
c AS (SELECT source, cell, sum(n) OVER (PARTITION BY source ORDER BY cell) AS upto, n FROM (SELECT source, cell, sum(size) AS n FROM d GROUP BY source, cell)),
edge AS (SELECT e.source, e.source_size, e.target, e.times, e.target - e.times * e.source_size AS rest, min(CASE WHEN c.upto >= e.target - e.times * e.source_size THEN c.cell END) AS cell
         FROM e JOIN c ON e.source IS NOT DISTINCT FROM c.source GROUP BY ALL),
below AS (SELECT edge.*, CASE WHEN rest <= 0 THEN 0 WHEN edge.cell IS NULL THEN 68719476736 WHEN c.upto - rest <= rest - (c.upto - c.n) THEN edge.cell + 1 ELSE edge.cell END AS below
          FROM edge LEFT JOIN c ON edge.source IS NOT DISTINCT FROM c.source AND edge.cell = c.cell)
SELECT d.doc_id, d.size, b.source_size, b.target, CAST(d.size * (b.times + CASE WHEN d.cell < b.below THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN below b ON d.source IS NOT DISTINCT FROM b.source
"""


@query("op9_source_mix", sql=OP9_SQL)
def op9(docs: DataFrame, folder: str) -> DataFrame:
    return mixing.digest(mixing.mix(docs))


@query("op10_license_scan")
def op10(docs: DataFrame, folder: str) -> DataFrame:
    return licenses.digest(licenses.scan_licenses(docs))


@query("op11_hmm_scores")
def op11(docs: DataFrame, folder: str) -> DataFrame:
    return markov.score_texts(docs)


@query("op12_embedding_whitening", table="embeddings")
def op12(vectors: DataFrame, folder: str) -> DataFrame:
    return whitening.whiten(vectors, whitening.fit_whitening(vectors))


OP13_SQL = r"""
WITH own AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS seq FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
-- crc32 of the decimal id: eight shifts for each byte
h AS (SELECT conv_id, seq, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
         lambda a, b: list_reduce(list_prepend(xor(a, b), [1::BIGINT, 1, 1, 1, 1, 1, 1, 1]), lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)), 4294967295::BIGINT) % 9 AS h FROM own),
built AS (SELECT h.conv_id, list_concat(coalesce(b.seq, [])[1:h.h], h.seq[h.h + 1:]) AS seq FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 5),
steps AS (SELECT conv_id, len(seq) AS n, seq, unnest(range(0, CAST(len(seq) + 1 AS BIGINT))) AS depth FROM built),
named AS (SELECT conv_id, n, depth, md5(CAST(seq[1:depth] AS VARCHAR)) AS path, CASE WHEN depth > 0 THEN md5(CAST(seq[1:depth - 1] AS VARCHAR)) END AS above,
                 CASE WHEN depth > 0 THEN strlen(seq[depth].text) ELSE 0 END AS size FROM steps),
node AS (SELECT path, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends FROM named GROUP BY path, depth),
kids AS (SELECT above AS path, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
-- the nodes above a node, itself among them, are those of its smallest member down to its depth
under AS (SELECT u.path, u.depth, sum(CASE WHEN kids.path IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((node.n_convs - 1) * node.size) AS saved
          FROM node JOIN named u ON u.conv_id = node.conv_id AND u.depth <= node.depth LEFT JOIN kids ON kids.path = node.path AND kids.depth = node.depth GROUP BY u.path, u.depth)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN under USING (path, depth) LEFT JOIN kids USING (path, depth) LEFT JOIN node p ON p.path = node.above AND p.depth = node.depth - 1
"""


@query("op13_conversation_trie", table="conversations", sql=OP13_SQL)
def op13(conversations: DataFrame, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(conversations)
