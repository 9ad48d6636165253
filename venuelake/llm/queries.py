"""Registered queries of the operators, with their parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelake.llm import (
    filter_audit, jaccard, language_model, licenses, line_dedup, mixing, near_vectors, packing, prefix_trie, quality, sharding,
    topk, toxicity,
)

QUERIES, ORACLES = {}, {}
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    documents, positions = mixing.mix(table(spark, folder, "documents"))
    first = positions.groupBy("row").agg(F.min("position").alias("first_position"))
    return documents.join(first, "row", "left").select(
        "doc_id", "size", "source_size", "target", "taken", "first_position"
    )


ORACLES["op10_mix_sources"] = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '')) AS key
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM d GROUP BY source
), w AS (
    SELECT *, 1 + place % 3 AS weight, 3 * source_size AS cap,
           sum(3 * source_size) OVER (ORDER BY 3 * source_size / (1 + place % 3), place) - 3 * source_size AS below,
           sum(1 + place % 3) OVER (ORDER BY 3 * source_size / (1 + place % 3) DESC, place DESC) AS open,
           sum(source_size) OVER () AS total
    FROM s
), level AS (
    SELECT min_by((total - below)::DOUBLE, cap / weight) AS rest, min_by(open::DOUBLE, cap / weight) AS open
    FROM w WHERE cap > weight * (total - below)::DOUBLE / open
), t AS (
    SELECT source, source_size, place,
           coalesce(least(cap::DOUBLE, weight * rest / level.open), cap::DOUBLE) AS target
    FROM w, level
), r AS (
    SELECT d.*, source_size, target, (place % 3 - 1) * 0.5::DOUBLE AS slope,
           CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
    SELECT *, CASE WHEN size = 0 THEN 0
              ELSE least(3, whole + (2 * before + size <= 2 * (target - whole * source_size))::INT) END::INT AS passes
    FROM r
), due AS (
    SELECT *, least(1.0::DOUBLE, (source_size * pass + before + size / 2::DOUBLE) / target) AS share
    FROM (SELECT *, unnest(range(passes)) AS pass FROM p)
), placed AS (
    SELECT doc_id, key, row_number() OVER (ORDER BY
        2 * share / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * share)), key, pass) - 1 AS position
    FROM due
), first AS (SELECT doc_id, min(position)::BIGINT AS first_position FROM placed GROUP BY doc_id)
SELECT p.doc_id, size, source_size, target, (size * passes)::BIGINT AS taken, first_position
FROM p LEFT JOIN first USING (doc_id)
"""


@query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    deduped = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return deduped.select("doc.doc_id", "n_lines", "n_removed", F.md5("doc.text").alias("text_md5"))


ORACLES["op4_line_dedup"] = r"""
WITH l AS (
    SELECT doc_id, unnest(generate_series(1, len(p))) AS no, unnest(p) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)
), f AS (
    SELECT doc_id, no, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
    FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), g AS (
    SELECT doc_id, list(line ORDER BY no) AS lines, list(no ORDER BY no) AS nos,
           list(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) ORDER BY no) AS words
    FROM f GROUP BY doc_id
), r AS (
    SELECT DISTINCT doc_id, a, b, list_slice(lines, a, b) AS run, list_slice(nos, a, b) AS nos
    FROM (
        SELECT *, list_slice(words, a, b) AS w FROM (
            SELECT *, unnest(generate_series(a, least(a + 49, len(lines)))) AS b
            FROM (SELECT *, unnest(generate_series(1, len(lines))) AS a FROM g)
        )
    )
    WHERE list_sum(w) >= 50 AND (coalesce(list_sum(w[2:]), 0) < 50 OR coalesce(list_sum(w[:-2]), 0) < 50)
), d AS (
    SELECT DISTINCT doc_id, unnest(nos) AS no
    FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, a) AS copy FROM r) WHERE copy > 1
), k AS (
    SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.no) AS text FROM l ANTI JOIN d USING (doc_id, no) GROUP BY ALL
)
SELECT t.doc_id, coalesce(len(g.lines), 0)::BIGINT AS n_lines,
       (SELECT count(*) FROM d WHERE d.doc_id = t.doc_id)::BIGINT AS n_removed,
       CASE WHEN t.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS text_md5
FROM documents t LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query
def op5_extendible_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents")).drop("row")


ORACLES["op5_extendible_shards"] = """
WITH d AS (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
           lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), 60, '0') AS bits
    FROM documents
), p AS (
    SELECT d.*, n, substr(bits, 1, n) AS shard FROM d, range(40) t(n)
), s AS (
    SELECT shard, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY shard
), f AS (
    SELECT p.*, shard_bytes, shard_rows, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS place
    FROM p JOIN s USING (shard) WHERE shard_bytes <= 2097152 OR shard_rows = 1
)
SELECT doc_id, bytes, shard, shard_bytes, shard_rows FROM f WHERE place = 1
"""


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))
    return scored.select("doc.doc_id", "held_out", "score", "predicted")


@query
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The table has no paths; each source is taken as a tree of folders of 1,000 and 100 documents."""
    docs = table(spark, folder, "documents")
    path = F.concat_ws("/", "source", F.expr("doc_id div 1000"), F.expr("doc_id div 100"), "doc_id")
    found = licenses.scan(docs.select("doc_id", "text", path.alias("path")), "path")
    return found.withColumnRenamed("id", "doc_id").withColumn("cosine", F.round("cosine", 6))


@query
def op6_suffix_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_documents(table(spark, folder, "documents"))


@query
def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), "vec_id % 20 = 0")


ORACLES["op3_exact_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, folder, "embeddings"))


@query
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link_documents(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations")).drop("enter")


ORACLES["op11_conversation_trie"] = r"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM t GROUP BY conv_id
), c AS (
    SELECT conv_id, turns, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, k:
            CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
    )) % 4 AS h FROM own
), r AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM c LEFT JOIN own b ON b.conv_id = c.base
), p AS (
    SELECT conv_id, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM r
), k AS (
    SELECT conv_id, size, depth, sha256(turns[:depth]::VARCHAR || depth) AS id,
           CASE WHEN depth > 0 THEN sha256(turns[:depth - 1]::VARCHAR || (depth - 1)) END AS parent,
           CASE WHEN depth > 0 THEN len(regexp_extract_all(turns[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
    FROM p
), n AS (
    SELECT id, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
    FROM k GROUP BY id, parent, depth
), kids AS (SELECT parent AS id, count(*) AS n_children FROM n GROUP BY parent
), below AS (
    SELECT a.id, sum((kids.id IS NULL)::BIGINT) AS n_leaves, sum(b.saved) AS saved_tokens
    FROM n a JOIN k ka ON ka.id = a.id AND ka.conv_id = a.conv_id
    JOIN k kb ON kb.depth >= a.depth JOIN n b ON b.id = kb.id AND b.conv_id = kb.conv_id
    JOIN k up ON up.conv_id = kb.conv_id AND up.depth = a.depth AND up.id = a.id
    LEFT JOIN kids ON kids.id = b.id
    GROUP BY a.id
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN n up ON up.id = n.parent LEFT JOIN kids ON kids.id = n.id JOIN below ON below.id = n.id
"""


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLES["op12_filter_audit"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), f AS (
    SELECT doc_id, part, {
        'A': len(words) < 100, 'B': 100 * len(list_distinct(words)) < 80 * len(words),
        'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
        'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)
    } AS fails FROM d
), l AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), m AS (
    SELECT part, [fails.A, fails.B, fails.C, fails.D, fails.E] AS fails, coalesce(good, false) AS good,
           coalesce(toxic, false) AS toxic
    FROM f LEFT JOIN l USING (doc_id)
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
           list_transform(string_split(filter_order[:step - 1], ''), lambda x: ascii(x) - 64) AS before
    FROM orders, range(1, 6) t(step)
), e AS (
    SELECT part, filter_order, step, letter, good, toxic, fails[ascii(letter) - 64] AS bad,
           step > 1 AND len(list_filter(before, lambda k: fails[k])) > 0 AS gone,
           len(list_filter(fails, lambda x: x)) AS n_bad
    FROM m, s
), g AS (
    SELECT part, filter_order, step::INT AS step, letter, count(*) FILTER (NOT gone AND NOT bad) AS kept,
           count(*) FILTER (NOT gone AND bad) AS removed, count(*) FILTER (gone AND bad) AS redundant,
           count(*) FILTER (bad AND n_bad = 1) AS unique_fails,
           count(*) FILTER (NOT gone AND bad AND good) AS good_lost, count(*) FILTER (NOT gone AND bad AND toxic) AS toxic_lost
    FROM e GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM g
"""


@query
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge_documents(table(spark, folder, "documents"))


ORACLES["op13_quality_rules"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
    SELECT row, k, count(*) OVER (PARTITION BY row, words[k:k + 2]) AS n
    FROM (SELECT row, words, unnest(generate_series(1, len(words) - 2)) AS k FROM d)
), r AS (
    SELECT row, count(DISTINCT k) AS n FROM (SELECT row, unnest([k, k + 1, k + 2]) AS k FROM w WHERE n > 1) GROUP BY row
), l AS (
    SELECT row, source, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
           regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
                          '[\x20\x09-\x0D]+', ' ', 'g').trim(' ') AS same
    FROM (SELECT row, source, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), h AS (SELECT source, count(*) AS n FROM d GROUP BY source
), b AS (
    SELECT source, same, true AS common FROM (SELECT source, same, count(DISTINCT row) AS n FROM l GROUP BY source, same) x
    WHERE n >= 5 AND 1000 * n >= 5 * (SELECT h.n FROM h WHERE h.source IS NOT DISTINCT FROM x.source)
), g AS (
    SELECT row, count(*) - count(DISTINCT line) AS n_dup, count(common) AS n_common,
           coalesce(sum(words) FILTER (common), 0) AS gone
    FROM l LEFT JOIN b ON l.same = b.same AND l.source IS NOT DISTINCT FROM b.source GROUP BY row
), j AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
           coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(n_common, 0)::BIGINT AS n_common_lines,
           (len(words) - coalesce(gone, 0))::BIGINT AS n_left_words
    FROM d LEFT JOIN r USING (row) LEFT JOIN g USING (row)
), v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM j)
SELECT *, NOT base_failed AND 100 * n_left_words >= 50 * n_words AS kept FROM v
"""
