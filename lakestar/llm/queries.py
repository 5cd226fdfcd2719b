"""The registered queries of the operators on documents, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import scratch_path
from .collision_search import EVERY, nearest_vectors
from .common import documents, labels
from .decontaminate import find_contamination
from .fingerprints import fingerprint
from .jaccard_join import jaccard_join
from .licenses import scan_licenses
from .packing import pack
from .prefix_trie import prefix_trie
from .quality import score_quality, train_quality
from .secrets import scan_secrets
from .sharding import SHARDS, SLOTS, assign_shards, fill_table
from .token_files import read_token_files, write_token_files
from .toxicity import score_toxicity, train_toxicity
from .vector_codes import compress_vectors

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(documents(spark, sf_dir), benchmark).drop("items")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_toxicity(docs, train_toxicity(docs, labels(spark, sf_dir)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_quality(docs, train_quality(docs, labels(spark, sf_dir)))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), BYTE_BPE)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, WORD_BPE, folds=True)
    return read_token_files(spark, path)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(documents(spark, sf_dir))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(embeddings(spark, sf_dir)).drop("label")


def op12_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_vectors(embeddings(spark, sf_dir), F.col("vec_id") % EVERY == 0)
    return found.select(F.col("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_licenses": op5_licenses,
    "op6_packing": op6_packing,
    "op7_sharding": op7_sharding,
    "op8_token_files": op8_token_files,
    "op9_fingerprints": op9_fingerprints,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_vector_codes": op11_vector_codes,
    "op12_collision_search": op12_collision_search,
    "op13_prefix_trie": op13_prefix_trie,
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

def _assigned(books: str) -> str:
    """(vec_id, part, entry, d): the nearest entry of each part."""
    return f"""(SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
        SELECT vec_id, part, entry, sum((x - v) * (x - v)) AS d FROM x JOIN {books} USING (part, pos)
        GROUP BY vec_id, part, entry) GROUP BY vec_id, part)"""


def _moved(books: str) -> str:
    return f"""(SELECT part, entry, pos, coalesce(m, v) AS v FROM {books} LEFT JOIN (
        SELECT part, entry, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m
        FROM {_assigned(books)} JOIN x USING (vec_id, part) GROUP BY part, entry, pos) USING (part, entry, pos))"""


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b:
        list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, z:
            CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384::BIGINT) ELSE y // 2 END)), 4294967295::BIGINT)"""

ORACLES = {
    "op1_decontaminate": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
        p AS (SELECT DISTINCT item, least(len(w), 10) AS m,
                     array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS k
              FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
        x AS (SELECT doc_id, s, m, array_to_string(w[s : s + m - 1], ' ') AS k
              FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s
                    FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
        h AS (SELECT doc_id, s, x.m, item FROM x JOIN p USING (k) WHERE x.m = p.m),
        n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
              FROM (SELECT doc_id, unnest(range(s, s + m)) AS pos FROM h) GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op7_sharding": f"""
        SELECT doc_id, slot, list_extract({fill_table(SHARDS, SLOTS)}::INTEGER[], (slot + 1)::INTEGER) AS shard
        FROM (SELECT doc_id, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT % {SLOTS} AS slot
              FROM documents)""",
    "op10_jaccard_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS k
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s AS a JOIN s AS b ON a.k = b.k AND a.doc_id <> b.doc_id
              GROUP BY a.doc_id, b.doc_id),
        e AS (SELECT x, y FROM c JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y
              WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
        r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least_id AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS least_id FROM r GROUP BY x) USING (doc_id)""",
    "op11_vector_codes": f"""
        WITH held AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings
                      WHERE embedding IS NOT NULL
                        AND coalesce(list_bool_and(list_transform(embedding, lambda e: coalesce(isfinite(e), false))), true)),
        x AS (SELECT vec_id, place, (i - 1) // (n // 16) AS part, (i - 1) % (n // 16) AS pos,
                     CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
              FROM (SELECT vec_id, place, embedding, len(embedding) AS n, unnest(range(1, len(embedding) + 1)) AS i FROM held)),
        b0 AS (SELECT part, place AS entry, pos, x AS v FROM x WHERE place < 64),
        b1 AS {_moved("b0")},
        b2 AS {_moved("b1")},
        a AS {_assigned("b2")},
        c AS (SELECT vec_id, string_agg(lpad(format('{{:x}}', entry), 2, '0'), '' ORDER BY part) AS code,
                     CAST(sum(d) AS BIGINT) AS error FROM a GROUP BY vec_id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b2) AS codebooks_sha256
        FROM c JOIN held USING (vec_id)""",
    "op13_prefix_trie": f"""
        WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                       PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
                   FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM o)),
        r AS (SELECT c.conv_id, pos, role, text FROM c JOIN o ON o.conv_id = c.base AND pos <= h
              UNION ALL
              SELECT c.conv_id, pos, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND pos > h),
        d AS (SELECT conv_id, row_number() OVER w AS depth, len(text) AS chars,
                     md5(string_agg(md5(len(role) || ':' || role || text), '') OVER w) AS k
              FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
        p AS (SELECT conv_id, 0 AS depth, 0 AS chars, '' AS k, CAST(NULL AS VARCHAR) AS up FROM c
              UNION ALL
              SELECT conv_id, depth, chars, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY depth), '') FROM d),
        n AS (SELECT k, any_value(up) AS up, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
                     (count(*) - 1) * any_value(chars) AS saved FROM p GROUP BY k),
        e AS (SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
              FROM (SELECT conv_id, arg_max(k, depth) AS k FROM p GROUP BY conv_id) GROUP BY k),
        s AS (SELECT p.k, sum(saved) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves
              FROM (SELECT conv_id, depth, saved, NOT EXISTS (SELECT 1 FROM n AS m WHERE m.up = n.k) AS leaf FROM n) AS q
              JOIN p ON p.conv_id = q.conv_id AND p.depth <= q.depth GROUP BY p.k),
        g AS (SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up)
        SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, n.n_convs,
               coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
               coalesce(ends, sha256('')) AS ends_sha256
        FROM n JOIN s USING (k) LEFT JOIN g USING (k) LEFT JOIN e USING (k) LEFT JOIN n AS parent ON parent.k = n.up""",
}
