"""The registered queries of these operators, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import table
from tollgate.llm.decontamination import contaminated
from tollgate.llm.language import identify, learn
from tollgate.llm.mixing import mix
from tollgate.llm.nndescent import nearest
from tollgate.llm.packing import pack
from tollgate.llm.phrases import collocations
from tollgate.llm.sharding import shard
from tollgate.llm.substrings import remove_repeats
from tollgate.llm.suffixes import passage_spans
from tollgate.llm.superminhash import near_duplicates
from tollgate.llm.tokenfiles import read_token_files, write_token_files
from tollgate.llm.topk import exact_top_k
from tollgate.llm.whitening import whiten
from tollgate.session import fresh_path


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_spans(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held_out)
    model = learn(docs.where(~F.col("held_out")))
    return identify(docs, model, keep=("doc_id", "held_out"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_nearest": op2_nearest,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_suffixes": op5_suffixes,
    "op6_token_files": op6_token_files,
    "op7_mixing": op7_mixing,
    "op8_substrings": op8_substrings,
    "op9_topk": op9_topk,
    "op10_language": op10_language,
    "op11_decontamination": op11_decontamination,
    "op12_whitening": op12_whitening,
    "op13_phrases": op13_phrases,
}

ORACLE: dict[str, str] = {
    "op9_topk": """
        WITH e AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM e q JOIN e c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op11_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS document, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), i AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), iw AS (
            SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS run
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p
                  FROM (SELECT *, least(len(w), 10) AS size FROM i WHERE len(w) > 0))
        ), dw AS (
            SELECT document, p, size, array_to_string(w[p:p + size - 1], ' ') AS run
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p
                  FROM d, (SELECT DISTINCT size FROM iw))
        ), hit AS (
            SELECT document, p, dw.size, item_id FROM dw JOIN iw ON dw.size = iw.size AND dw.run = iw.run
        ), covered AS (
            SELECT document, count(*) AS n_hit
            FROM (SELECT DISTINCT document, unnest(range(p, p + size)) AS at FROM hit) GROUP BY document
        ), held AS (
            SELECT document, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT document, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL)
            GROUP BY document
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (document) LEFT JOIN held USING (document)
    """,
    "op13_phrases": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), p AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t
        ), total AS (
            SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang
        ), g AS (
            SELECT lang, size, array_to_string(w[pos:pos + size - 1], ' ') AS phrase
            FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS pos
                  FROM p, (SELECT unnest([1, 2, 3]) AS size))
        ), f AS (
            SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY lang, size, phrase HAVING count(*) >= 10
        ), cut AS (
            SELECT c.lang, c.phrase, c.size, c.a, k, l.a AS l, r.a AS r,
                   CAST(1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a) AS BIGINT) AS score
            FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1) c
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
        ), low AS (
            SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_ AS (
            SELECT lang, phrase, max(a) AS longer
            FROM (SELECT lang, a, array_to_string(string_split(phrase, ' ')[pos:pos + 1], ' ') AS phrase
                  FROM (SELECT *, unnest([1, 2]) AS pos FROM f WHERE size = 3))
            GROUP BY lang, phrase
        ), kept AS (
            SELECT low.* FROM low LEFT JOIN inner_ USING (lang, phrase)
            WHERE longer IS NULL OR 100 * longer < 50 * a
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
}
