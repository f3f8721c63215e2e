"""A pipeline over documents: language, near duplicates, repeated passages, mixture, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import Store
from tollgate.llm.language import UNKNOWN, identify, learn
from tollgate.llm.mixing import mix
from tollgate.llm.packing import pack
from tollgate.llm.suffixes import remove_passages
from tollgate.llm.superminhash import near_duplicates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def like_documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which no learned language is recognised: null texts and those without a letter.

    The prototypes are learned from all documents that have text and lang. The column lang stays what
    it was, or becomes the predicted language where it was null.
    """
    judged = identify(docs, learn(docs), keep=COLUMNS)
    known = judged.where(F.col("lang_pred") != UNKNOWN)
    return like_documents(known.withColumn("lang", F.coalesce("lang", "lang_pred")))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest doc_id; rows without doc_id stay.

    Rows that share a doc_id are one document's and stay or go together.
    """
    groups = near_duplicates(docs, shingle=5, percent=80)
    gone = groups.where(~F.col("kept")).select("doc_id").distinct()
    return like_documents(docs.join(gone, "doc_id", "left_anti"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that also start earlier are cut out; n_chars follows.

    Documents of which nothing is left go; those that had no words before stay.
    """
    cut = remove_passages(docs, columns=("lang", "source", "n_chars"))
    changed = F.col("n_removed") > 0
    left = cut.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars").cast("long"))
    return like_documents(left.withColumn("n_chars", n_chars))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it: not at all, or one to three times.

    Rows that share a doc_id, or have none, are all taken as often as the most frequent of them.
    """
    taken = mix(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies"))
    taken = Store(spark, "mixture").keep(taken.where("_copies > 0"), "copies")
    copies = docs.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")))
    again = F.explode(F.array_repeat(F.lit(1), F.col("_copies")))
    return like_documents(copies.withColumn("_again", again))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens packed into sequences of at most 2048: one row per piece."""
    return pack(docs, TOKENIZER)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicate),
    ("passages", passages),
    ("mixture", mixture),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the table documents; each result is written and read by the next."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Hyperdimensional profiles, tokenizers and seeded rounding have no SQL form.
ORACLE_SQL = None
