"""A training-data pipeline over documents: five stages, each one operator of parchment.llm.

Every stage but the last returns the columns of documents, whatever else they hold.  run() writes each stage's
result to the shared folder and reads it again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.llm import decontaminate, language_id, minhash, packing, secrets
from parchment.llm.common import discard, final, fresh
from parchment.llm.entries import vocabulary
from parchment.session import ship


#: Share of the longest possible out-of-place distance beyond which a text is in none of the languages.
FAR = 0.99


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, which becomes their lang.  Those without letters go, and those that share next to
    no n-gram with any language's profile."""
    guess, score, distance = fresh(docs, "__lang"), fresh(docs, "__lang_score"), fresh(docs, "__lang_distance")
    named = language_id.identify(docs, language_id.learn_profiles(docs), lang_out=guess, score_out=score, distance_out=distance)
    return named.where((F.col(guess) != language_id.UNKNOWN) & (F.col(distance) <= FAR)).withColumn("lang", F.col(guess)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: of the least id and, where rows repeat it, the least row by digest.

    Rows without an id stay, one of each text.
    """
    keys = [fresh(docs, x) for x in ("__id", "__no_id", "__row")]
    named = [F.coalesce("doc_id", F.lit(0)).alias(keys[0]), F.col("doc_id").isNull().alias(keys[1])]
    kept = minhash.classified(docs.select("doc_id", "text")).where("first and class_id <=> doc_id").select(*named, F.col("h").alias(keys[2])).distinct()
    own = docs.select("*", *named, F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias(keys[2]))
    # rows that repeat an id and a text: one stays, whatever their other columns; the join needs no other exchange
    return own.dropDuplicates(keys).join(kept, keys, "left_semi").select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def secret_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind; n_chars follows the text."""
    masked = secrets.masked(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences: one row for each piece of a document."""
    return packing.pack(docs, *vocabulary())


STAGES = [("language_id", languages), ("minhash", near_duplicates), ("decontaminate", benchmark_leaks), ("secret_scan", secret_masks), ("packing", windows)]

#: Profiles, ProbMinHash, CGK embedding and BM25 packing have no SQL form; tests/llm checks the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage wrote is deleted when the next has read it."""
    ship(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = final(lambda docs=docs, stage=stage: stage(spark, docs, sf_dir), f"stage-{name}")
        discard(before)
        before = docs
    return docs
