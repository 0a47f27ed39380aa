"""A training corpus from documents: quality rules, near-duplicates, benchmark decontamination, personal data, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, pii, quality_rules, simhash
from tidemark.llm.shared import read, session, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    session(spark)
    return quality_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    session(spark)
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words or more in benchmark windows go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in angle brackets; n_chars follows."""
    session(spark)
    return pii.masked(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, number of tokens, ids (little-endian unsigned 32 bit) and the digest of the decoded text."""
    session(spark)
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    done = bpe.tokenized(docs, bpe.default_path(), keep=keep)
    return done.select(*keep, (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("near-duplicates", deduplicate), ("decontamination", decontamination), ("personal data", personal_data), ("tokens", tokens)]
#: No SQL: fingerprints (XXH64), the trained model and the tokenizer are beyond it; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
