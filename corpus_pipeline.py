"""A corpus pipeline over ``documents``: rules, near duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
reread as the next stage's docs.

Defined cases, as the operators state them: null and empty texts fail the quality
rules; very long texts are read whole; of equal texts, repeated rows and rows with
equal ids and texts one stays, that of the least doc_id, and rows with a null
doc_id come last; extra columns pass through every stage but the last, whatever
their names; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.llm import jaccard, mixing, packing, quality, secret_scan
from nephos.llm.common import table
from nephos.llm.queries import tokenizer_path
from nephos.session import drop_shared, write_shared

#: Share of the tokens that the mixture keeps after near duplicates are gone.
MIX_SHARE = 0.6


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned list keep."""
    return quality.keep_good(docs, quality.fit_rules(docs, table(spark, sf_dir, "labels")))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each similarity class."""
    return jaccard.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced, and n_chars to match."""
    clean = secret_scan.redact(docs, secret_scan.fit_thresholds(docs))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that token shares meet the targets."""
    return mixing.mix_documents(docs, mixing.TARGETS, MIX_SHARE, tokenizer=tokenizer_path("word_bpe_49k.json"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their bins, in the ids of op5's tokenizer."""
    return packing.pack_documents(docs, tokenizer=tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join),
    ("secret_scans", secret_scans),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

#: SQL cannot express signatures, raking and packing; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = before = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        after = write_shared(stage(spark, docs, sf_dir), name)
        if docs is not before:
            drop_shared(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
