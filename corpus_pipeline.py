"""The training-data pipeline: five stages from ``documents`` to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes every stage's result to the shared folder and reads it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook.llm import decontaminate, ngram_join, packing, quality, secret_scan
from slotbook.llm.common import bounded_batches, on_workers, redact, table, unused, written
from slotbook.llm.queries import PIECE_BPE, WORD_BPE

#: The columns that every stage but the last returns.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def prepared(spark: SparkSession) -> None:
    """Every stage's rows are whole texts, and its executors have run the stages before."""
    on_workers(spark)
    bounded_batches(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  Bands are fitted on all of them first; the
    measures are taken again rather than written beside the texts."""
    prepared(spark)
    q = unused(docs.columns, "quality")
    measured = quality.measured(docs, public_tokenizers.path(PIECE_BPE), out=q)
    bands = written(quality.fit_bands(written(measured.select(q), "quality"), out=q), "quality-bands")
    return quality.judge(measured, bands, out=q).filter("kept").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepared(spark)
    return ngram_join.keep_one(docs).select(*COLUMNS)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepared(spark)
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select(*COLUMNS)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced and the number of characters counted anew."""
    found = secret_scan.scan_secrets(docs, out="found")
    text = redact(F.coalesce("text", F.lit("")), F.col("found"), lambda _: F.lit("[SECRET]"))
    clean = found.withColumn("clean", F.when(F.size("found") > 0, text).otherwise(F.col("text")))
    return clean.select("doc_id", F.col("clean").alias("text"), "lang", "source", F.when(
        F.size("found") > 0, F.length("clean").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences, piece by piece."""
    prepared(spark)
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), with_ids=False)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", no_benchmark), ("secret scans", no_secrets), ("packing", packed)]

#: Token ids, fitted bands and the latent space have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
