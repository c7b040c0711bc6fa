"""The corpus pipeline: five stages of the training-text operators, one after the other.

Each stage works on all that its predecessor kept. The first four return the columns of
``documents``; the last returns pieces of packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import decontam, line_dedup, minhash, packing, toxicity
from curbflow.llm.shipping import ship
from curbflow.session import scratch_path

#: Similarity in percent from which documents are near copies.
NEAR_PERCENT = 80
TOKENIZER = "word_bpe_49k.json"


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    ship(spark)
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    (labels,) = _tables(spark, sf_dir, "labels")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those that lose all lines go."""
    ship(spark)
    done = line_dedup.deduplicate(docs, drop_emptied=True).drop("lines_removed")
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    ship(spark)
    gone = minhash.near_duplicates(docs, NEAR_PERCENT).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    (benchmark,) = _tables(spark, sf_dir, "benchmark")
    return decontam.decontaminate(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in windows: pieces with their document, place and ids."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# A trained classifier, hashed bands and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; each result is written and read again."""
    (docs,) = _tables(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
