"""From raw documents to packed training sequences: quality, exact copies, near copies, benchmark passages, packing.

Each stage takes the documents its predecessor kept and returns the documents it keeps, with their columns; the last returns
the pieces of the packed sequences. A stage's result is written as Parquet and read again before the next one runs, so a lost
executor costs at most the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.llm import decontaminate, exact_dedup, packing, quality, simhash_dedup
from propgraph.llm.common import free_name, read, stored
from propgraph.llm.queries import QUALITY_CUT, tokenizer_path

#: Near copies: fingerprints of three-word shingles that differ in three bits or fewer, as in ``op3_near_duplicates``.
NEAR_WORDS, NEAR_RADIUS = simhash_dedup.SHINGLE_WORDS, simhash_dedup.RADIUS


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    The model learns from the labels of the documents given. A null or empty text is scored like any other. Rows that repeat,
    rows without id and further columns stay as they are; no documents give none.
    """
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    free = free_name(docs, "_score")
    return quality.with_score(docs, model, free).where(F.col(free) >= QUALITY_CUT).select(*docs.columns)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id; see ``exact_dedup.drop_copies`` for nulls and repeated rows."""
    return exact_dedup.drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; see ``simhash_dedup.drop_near_copies``."""
    return simhash_dedup.drop_near_copies(docs, NEAR_WORDS, NEAR_RADIUS)


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like a benchmark item.

    Rows without id stay if their text is clean; they are judged apart, by the text alone.
    """
    benchmark = read(spark, sf_dir, "benchmark")
    found = stored(decontaminate.contaminated(docs, benchmark).select("doc_id").distinct(), "leaks")
    clean = docs.join(found.where("doc_id IS NOT NULL"), "doc_id", "left_anti").select(*docs.columns)
    if found.where("doc_id IS NULL").isEmpty():
        return clean
    # Only here are texts compared: rows without id take the hash of their text as an id.
    name = free_name(docs, "_text_hash")
    nameless = docs.where("doc_id IS NULL").withColumn(name, F.xxhash64("text"))
    hashed = nameless.select(F.col(name).alias("doc_id"), "text")
    bad = decontaminate.contaminated(hashed, benchmark).select(F.col("doc_id").alias(name)).distinct()
    named = clean.where("doc_id IS NOT NULL")
    return named.unionByName(nameless.join(bad, name, "left_anti").select(*docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents fill; see ``packing.pack``."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", no_exact_copies),
    ("near_dedup", no_near_copies),
    ("decontaminate", no_benchmark_passages),
    ("pack", packed),
]

# Fingerprints, trained rules and tokens are beyond SQL: the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
