"""From raw documents to packed training sequences, stage by stage.

Every stage reads what the one before kept. The first four return the columns of documents, the last the
packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import decontaminate, line_dedup, packing, quality, simhash, tokens
from reelrank.llm.queries import word_tokenizer
from reelrank.session import materialize


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. A null text is judged as an empty one."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    return docs.where(quality.scorer(trees)(F.col("text")) >= quality.ACCEPT)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line equals or nearly equals; n_chars follows the text."""
    made = line_dedup.dedupe_lines(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return made


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of each group of near duplicates."""
    return simhash.keep_one(docs, simhash.WIDTH, simhash.BITS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, word_tokenizer(), tokens.WORDS, 1, packing.Capacity(tokens=4096))


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each),
    ("decontaminate", drop_benchmark),
    ("packing", pack),
]

#: Boosted trees, fingerprints and token ids have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stage's result stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
