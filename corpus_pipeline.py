"""Corpus pipeline: quality rules, toxicity, near-duplicates, privacy, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as
Parquet and rereads as the next stage's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm import pii, quality_rules, simhash, toxicity
from laminar.llm.common import configure, materialise, table
from laminar.llm.packing import CAPACITY
from laminar.llm.queries import packed_digest, vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    configure(spark)
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model).where("kept").select(*docs.columns)


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    configure(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.judge(docs, model).where("NOT is_toxic").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the group's id.

    Rows without an id belong to no group and stay. Several texts under one id are documents of
    their own: of a group's texts under its id the one with the least hash stays, and of repeated
    rows of that text one.
    """
    configure(spark)
    found = simhash.near_duplicates(docs, shingle=3, max_bits=3)
    first = found.where("id = component_id").groupBy("root").agg(F.min(F.struct("id", "text_hash")).alias("_first"))
    first = first.select(F.col("_first.id").alias("_first_id"), F.col("_first.text_hash").alias("_first_hash"))
    mark = "_".join(["hash", *docs.columns])             # a name that no column has
    hashed = docs.withColumn(mark, simhash.text_hash(F.col("text")))
    same = (F.col("doc_id") == F.col("_first_id")) & (F.col(mark) == F.col("_first_hash"))
    kept = hashed.join(first, same, "left_semi").dropDuplicates(["doc_id", mark])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are replaced; ``n_chars`` follows the text."""
    configure(spark)
    out = pii.sanitise(docs)
    size = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", size).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    configure(spark)
    return packed_digest(docs, vocabulary_path("word_bpe_49k.json"), CAPACITY)


STAGES = [("quality_rules", quality), ("toxicity", clean_of_toxicity), ("simhash", near_duplicates),
          ("pii", privacy), ("packing", packed)]

# The stages hold models and hashes that SQL cannot express; tests/llm compares run()
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
