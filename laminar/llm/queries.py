"""Registered queries of the text operators: each applies its operator, with production
parameters, to the whole table and derives the contract's columns from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm.common import configure, materialise, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file; the package is installed on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import packing
    configure(spark)
    return packed_digest(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), packing.CAPACITY)


def packed_digest(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    from laminar.llm import packing
    pieces = packing.tokenise(docs, vocabulary, capacity=capacity, end_id=0)
    digest = pieces.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(materialise(digest, "pack-pieces"), capacity)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import pii
    configure(spark)
    found = pii.find(table(spark, sf_dir, "documents"))
    base = {k: F.col(k) for k in pii.KINDS}
    return found.select(F.col("id").alias("doc_id"), *[F.size(k).cast("bigint").alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
                        pii.span_text(base | {"term": F.col("term")}).alias("spans"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import lm_scoring
    configure(spark)
    scored = lm_scoring.score(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))
    return scored.withColumnRenamed("id", "doc_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from laminar.llm import token_counts
    configure(spark)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.tiktoken"),
                                     public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import quality_rules
    configure(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    docs = docs.select("doc_id", "text")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, labels))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "score")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from laminar.llm import byte_bpe
    configure(spark)
    ranks = vocabulary_path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    digest = coded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    back = byte_bpe.decode(digest, ranks)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import simhash
    configure(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import toxicity
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import url_filters
    configure(spark)
    return url_filters.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import ann
    configure(spark)
    found = ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, top=5)
    return found.withColumnRenamed("id", "vec_id")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import decontamination
    configure(spark)
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import whitening
    configure(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.llm import filter_audit
    configure(spark)
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_pii": op2_pii,
        "op3_lm_scoring": op3_lm_scoring,
        "op4_token_counts": op4_token_counts,
        "op5_quality_rules": op5_quality_rules,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_simhash": op7_simhash,
        "op8_toxicity": op8_toxicity,
        "op9_url_filters": op9_url_filters,
        "op10_ann": op10_ann,
        "op11_decontamination": op11_decontamination,
        "op12_whitening": op12_whitening,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    from laminar.llm import decontamination, filter_audit
    return {"op11_decontamination": decontamination.ORACLE_SQL, "op13_filter_audit": filter_audit.ORACLE_SQL}
