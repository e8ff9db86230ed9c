"""From raw documents to token ids: good, clean, different documents, one stage after the other."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bpe, decontaminate, lines, neardup, quality
from tallyloom.llm.frames import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that the quality classifier rejects; it learns from the labelled rows of `docs`."""
    return quality.good_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand on many sites."""
    return lines.line_dedup(docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold benchmark passages."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text: doc_id, n_tokens, token_ids."""
    ids = bpe.encoded(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return ids.selectExpr("doc_id", "cast(size(token_ids) as long) as n_tokens", "token_ids")


STAGES = [("quality classifier", keep_good), ("line dedup", cut_boilerplate), ("near duplicates", keep_one_copy),
          ("decontamination", drop_contaminated), ("byte-level BPE", encode)]

# The classifier and the tokenizer have no SQL; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
