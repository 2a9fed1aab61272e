"""A corpus pipeline out of five of the text operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again for the next one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readweave.llm.bpe import bpe_encode
from readweave.llm.common import fresh, shared_dir, table
from readweave.llm.lines import dedup_lines
from readweave.llm.mixing import mix_rows
from readweave.llm.quality import learn_quality, score_quality
from readweave.llm.similar import drop_similar


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts get the share of label 1 as their score; repeated rows are judged alike; all columns are kept.
    """
    score = fresh(docs, "score")
    scored = score_quality(docs, learn_quality(docs, table(spark, sf_dir, "labels")), score=score)
    return scored.where(F.col(score) >= 0.5).drop(score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines with 50 words or more go; n_chars, where there is such a column, follows the text.

    Null texts come out empty; rows that repeat identifier and text are one document; all rows and columns are kept.
    """
    counts = fresh(docs, "n_lines"), fresh(docs, "n_removed")
    out = dedup_lines(docs, n_lines=counts[0], n_removed=counts[1]).drop(*counts)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles with a Jaccard similarity of 0.8 or more).

    SimHash classes come first, each link decided by the exact similarity; bands find what lies further apart.
    Texts without words are copies of each other; rows without an identifier stay; rows that repeat one are documents of their own; all
    columns are kept.
    """
    return drop_similar(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null sources are a source of their own; rows that repeat an identifier are documents of their own; all columns are kept.
    """
    return mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the ids of byte-level BPE, a row for each row; null and empty texts have no ids."""
    out = bpe_encode(docs.select("doc_id", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("mixing", mixing), ("encode", encode)]

#: Several stages can't be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = f"{shared_dir(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
