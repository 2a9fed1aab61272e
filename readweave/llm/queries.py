"""The queries of the text operators, as the driver runs them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from readweave.registry import Registry

from .alignment import align_tokens
from .ann import nearest
from .benchmark import contamination
from .bpe import bpe_round_trip
from .common import shared_dir, table
from .exact import ORACLE as EXACT
from .exact import exact_dedup
from .lines import dedup_lines
from .mixing import mix
from .quality import judge_quality
from .simhash import near_duplicates
from .sstable import shard_digests, write_token_shards
from .tokens import count_tokens
from .urls import filter_urls, labelled_urls
from .whitening import whitened_rows

REGISTRY = Registry()


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every whole text by the ranks of byte_bpe_50k."""
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by the cube method to weights 1, 2, 3 of their sources."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "turns", "source")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal whole texts, by a stream with keyed state."""
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page's url."""
    return filter_urls(table(spark, sf_dir, "pages"), labelled_urls(spark))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text as the library for word_bpe_49k counts them."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ids in sorted-string-table shards and read them back."""
    shards = write_token_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, shared_dir(spark))
    return shard_digests(shards)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later repeated runs of lines."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learned outside the held-out third."""
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text inside windows of ten words of benchmark items."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the eight whitened components."""
    return whitened_rows(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every whole text."""
    return align_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


REGISTRY.add("op1_byte_bpe", op1_byte_bpe)
REGISTRY.add("op2_mix_sources", op2_mix_sources)
REGISTRY.add("op3_exact_dedup", op3_exact_dedup, EXACT)
REGISTRY.add("op4_url_filter", op4_url_filter)
REGISTRY.add("op5_token_counts", op5_token_counts)
REGISTRY.add("op6_token_shards", op6_token_shards)
REGISTRY.add("op7_line_dedup", op7_line_dedup)
REGISTRY.add("op8_quality", op8_quality)
REGISTRY.add("op9_nearest", op9_nearest)
REGISTRY.add("op10_simhash", op10_simhash)
REGISTRY.add("op11_decontaminate", op11_decontaminate)
REGISTRY.add("op12_whitening", op12_whitening)
REGISTRY.add("op13_alignment", op13_alignment)
REGISTRY.add("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
