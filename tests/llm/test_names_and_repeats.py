"""Clashing names, nulls, repeats, a very long text and empty tables, for each operator that returns rows and each stage."""

from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from readweave.llm.bpe import bpe_decode, bpe_encode
from readweave.llm.lines import dedup_lines
from readweave.llm.mixing import mix, mix_rows
from readweave.llm.quality import learn_quality, score_quality
from readweave.llm.similar import drop_similar
from readweave.llm.simhash import drop_near_duplicates

SF = "/root/testdata/sf0.001"
PATH = P.path("byte_bpe_50k.tiktoken")
NAMES = ["my col", "my-col", "uid", "did", "_id", "_turns", "_matches", "_score", "row", "key", "mark", "n_lines", "n_removed", "turn", "gone", "a.b", "back`tick"]
LONG = "river stone over and under the hills " * 140_000  # 5 MB
WORD = "x" * 200_000
ROWS = [
    (1, "one alone here with its own words"), (1, "another text under the same identifier stays too"), (2, None), (3, ""), (None, "no id"), (None, "no id either"),
    (None, None), (7, LONG), (8, WORD), (9, "twice the very same row of words"), (9, "twice the very same row of words"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t, "en", None if k % 3 else "s", len(t or "")) for k, (i, t) in enumerate(ROWS)], "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(NAMES):
        df = df.withColumn(name, F.lit(f"v{k}"))
    return df.repartition(3).cache()


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def made(spark, df):
    p = P.PATTERN
    return {
        "bpe_encode": lambda: bpe_encode(df, PATH, p).drop("ids"),
        "bpe_decode": lambda: bpe_decode(bpe_encode(df, PATH, p), PATH, p).drop("ids", "decoded"),
        "score_quality": lambda: score_quality(df, learn_quality(df, labels(spark)), score="s c"),
        "dedup_lines": lambda: dedup_lines(df, n_lines="l i", n_removed="r m"),
        "drop_near_duplicates": lambda: drop_near_duplicates(df),
        "drop_similar": lambda: drop_similar(df),
        "mix_rows": lambda: mix_rows(df),
        **{name: (lambda f=f: f(spark, df, SF)) for name, f in corpus_pipeline.STAGES[:-1]},
    }


@pytest.mark.parametrize("name", ["bpe_encode", "bpe_decode", "score_quality", "dedup_lines", "drop_near_duplicates", "drop_similar", "mix_rows", "quality", "lines", "near", "mixing"])
def test_rows_and_columns_survive(spark, docs, name):
    out = made(spark, docs)[name]()
    extra = [c for c in out.columns if c not in docs.columns]
    assert [c for c in out.columns if c in docs.columns] == docs.columns and len(extra) <= 2
    rows = out.drop(*extra).collect()
    for r in rows:
        assert [r[docs.columns.index(n)] for n in NAMES] == [f"v{k}" for k in range(len(NAMES))]
    got = Counter((r.doc_id, len(r.text or "")) for r in rows)
    want = Counter((i, len(t or "")) for i, t in ROWS)
    if name in ("drop_near_duplicates", "drop_similar", "near"):
        # Texts without words are copies (2 stays, 3 goes); of equal rows one stays; rows without an identifier all stay.
        want -= Counter([(3, 0), (9, len(ROWS[-1][1]))])
        assert got == want
    elif name in ("mix_rows", "mixing"):
        turns = Counter()
        for r in mix(docs).collect():
            turns[r.doc_id, r.size] += r.turns
        assert Counter((r.doc_id, len((r.text or "").split())) for r in rows) == +turns
    elif name == "quality":
        assert set(got) <= set(want)
    elif name in ("dedup_lines", "lines"):
        assert sum(got.values()) == len(ROWS) and {i for i, _ in got} == {i for i, _ in ROWS}
    else:
        assert got == want


@pytest.mark.parametrize("name", ["bpe_encode", "bpe_decode", "score_quality", "dedup_lines", "drop_near_duplicates", "drop_similar", "mix_rows", "quality", "lines", "near", "mixing"])
def test_empty_tables(spark, docs, name):
    assert made(spark, docs.limit(0))[name]().count() == 0


def test_last_stage(spark, docs):
    out = corpus_pipeline.encode(spark, docs, SF)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids"] and out.count() == len(ROWS)
    assert corpus_pipeline.encode(spark, docs.limit(0), SF).count() == 0
