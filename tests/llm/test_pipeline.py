from collections import Counter

import public_tokenizers as P
import pyarrow as pa

import corpus_pipeline
from readweave.llm.bpe import Codec
from readweave.llm.common import shared_dir

from .test_similar import brute_kept

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, held = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = shared_dir(spark)
        stage(spark, held[-1], SF).write.parquet(out)
        held.append(spark.read.parquet(out))
        if name != "encode":
            assert held[-1].columns == columns
    rows = [d.collect() for d in held]
    before, good, lined, near, mixed, encoded = rows
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    judged = [r.doc_id for r in before if r.doc_id in labels]
    assert sum((i in kept) == (labels[i] == 1) for i in judged) >= 0.95 * len(judged)
    assert len(lined) == len(good)
    text = {r.doc_id: r.text for r in good}
    assert all(r.n_chars == len(r.text) and set(r.text.split("\n")) <= set(text[r.doc_id].split("\n")) | {""} for r in lined)
    assert sorted(r.doc_id for r in near) == brute_kept([(r.doc_id, r.text) for r in lined])
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3 and {r.doc_id for r in mixed} <= {r.doc_id for r in near}
    codec = Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for r in encoded[:50]:
        own = next(x.text for x in near if x.doc_id == r.doc_id)
        assert r.ids == codec.encode(pa.array([own]))[0].tolist() and r.n_tokens == len(r.ids)
    assert Counter(r.doc_id for r in encoded) == Counter(r.doc_id for r in mixed)
