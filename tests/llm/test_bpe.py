import base64
import hashlib

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from readweave.llm.bpe import Codec, bpe_decode, bpe_encode, bpe_round_trip

PATH = P.path("byte_bpe_50k.tiktoken")
CODEC = Codec(PATH, P.PATTERN)


def encode(texts):
    ids, ends = CODEC.encode(pa.array(texts, pa.string()))
    return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "a", "  a  b ", "\n\nThe  end.\n a", "it's we'll 'tis\t\tx", "aaaa" * 40, "é" * 90 + " ñandú", "x" * 3000, " " * 500 + "z", "a\x1c\x1cb \x1c 1\x85  x", "<|endoftext|> hi", "日本語 テキスト 🙂🙂", "\nfirst", " \nfirst", "first", "a \nfirst", "a first"]


def test_same_ids_as_the_library(library):
    for t, ids in zip(TEXTS, encode(TEXTS), strict=True):
        assert ids.tolist() == library.encode_ordinary(t), repr(t[:30])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab thé1'.s\n\t　漢") | st.characters(exclude_categories=["Cs"]), max_size=60), max_size=5))
def test_any_text(library, texts):
    for t, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(t)
        assert CODEC.decode(ids) == t.encode()


def test_rows_and_single_merge_agree():
    words = [w.encode() for w in ["thtionerst", "xx", "hello", "abcabcabcabc", "ondernd", "zzzzzzzzzzzzzzzz"]]
    rows = CODEC.merge_rows(words, 16)
    assert rows == [CODEC.merge_one(w).tobytes() for w in words]


def test_on_spark(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(99, None, None), (0, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe_round_trip(df, PATH, P.PATTERN).collect()))
    want = []
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    again = bpe_decode(bpe_encode(df, PATH, P.PATTERN), PATH, P.PATTERN)
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in again.collect()) == sorted((i, t or "") for i, t, _ in rows)
    assert bpe_encode(df.limit(0), PATH, P.PATTERN).count() == 0
