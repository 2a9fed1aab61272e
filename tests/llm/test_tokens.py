import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from readweave.llm.common import Memo, shared_dir
from readweave.llm.sstable import Reader, read_token_shards, shard_digests, write_token_shards
from readweave.llm.tokens import Encoder, count_tokens

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["", " ", "The cat's  mat.\n\nIt's", "x <|endoftext|> y<|startoftext|>z", "é ́a 가", "a\x1cb\x85c d", "日本 123 4.5", "İstanbul ΟΔΟΣ Σ", "thtion " * 50, "Word, WORD. word., can't. The, A. <|ENDOFTEXT|>. x,y. I'LL."]


def want(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk,overlap", [(60_000, 300), (40, 8), (7, 2)])
def test_same_ids_as_the_library(chunk, overlap):
    long = ["word, " * 30 + "z" * 100 + " and\n" * 20, "q" * 200, ("abc  def\t<|endoftext|> ghi. " * 9).strip(), " " * 90 + "a"]
    texts = TEXTS + long
    ids, ends = Encoder(PATH, chunk, overlap).encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        assert ids[a:b].tolist() == want(t), repr(t[:40])


def test_counts(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(50, None, None), (0, "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, count_tokens(df, PATH, limit=60).collect()))
    assert got == sorted((i, len((t or "").encode()), len(want(t)), len(want(t)) > 60) for i, t, _ in rows)
    assert count_tokens(df.limit(0), PATH).count() == 0


def test_shards(spark):
    rows = [(i * 3 - 20, TEXTS[i % len(TEXTS)] + f" {i}") for i in range(300)] + [(None, "null id"), (7_000_000_000, None), (4, "twice"), (4, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = shared_dir(spark)
    shards = write_token_shards(df, PATH, 2, out, shards=3)
    assert shards.count() > 1
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expect = 0, []
    for i, t in order:
        ids = np.array([*want(t), 2], "<u4")
        expect.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(map(tuple, shard_digests(shards).collect()), key=key) == expect
    back = sorted(((r.doc_id, r.start, np.frombuffer(r.ids, "<u4")) for r in read_token_shards(spark, shards).collect()), key=key)
    assert [(i, s, len(x), zlib.crc32(x.tobytes())) for i, s, x in back] == expect
    paths = [r.path for r in shards.collect()]
    held = [Reader(p) for p in paths]
    assert sum(r.n_docs for r in held) == len(rows)
    for i, t in rows[::17] + rows[-4:]:
        found = [x.tolist() for r in held for x in r.get(i)]
        assert [*want(t), 2] in found and len(found) == sum(j == i for j, _ in rows)
    assert not any(r.get(99_999_999) for r in held)


def test_no_shards(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert shard_digests(write_token_shards(df, PATH, 2, shared_dir(spark))).count() == 0


def test_texts_without_spaces_stay_out_of_the_store():
    """Scripts without spaces make words of whole texts; the store keeps none of them and stays bounded by bytes."""
    e = Encoder(PATH)
    e.words.most = e.parts.most = 20_000
    for n in range(12):
        texts = [f"日本語{n}{k}の文章" * 30 for k in range(40)] + [f"w{n}x{k}. " * 3 for k in range(400)] + ["Éa, ÀB!! ÿ& 日 ss.日"]
        ids, ends = e.encode(pa.array(texts))
        for t, a, b in zip(texts[::57], ends[:-1][::57], ends[1:][::57], strict=True):
            assert ids[a:b].tolist() == want(t)
        for held in (e.words, e.parts):
            assert held.words.nbytes + held.flat.nbytes <= 20_000
            assert max(map(len, held.words.to_pylist()), default=0) <= 64


def test_memo_is_bounded_by_bytes():
    m = Memo(most=50_000)
    for n in range(40):
        todo = m.missing({f"k{n}_{k}" for k in range(50)} | {"long" * 500 + str(n)})
        m.add({k: b"x" * 8 for k in todo})
        assert len(m.new) + len(m.old) < 900 and sum(len(k) > 64 for k in [*m.new, *m.old]) <= 1


@pytest.mark.parametrize("size", [3_000_000])
def test_very_long_texts(size):
    one_word, many = "ab" * 40_000, ("thtion, ERE.\n" * (size // 13))
    ids, ends = Encoder(PATH).encode(pa.array([one_word, many]))
    assert ids[: ends[1]].tolist() == want(one_word)
    unit = want("thtion, ERE.\n")
    assert ids[ends[1] :].tolist() == unit * (size // 13)
