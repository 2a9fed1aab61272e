"""Alignment against the libraries on whole texts and a plain search for overlaps."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from readweave.llm import alignment
from readweave.llm.alignment import Aligner, align_tokens, aligned, diagonal

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a\n", "\na", "The cat sat.\nIt ran, quickly; héllo wörld", "two  spaces and\n\nlines \n here\tx", "a\u00a0b \u00a0c \u3000d e\u2028f \u2029 g",
    "日本 語 text 中文\nかな", "a▁b", "<|endoftext|> <s> x </s> <unk>", "x\x00y \x01 z\r\nq;\r\n", "Ünï çødé naïve coöperate", "🙂 🙃x 👩‍👩‍👧 ok", "é é\né", "1 2 3\n4 55 666", "don't we'll I'm\n's 's", "́ a\ń",
]


def tokens(text):
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: bytes([b]) for c, b in alignment.byte_letters().items()}
    a, b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
    raw_a = [b"".join(back[c] for c in t.id_to_token(i)) for i in a]
    raw_b = [bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return a, b, raw_a, raw_b


def want(rows):
    held, counts = [], Counter()
    for i, text in rows:
        a, b, raw_a, raw_b = tokens(text) if text else ([], [], [], [])
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            held.append((i, 0, 0, "", None))
            continue
        ea, eb = np.cumsum(list(map(len, raw_a))).tolist(), np.cumsum(list(map(len, raw_b))).tolist()
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(ea[i] - len(raw_a[i]), eb[j] - len(raw_b[j])) < min(ea[i], eb[j])]
        counts.update(links)
        both, x, y, groups = sorted(set(ea) & set(eb)), 0, 0, []
        for e in both:
            p, q = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
            x, y = p, q
        held.append((i, len(a), len(b), ";".join(groups), links))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for i, na, nb, groups, links in held:
        sha = hashlib.sha256(groups.encode()).hexdigest() if links is not None else ""
        links = links or []
        out.append((i, na, nb, groups.count(";") + 1 if groups else 0, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()), key=str)


def test_same_as_the_libraries(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id here"), (3, "twice"), (3, "twice"), (90, "The cat sat. " * 40 + "\nend")]
    rows += [(100 + i, r.text) for i, r in enumerate(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect()) if len(r.text) < 3000]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_a int").repartition(4)
    expect = want(rows)
    assert rows_of(align_tokens(df, A, B)) == expect
    assert rows_of(align_tokens(df, A, B, most=10)) == expect
    assert align_tokens(df.limit(0), A, B).count() == 0 and aligned(df.limit(0), A, B).count() == 0


@pytest.mark.parametrize("most", [100, 3000])
def test_small_stores_and_streams(monkeypatch, most):
    monkeypatch.setattr(alignment, "STREAM", 20)
    small, whole = Aligner(A, B, most), Aligner(A, B)
    whole.cuts = False
    texts = [t or "" for t in TEXTS]
    for _ in range(2):
        for k in range(0, len(texts), 5):
            x = pa.array(texts[k : k + 5], pa.string())
            assert small.documents(x).equals(whole.documents(x))


def test_diagonal():
    r = np.random.default_rng(2)
    for _ in range(300):
        n = int(r.integers(1, 60))
        a, b = (sorted({*r.choice(n, int(r.integers(0, n + 1)), replace=False).tolist(), n}) for _ in range(2))
        if r.random() < 0.3:
            b = [*a[: len(a) // 2], *(x for x in b if x > a[len(a) // 2 - 1])] if len(a) > 1 else a
        x, y = diagonal(a, b)
        meet = sorted(set(a) & set(b))
        assert x.tolist() == [a.index(e) + 1 for e in meet] and y.tolist() == [b.index(e) + 1 for e in meet]


def test_long_texts():
    e = Aligner(A, B)
    out = e.documents(pa.array(["river stone over and under the hills " * 60_000, "x" * 100_000]))
    assert out.column("n_groups").to_pylist()[0] > 400_000 and out.column("n_links").to_pylist()[1] > 0
