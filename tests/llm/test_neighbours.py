import itertools
import re

import numpy as np
import pytest
import xxhash

from readweave.llm.ann import nearest
from readweave.llm.simhash import allocate, components, drop_near_duplicates, fingerprint, forest, group_bits, links, near_duplicates, variants


def brute_nearest(rows, every, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for i, q in ok:
        if i % every == 0:
            best = sorted(((-float(q @ x), j) for j, x in ok if j != i))[:k]
            out += [(i, r + 1, j) for r, (_, j) in enumerate(best)]
    return out


def vectors(kind, n, d=48):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((n, d))
    if kind == "clustered":
        x = rng.standard_normal((60, d))[rng.integers(0, 60, n)] + 0.4 * x
    if kind == "copies":
        x[::3] = x[5] + 0.05 * rng.standard_normal((len(x[::3]), d))
        x[1::7] = x[1]  # many equal vectors
    if kind.startswith("long"):  # clusters that are long or short as a whole
        return (rng.standard_normal((20, d)) * np.exp(float(kind[4:]) * rng.standard_normal(20))[:, None])[rng.integers(0, 20, n)] + 0.3 * x
    if kind == "tails":
        return rng.standard_t(2, (n, d))
    if kind == "shifted":
        return x + 1.5
    if kind != "clustered":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x * np.exp(rng.standard_normal(n))[:, None] if kind == "lognormal" else x


@pytest.mark.parametrize("kind,n", [("unit", 12_000), ("lognormal", 12_000), ("clustered", 12_000), ("copies", 6_000), ("long0.7", 6_000), ("long1.5", 6_000), ("tails", 6_000), ("shifted", 6_000)])
def test_recall_and_scores(spark, kind, n):
    """Held against brute force at the shipped parameters: unit vectors, spread norms, clusters, a third in one knot with many copies, clusters of spread norms, heavy tails, a shifted mean."""
    x = vectors(kind, n)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, score int").repartition(4)
    got = {}
    for r in nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, n, 20)) and all(sorted(r for r, _, _ in v) == list(range(1, 21)) for v in got.values())
    hits, rng = [], np.random.default_rng(1)
    for q in rng.choice(sorted(got), 250, replace=False).tolist():
        score = x @ x[q]
        want = set(np.lexsort((np.arange(n), -score))[:21].tolist()) - {q}
        own = sorted(got[q])
        assert [(s, -i) for _, i, s in own] == sorted(((s, -i) for _, i, s in own), reverse=True)
        assert all(s == pytest.approx(score[i], abs=1e-9) and i != q for _, i, s in own)
        hits.append(sum(i in want for _, i, _ in own) / 20)
    assert np.mean(hits) >= 0.9
    if kind == "copies":  # the query's copies come first, smallest identifiers first
        copies = [i for i in range(1, n, 7)]
        q = next(i for i in copies if i % 20 == 0)
        assert [i for _, i, _ in sorted(got[q])] == [i for i in copies if i != q][:20]


def test_most_frequent_dimension_and_repeated_queries(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (20, [2.0, 0.0]), (40, [1.0, 0.0])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    best = {}
    for r in got:
        best.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(best) == [20, 40] and sorted(best[40])[0] == (1, 20)
    assert all(i != q for q, v in best.items() for _, i in v) and all(len({r for r, _ in v}) == len(v) <= 20 for v in best.values())


def test_lists_dealt_into_blocks(spark, monkeypatch):
    """One list of many vectors, and many queries, go to several tasks; nothing is lost."""
    from readweave.llm import ann

    monkeypatch.setattr(ann, "BLOCK", 100)
    monkeypatch.setattr(ann, "ASKED", 7)
    x = vectors("unit", 900)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest(df, caught=1.0)
    want = set()
    for q in range(0, 900, 20):
        score = x @ x[q]
        score[q] = -9
        want |= {(q, int(i)) for i in np.argsort(-score)[:20]}
    assert {(r.query_id, r.vec_id) for r in got.collect()} == want


def test_small_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (20, [0.0, 2.0]), (21, [0.5, 0.5]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in nearest(df).collect())
    assert got == sorted(brute_nearest(rows, 20, 20))
    assert nearest(df.limit(0)).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, k):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, most):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= most:
            parent[root(i)] = root(j)
    out = {}
    for i in range(len(ids)):
        out.setdefault(root(i), []).append(ids[i])
    return {i: min(v) for v in out.values() for i in v}


def test_fingerprint_of_odd_texts():
    for t in ["", " \n\x0b", "One", "one TWO", "A b C d\x1cé É\x85x y", "x " * 999, "Ünï Köd 漢 字 " * 40]:
        for k in (3, 5):
            assert fingerprint(t.encode(), k) == brute_fingerprint(t, k)


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(60):
        base = list(rng.choice(words, 120))
        for _ in range(6):
            own = list(base)
            for _ in range(int(rng.integers(0, 3))):
                own[int(rng.integers(0, 120))] = str(rng.choice(words))
            texts.append(" ".join(own))
    texts += [None, "", " ", "short", "SHORT"]
    rows = [(i * 3, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(5)
    fps = [brute_fingerprint(t, 3) for _, t, _ in rows]
    for most in (3, 5):
        want = brute_components([r[0] for r in rows], fps, most)
        got = near_duplicates(df, 3, most).collect()
        assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {r[0]: f"{f:016x}" for r, f in zip(rows, fps, strict=True)}
    assert near_duplicates(df.limit(0)).count() == 0
    kept = drop_near_duplicates(df.unionByName(df.limit(9)), 3, 3)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components([r[0] for r in rows], fps, 3).values()))


def test_large_bucket(spark):
    """Thousands of fingerprints in one bucket are dealt into blocks and stay one component."""
    rng = np.random.default_rng(6)
    fp = {0x5A5A5A5A5A5A5A5A}
    while len(fp) < 3000:
        fp.add(next(iter(fp)) ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)))
    ids = np.array(sorted(fp), "u8").view("i8").tolist()
    df = spark.createDataFrame([(i, f) for i, f in enumerate(ids)], "first long, fp long")
    edges = links(df, [((1 << 22) - 1, 0), (((1 << 21) - 1) << 22, 1), (((1 << 21) - 1) << 43, 0)], 3)
    assert edges.count() < 60_000
    want = brute_components(list(range(len(ids))), np.array(ids, "i8").view("u8").tolist(), 3)
    roots = {r.node: r.root for r in components(edges).collect()}
    groups = {}
    for i, f in enumerate(ids):
        groups.setdefault(roots.get(f, f), []).append(i)
    assert {i: min(v) for v in groups.values() for i in v} == want


def test_allocation_and_variants():
    costs = [[0, 5, 50, 500, 5000], [0, 1, 2, 9, 99], [0, 5, 50, 500, 5000]]
    every = [t for t in itertools.product(range(-1, 4), repeat=3) if sum(x + 1 for x in t) == 4]
    got = allocate(costs, 3)
    assert tuple(got) in every and sum(c[t + 1] for c, t in zip(costs, got, strict=True)) == min(sum(c[t + 1] for c, t in zip(costs, x, strict=True)) for x in every)
    rng = np.random.default_rng(7)
    mask = 0x0F0F
    for t in range(4):
        for _ in range(50):
            a, b = (rng.integers(0, 1 << 16, 1).astype("u8") for _ in range(2))
            va, vb = (set(variants(x, mask, t)[1].tolist()) for x in (a, b))
            d = bin(int(a[0] ^ b[0]) & mask).count("1")
            assert bool(va & vb) or d > t
    g = group_bits(10, np.eye(64) * 5, 3)
    assert sorted(itertools.chain(*g)) == list(range(64)) and [len(x) for x in g] == [22, 21, 21]
    u, v = forest(np.array([1, 3, 7, 1 << 40, 5, 4], "u8"), np.array([0, 4, 6]), 1)
    assert len(u) == 3
