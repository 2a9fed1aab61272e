import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from readweave.llm import exact
from readweave.llm.common import shared_dir
from readweave.llm.exact import exact_dedup
from readweave.llm.mixing import fly, land, mix, mix_rows, targets

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "b "), (7, "a"), (7, "a"), (None, "n"), (9, "long " * 9000), (8, "long " * 9000), (None, "b")]


def brute(rows):
    texts = [t or "" for _, t in rows]
    out = []
    for i, t in zip([r[0] for r in rows], texts, strict=True):
        same = [j for j, _ in filter(lambda r: (r[1] or "") == t, rows)]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, weak):
    path = shared_dir(spark)
    spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, keep_id string").repartition(3).write.parquet(path)
    digest = {"digest": lambda t: F.length(t) % 2} if weak else {}
    got = exact_dedup(spark, path, **digest)
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_exact_when_every_digest_collides(spark, monkeypatch):
    """Digest and SHA-256 are the same for all texts: whole bytes alone tell them apart."""
    path = shared_dir(spark)
    rows = [(1, "aa"), (2, "aa"), (3, "bb"), (4, "cc"), (5, "cc"), (None, "bb"), (6, None), (7, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    monkeypatch.setattr(exact.F, "sha2", lambda c, n: F.lit("0" * 64))
    got = exact_dedup(spark, path + "/", digest=lambda t: F.length(t) % 1).collect()
    monkeypatch.undo()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == [x[:4] for x in brute(rows)]


def test_exact_of_one_file_and_a_hot_text(spark):
    path = shared_dir(spark)
    rows = [(i, "hot" if i % 3 else f"t{i % 60}") for i in range(900)] + [(i, "hot") for i in range(5)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(1).write.parquet(path)
    (name,) = [r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()]
    assert sorted(map(tuple, exact_dedup(spark, name).collect()), key=str) == brute(rows)


def test_state_holds_a_locator_and_goes_on(spark):
    path, at = shared_dir(spark), shared_dir(spark)
    spark.createDataFrame([(1, "a"), (3, "a"), (2, "b")], "doc_id long, text string").write.parquet(path)
    schema = spark.read.parquet(path).schema
    exact.digest_state(spark, path, schema, at, partitions=2)
    spark.createDataFrame([(9, "b"), (4, "c")], "doc_id long, text string").write.mode("append").parquet(path)
    state = exact.digest_state(spark, path, schema, at, partitions=2)
    rows = spark.read.parquet(path).select("doc_id", "text", *exact.locator())
    got = rows.join(state, ["file", "row"]).select("text", "keep_id", "n", (F.col("doc_id") == F.col("keep_id")).alias("same"))
    assert sorted(map(tuple, got.collect())) == [("a", 3, 2, True), ("b", 9, 2, True), ("c", 4, 1, True)]


def test_exact_of_nothing(spark):
    path = shared_dir(spark)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(path)
    assert exact_dedup(spark, path).count() == 0


def by_rounds(size, weight, most):
    """Targets by sharing the excess again and again."""
    full, left, target = set(), float(sum(size.values())), {}
    while True:
        open_ = [s for s in size if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * size[s]]
        if not above:
            return target | share
        for s in above:
            full.add(s)
            target[s] = most * size[s]
            left -= target[s]


@pytest.mark.parametrize("size", [{"a": 10, "b": 1, "c": 100, None: 5}, {"z": 7}, {"a": 1, "b": 1, "c": 1, "d": 1000, "é": 2}, {"a": 0, "b": 3}])
def test_targets(spark, size):
    rows = [(1, s, n) for s, n in size.items()]
    got = {r.source: r.target for r in targets(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()}
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = by_rounds(size, {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}, 3)
    assert got == pytest.approx(want)


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    size = rng.integers(0, 5000, 4000)
    p = np.full(4000, 0.37)
    out = fly(p, size, rng)
    assert ((out > 0) & (out < 1)).sum() < 3
    assert out.sum() == pytest.approx(p.sum(), abs=1e-5) and size @ out == pytest.approx(size @ p, rel=1e-9)
    assert set(land(out, size)) <= {0.0, 1.0}


def test_mix(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(0, 60)), "big" if i % 3 else f"s{i % 5}", "x") for i in range(3000)]
    rows += [(5, "two words", "big", "x"), (5, "two words", "big", "x"), (9000, None, None, "y"), (9001, "in null\x0bsource\x85x", None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken string").repartition(3)
    got = mix(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.size for r in got}[9001] == 3
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(sum(r.size for r in got))
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(df.repartition(7)).collect()), key=str)
    assert mix(df.limit(0)).count() == 0
    assert {r.taken for r in mix(df.limit(3).withColumn("text", F.lit(" "))).collect()} == {0}


def test_large_units_do_not_spoil_a_target():
    """One text of a tenth of its source's words, and a few others far above the mean."""
    rng = np.random.default_rng(3)
    errors = []
    for seed in range(20):
        size = np.concatenate([rng.integers(20, 900, 400), [3000, 5000, 20_000]])
        p = np.full(len(size), 0.37)
        out = land(fly(p, size, np.random.default_rng(seed)), size)
        assert set(out) <= {0.0, 1.0}
        errors.append(abs(size @ out - size @ p) / (size @ p))
        assert abs(out.sum() - p.sum()) <= 3
    assert max(errors) < 0.01


def test_large_units_keep_their_chance():
    size = np.concatenate([np.full(200, 100), [4000]])
    taken = [fly(np.full(201, 0.3), size, np.random.default_rng(seed))[-1] for seed in range(400)]
    assert set(taken) <= {0.0, 1.0} and abs(np.mean(taken) - 0.3) < 0.08


def test_rows_that_differ_in_a_map_and_many_equal_rows(spark, monkeypatch):
    from readweave.llm import common

    monkeypatch.setattr(common, "SPREAD_ROWS", 7)
    rows = [(1, "a b c", "s", {"meta": "one"}), (1, "a b c", "s", {"meta": "two"}), (1, "a b c", "s", {"meta": None}), (1, "a b c", "s", None)] + [(2, "x y", "s", {"k": "v"})] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, m map<string,string>").repartition(3)
    out = mix_rows(df, weights=(1,)).collect()
    kinds = {str(r.m) for r in out if r.doc_id == 1}
    assert len(kinds) == 4 and len(out) == 44
    assert sum(r.turns for r in mix(df, weights=(1,)).collect()) == 44
