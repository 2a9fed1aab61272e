import itertools

import numpy as np
import xxhash

import corpus_pipeline
from readweave.llm import simhash, similar

from .test_neighbours import WORD, brute_components, brute_fingerprint


def grams(text, k=5):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    a, b = (x if isinstance(x, set) else grams(x) for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_kept(rows, least=0.8):
    root, held = {i: i for i, _ in rows}, [(i, grams(t)) for i, t in rows]
    for (i, a), (j, b) in itertools.combinations(held, 2):
        if root[i] != root[j] and jaccard(a, b) >= least:
            x, y = root[i], root[j]
            root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
    return sorted({min(k for k in root if root[k] == r) for r in root.values()})


def texts():
    rng = np.random.default_rng(9)
    rows, n = [], 0
    for words in (9, 14, 40, 120, 300):
        for _ in range(8):
            base = [f"w{x}" for x in rng.integers(0, 10_000, words)]
            for share in (0, 0.01, 0.02, 0.03, 0.04, 0.06):
                own = [f"x{n}_{k}" if rng.random() < share else w for k, w in enumerate(base)]
                rows.append((n, " ".join(own)))
                n += 1
    return [*rows, (n, ""), (n + 1, None), (n + 2, "one two"), (n + 3, "ONE\ttwo"), (n + 4, "one three")]


def test_stage_near_drops_pairs_of_0_8(spark):
    rows = texts()
    want = brute_kept([(i, t or "") for i, t in rows])
    # The former rule, 3 bits, keeps many of them.
    assert len(set(brute_components([i for i, _ in rows], [brute_fingerprint(t, 5) for _, t in rows], 3).values())) > len(want) + 20
    df = spark.createDataFrame([*rows, (None, "one two")], "doc_id long, text string").repartition(3)
    assert sorted((r.doc_id for r in corpus_pipeline.near(spark, df, "").collect()), key=lambda i: -1 if i is None else i) == [None, *want]
    assert corpus_pipeline.near(spark, df.limit(0), "").count() == 0


def test_buckets_whose_least_node_links_nothing(spark):
    """Links between nodes of which neither is a bucket's least are found, over several blocks too."""
    rows = texts()[:96]
    grams = [similar.shingles(t.encode(), 5).view("i8").tolist() for _, t in rows]
    met = spark.createDataFrame([(7, i) for i, _ in rows] + [(8, i) for i, _ in rows], "v long, sid long")
    held = spark.createDataFrame([(i, g) for (i, _), g in zip(rows, grams, strict=True)], "sid long, grams array<long>")
    tree = spark.createDataFrame([(1, 0)], "node long, root long")
    links = similar.further(met, tree, held, 0.8, block=10).collect()
    assert all(jaccard(rows[r.u][1], rows[r.v][1]) >= 0.8 for r in links)
    parent = dict(enumerate(range(96)))
    for u, v in [*((r.u, r.v) for r in links), (0, 1)]:
        x, y = parent[u], parent[v]
        parent = {k: min(x, y) if p in (x, y) else p for k, p in parent.items()}
    if jaccard(rows[0][1], rows[1][1]) >= 0.8:
        assert sorted(set(parent.values())) == brute_kept(rows)


def test_simhash_links_without_bands(spark, monkeypatch):
    """Links of 0.8 inside SimHash classes need no MinHash band."""
    rows = [(i, t or "") for i, t in texts()]

    def vote(g):
        h = [xxhash.xxh64_intdigest(" ".join(x)) for x in g]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    classes = brute_components([i for i, _ in rows], [vote(grams(t)) for _, t in rows], similar.MOST)
    want = sorted(i for c in set(classes.values()) for i in brute_kept([r for r in rows if classes[r[0]] == c]))
    monkeypatch.setattr(similar, "bands", lambda h: np.array([similar.set_hash(h)], "u8").view("i8"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in corpus_pipeline.near(spark, df, "").collect())
    assert got == want and len(brute_kept(rows)) < len(want) < len(rows) - 60


def tasks_of(spark, name, run):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    told = sc.statusTracker()
    stages = {i for job in told.getJobIdsForGroup(name) for i in told.getJobInfo(job).stageIds}
    return out, sum(s.numCompletedTasks for s in map(told.getStageInfo, stages) if s)


def test_rows_that_meet_grow_with_the_table(spark):
    """Fingerprints without links meet hardly any other, however many there are."""
    fp = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 100_000, "u8")).view("i8")
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fp.tolist())], "first long, fp long").repartition(4)
    met = simhash.buckets(df, simhash.plan(df, similar.MOST, similar.PARTS), similar.MOST)
    assert met.count() < len(fp) / 10


def test_large_buckets_are_posted_again(spark):
    """Buckets above the bound give way to longer values, and no link is lost."""
    rng = np.random.default_rng(8)
    base, fp = 0x0F1E2D3C4B5A6978, {0x0F1E2D3C4B5A6978}
    while len(fp) < 1200:
        fp.add(base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 9), replace=False)))
    ids = np.array(sorted(fp), "u8").view("i8").tolist()
    df = spark.createDataFrame([(i, f) for i, f in enumerate(ids)], "first long, fp long")
    parts = [((1 << 32) - 1, 1), ((1 << 64) - (1 << 32), 1)]
    whole, short = (simhash.buckets(df, parts, 3, many).groupBy("part", "v").count().agg({"count": "max"}).first()[0] for many in (1 << 30, 40))
    assert short < whole / 2
    want = brute_components(list(range(len(ids))), np.array(ids, "i8").view("u8").tolist(), 3)
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, parts, 3, 40)).collect()}
    groups = {}
    for i, f in enumerate(ids):
        groups.setdefault(roots.get(f, f), []).append(i)
    assert {i: min(v) for v in groups.values() for i in v} == want


def test_contractions_of_few_edges_take_few_tasks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(50)], "u long, v long")
        tree, tasks = tasks_of(spark, "few edges", lambda: simhash.components(edges).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r.node: r.root for r in tree} == dict.fromkeys(range(1, 51), 0)
    assert tasks < 400
