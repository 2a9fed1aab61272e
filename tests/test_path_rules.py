"""Path suppression and joining against plain loops over sets, and chimera walls against a scan tile by tile."""

import random
from collections import defaultdict

from readweave.operators.chimera import chimera_walls
from readweave.operators.paths import join_paths, suppress_paths


def near(start, links, steps):
    seen, edge = set(start), set(start)
    for _ in range(steps):
        edge = {d for s in edge for d in links[s]} - seen
        seen |= edge
    return seen


def test_suppressed_paths(spark):
    r = random.Random(4)
    rows, edges, rid = [], set(), 0
    for path in range(40):
        size = r.choice([2, 3, 3, 5, 8])
        rows += [(path, k, rid + k, 0) for k in range(size)]
        edges |= {(rid + k, rid + k + 1) for k in range(size - 1)}
        rid += size
    edges |= {(r.randrange(rid + 60), r.randrange(rid + 60)) for _ in range(130)}  # some run by way of reads without a path
    links = defaultdict(set)
    for s, d in edges:
        links[s].add(d)
        links[d].add(s)
    reads = defaultdict(set)
    for p, _, i, _ in rows:
        reads[p].add(i)
    for dist in (1, 2, 3):
        kept, covered = set(), set()
        for p in sorted(reads, key=lambda p: (-len(reads[p]), p)):
            if not reads[p] <= covered:
                kept.add(p)
                covered |= near(reads[p], links, dist - 1)
        got = suppress_paths(spark.createDataFrame(rows, "path long, rank long, rid long, comp int"), spark.createDataFrame(sorted(edges), "src long, dst long"), dist)
        assert {x.path for x in got.collect()} == kept
    assert 0 < len(kept) < 40


def test_a_side_path_at_distance_three(spark):
    paths = [(0, k, k, 0) for k in range(6)] + [(100, k, 100 + k, 0) for k in range(2)] + [(200, k, 200 + k, 0) for k in range(2)]
    edges = [(k, k + 1) for k in range(5)] + [(100, 101), (200, 201), (2, 100), (2, 50), (50, 51), (51, 200)]
    got = suppress_paths(spark.createDataFrame(paths, "path long, rank long, rid long, comp int"), spark.createDataFrame(edges, "src long, dst long"))
    assert {x.path for x in got.collect()} == {0, 200}


def test_only_unique_choices_join(spark):
    # 1 meets 2 and 3 at one end; 3 and 4 meet alone, the wrong way round; 5 meets 6 and 7.
    paths = [(p, k, 10 * p + k, k % 2) for p in (1, 2, 3, 4, 5, 6, 7) for k in range(3)]
    optional = [(12, 20), (22, 30), (32, 42), (12, 30), (50, 60), (50, 70)]
    got = join_paths(spark.createDataFrame(paths, "path long, rank long, rid long, comp int"), spark.createDataFrame(optional, "src long, dst long")).collect()
    order = defaultdict(list)
    for x in sorted(got, key=lambda x: x.rank):
        order[x.path].append((x.rid, x.comp))
    assert sorted(map(len, order.values())) == [3, 3, 3, 3, 3, 6]
    assert order[3] == [(30, 0), (31, 1), (32, 0), (42, 1), (41, 0), (40, 1)]
    assert all([k for k, _ in order[p]] == [10 * p, 10 * p + 1, 10 * p + 2] for p in (1, 2, 5, 6, 7))


def test_three_joins_in_a_row(spark):
    paths = [(p, k, 10 * p + k, 0) for p in (1, 2, 3, 4) for k in range(3)]
    got = join_paths(spark.createDataFrame(paths, "path long, rank long, rid long, comp int"), spark.createDataFrame([(12, 20), (22, 30), (32, 42)], "src long, dst long")).collect()
    rids = [x.rid for x in sorted(got, key=lambda x: x.rank)]
    assert {x.path for x in got} == {1} and rids == [10, 11, 12, 20, 21, 22, 30, 31, 32, 42, 41, 40]
    assert {x.rid: x.comp for x in got}[40] == 1 and {x.rid: x.comp for x in got}[30] == 0
    again = join_paths(spark.createDataFrame(paths, "path long, rank long, rid long, comp int"), spark.createDataFrame([], "src long, dst long"))
    assert again.count() == 12


def scan(pile, tb, te, chains, repeats, b=7, most=8000, pct=70):
    """The cuts of one read, tile by tile."""
    ends, begins = defaultdict(int), defaultdict(int)
    for k in range(1, len(pile) - 1):
        p, x, n = pile[k - 1], pile[k], pile[k + 1]
        early = x["be"] + 1000 < x["blen"] and x["ae"] + 1000 < te and x["ae"] - 100 > tb
        late = x["bb"] > 1000 and x["ab"] > tb + 1000 and x["ab"] + 100 < te
        if early and late and p["b"] != x["b"] != n["b"]:
            continue
        if x["b"] != n["b"] and early:
            ends[x["ae"] // 100] += 1
        elif p["b"] != x["b"] and late:
            begins[x["ab"] // 100] += 1
    low, high, cuts, i = tb, te, 0, tb // 100
    while i <= high // 100:
        w = i if ends[i] >= b else i + 1 if ends[i] + ends[i + 1] >= b else None
        if w is None:
            i += 1
            continue
        j = low // 100
        while j <= high // 100:
            v = j if begins[j] >= b else j + 1 if begins[j] + begins[j + 1] >= b else None
            if v is None:
                j += 1
                continue
            x, y = sorted((w * 100, v * 100))
            rep = sum(max(0, min(y, e) - max(x, s)) for s, e in repeats)
            if y - x > most or (y - x > 1000 and 100 * rep < pct * (y - x)):
                j = v + 1
                continue
            if any(ab + 800 < x and ae - 800 > y and ae - ab > 3000 for ab, ae in chains):
                j = v + 3
                continue
            if cuts == 0 or x < high:
                if x - low > high - y:
                    high = x
                else:
                    low = y
            cuts += 1
            break
        i = w + 3
    return (low, high, cuts) if cuts else None


def test_chimera_walls(spark):
    r = random.Random(8)
    rows, want, trims, iv = [], {}, [], []
    for a in range(80):
        alen, tb, te = 30_000, r.randrange(300), 30_000 - r.randrange(300)
        trims.append((a, tb, te))
        pile, spots = [], [r.randrange(4000, 26_000) for _ in range(r.choice([1, 2, 3]))]
        far = a % 2 == 1  # two places apart, short overlaps
        spots = [5000, 16_000] if far else spots
        for b in range(r.choice([60, 120])):
            at, kind = r.choice(spots), r.random()
            jump = r.choice([40, 150, 300])
            ab, ae = (max(0, at - r.randrange(1200, 6000)), at + r.randrange(jump)) if kind < 0.5 else (at + r.choice([0, 0, 0, 900]) + r.randrange(jump), min(alen, at + r.randrange(1200, 6000)))
            if far:
                ab, ae = max(ab, ae - 2500) if kind < 0.5 else ab, ae if kind < 0.5 else min(ae, ab + 2500)
            elif kind > 0.993:
                ab, ae = max(0, at - 5000), min(alen, at + 5000)
            pile.append({"b": b // r.choice([1, 1, 2]), "ab": ab, "ae": ae, "bb": r.choice([0, 2000, 5000, 3000]), "be": r.choice([12_000, 15_000, 18_000, 19_500]), "blen": 20_000})
        repeats = sorted((s, s + 1500) for s in r.sample(range(0, 28_000, 2000), 6))
        iv += [("rep", a, s, e) for s, e in repeats]
        pile.sort(key=lambda x: (x["b"], x["ab"], x["ae"], x["bb"], x["be"]))
        single = defaultdict(list)
        for k, x in enumerate(pile):
            rows.append((a * 1000 + k, a, 1000 + x["b"], 0, alen, 20_000, x["ab"], x["ae"], x["bb"], x["be"], 0))
            single[x["b"]].append((x["ab"], x["ae"]))
        # Chains are given below for pairs with one overlap alone.
        found = scan(pile, tb, te, [v[0] for v in single.values() if len(v) == 1], repeats, b=4)
        if found:
            want[a] = found
    o = spark.createDataFrame(rows, "ovl_id long, aread long, bread long, comp int, alen long, blen long, abpos long, aepos long, bbpos long, bepos long, diffs int")
    trim = spark.createDataFrame(trims + [(1000 + b, 0, 20_000) for b in range(120)], "rid long, tb long, te long")
    alone = o.groupBy("aread", "bread").count().where("count = 1").select("aread", "bread")
    chains = o.join(alone, ["aread", "bread"], "left_semi").selectExpr("*", "0L AS chain", "0L AS rank")
    got = {x.rid: (x.tb, x.te, x.chimeras) for x in chimera_walls(o, trim, spark.createDataFrame(iv, "track string, rid long, beg long, end_ long"), chains, border=4).collect()}
    assert got == {a: (max(lo, trims[a][1]), min(hi, trims[a][2]), n) for a, (lo, hi, n) in want.items()}
    assert len(want) > 5 and max(n for _, _, n in want.values()) > 1


def borders(pos, density, least, most):
    if len(pos) < least:
        return []
    size = pos[-1] - pos[0]
    if (size == 0 or len(pos) > density * size) and size < most:
        return [(pos[0], pos[-1], len(pos))]
    if len(pos) < 2:
        return []
    gaps = [b - a for a, b in zip(pos, pos[1:])]
    at = gaps.index(max(gaps)) + 1
    return borders(pos[:at], density, least, most) + borders(pos[at:], density, least, most)


def test_borders(spark):
    from readweave.operators.evidence import cluster_borders

    r = random.Random(2)
    rows = [(a, p) for a in range(20) for p in sorted(min(9000, int(r.choice([1000, 1100, 4000, 7000]) + r.gauss(0, r.choice([5, 60, 600])))) for _ in range(r.choice([2, 10, 50])))]
    want = [(a, *b) for a in range(20) for b in borders([p for i, p in rows if i == a], 0.03, 3, 300)]
    got = cluster_borders(spark.createDataFrame(rows, "rid long, pos long"), 0.03, 3, 300).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 10


def test_consensus_without_its_own_segment(spark):
    """Most segments have a length that A's own has not: its letters have no say, and nothing breaks."""
    from readweave.operators.patches import column_consensus

    reads = [(1, "acgtacgtac"), (2, "aacctt"), (3, "aacgtt"), (4, "aaccta")]
    pile = [(1, 0, 10 + b, b, 0, 6, 0, 6) for b in (2, 3, 4)]
    p = spark.createDataFrame(pile, "aread long, tile long, ovl_id long, bread long, comp int, blen long, sb long, eb long")
    got = column_consensus(p, spark.createDataFrame(reads, "rid long, seq string"), twidth=10, chunk=4).collect()
    assert [(r.aread, r.tile, r.seq, r.used) for r in got] == [(1, 0, "aacctt", 3)]
