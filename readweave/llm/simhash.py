"""SimHash near-dedup by the generalised pigeonhole principle (operator 10).

Fingerprints of 64 bits that differ in at most ``most`` bits are linked. The bits are grouped into parts so that
correlated bits share a part, and part i gets a threshold t_i >= -1 with sum(t_i + 1) = most + 1: two linked
fingerprints then differ in at most t_i bits of at least one part i. Dynamic programming picks the thresholds with the fewest
estimated candidates and probes, from counts over all fingerprints.

Two part values that differ in at most t bits become equal when up to t set bits of either are cleared, so each fingerprint is
posted under its part value and those variants, and candidates meet by equality. Only different
fingerprints are searched; documents with the same one share its class. A large bucket is posted again under parts of the bits that its
fingerprints don't share yet, by the same principle, so that rows don't grow with the square of a bucket. What stays above ``BLOCK`` is dealt into
blocks, every two of which meet in one task, and a task returns a spanning forest of the links it verified, never all pairs. Components
come from star contractions over those forests.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, inside, map_packed, packed

PARTS = 2
BLOCK = 1024
#: Larger buckets are posted again; a fingerprint of any other meets ``MANY / BLOCK`` blocks at most.
MANY = 16 * BLOCK
#: Fingerprints for one task, edges for one task of a contraction, and how many edges there may be at most for a join that sends one side to every task.
PRINTS, EDGES, FEW = 1 << 13, 1 << 16, 1 << 18
U = np.uint64


def majority(raw: bytes) -> int:
    """The bits that are set in over half of the 64-bit hashes in ``raw`` (big-endian, one after another); 0 without hashes."""
    bits = np.unpackbits(np.frombuffer(raw, "u1").reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype="i8") > len(bits)).tobytes(), "big")


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of whole-text word shingles, repeats included; 0 without words."""
    words = text.lower().split()  # bytes: A-Z alone are lowered, ASCII white space alone parts
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle)), strict=False))
    return majority(b"".join([xxhash.xxh64_digest(g, 42) for g in grams]))


def with_key(docs: DataFrame, key: Callable[[bytes], int]) -> DataFrame:
    """row (all columns of ``docs``, under their own names) and key (64 bits, what ``key`` makes of the text)."""
    own = inside(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([key((t.as_py() or "").encode()) for t in own(b).column("text")], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(found, pa.int64())], ["row", "out"])

    return map_packed(packed(docs), run, "long").withColumnRenamed("out", "key")


def keep_first(docs: DataFrame, key: Callable[[bytes], int], kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose identifier and key stand in ``kept`` (doc_id, key), one for each; rows without an identifier stay.

    Of several such rows the one with the least hash of all its columns stays.
    """
    rows = with_key(docs.where("doc_id is not null"), key).select("row", "key", F.col("row.doc_id").alias("doc_id"))
    named = docs.select("*").schema
    mark = F.xxhash64(*(F.col("row").getField(f.name) for f in named.fields if "map<" not in f.dataType.simpleString()))
    found = rows.join(kept, ["doc_id", "key"], "left_semi").groupBy("doc_id", "key").agg(F.min_by("row", mark).alias("row"))
    return found.select("row.*").unionByName(docs.where("doc_id is null"))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id and fp (64 bits as a long) of every row."""
    return with_key(docs.select("doc_id", "text"), lambda text: fingerprint(text, shingle)).select("row.doc_id", F.col("key").alias("fp"))


def bits_of(fp: np.ndarray) -> np.ndarray:
    """n x 64, bit 0 first."""
    return np.unpackbits(fp.view("u1").reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each two bits how often both are set, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((64, 64))
        for b in batches:
            x = bits_of(b.column("fp").to_numpy()).astype("f4")
            n += len(x)
            both += x.T @ x
        i, j = np.divmod(np.arange(64 * 64), 64)
        yield pa.RecordBatch.from_arrays([pa.array([*i, -1], pa.int32()), pa.array([*j, -1], pa.int32()), pa.array([*both.ravel().astype("i8"), n], pa.int64())], ["i", "j", "c"])

    both, n = np.zeros((64, 64)), 0
    for r in fps.select("fp").mapInArrow(run, "i int, j int, c long").groupBy("i", "j").agg(F.sum("c").alias("c")).collect():  # 4097 rows
        if r.i < 0:
            n = r.c
        else:
            both[r.i, r.j] = r.c
    return n, both


def group_bits(n: int, both: np.ndarray, parts: int = PARTS) -> list[list[int]]:
    """Parts of nearly equal size; each takes the bits that correlate most with those it has."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    r = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(r, 0)
    left, out = set(range(64)), []
    for k in range(parts):
        size = 64 // parts + (k < 64 % parts)
        members = [max(left, key=lambda b: (r[b, sorted(left)].sum(), -b))]
        left.discard(members[0])
        while len(members) < size:
            best = max(left, key=lambda b: (r[b, members].sum(), -b))
            members.append(best)
            left.discard(best)
        out.append(sorted(members))
    return out


def allocate(costs: list[list[float]], most: int) -> list[int]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = most + 1 and the least total of costs[i][t_i + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, c in enumerate(own):
                if used + t <= most + 1 and (used + t not in following or cost + c < following[used + t][0]):
                    following[used + t] = (cost + c, [*chosen, t - 1])
        best = following
    return best[most + 1][1]


def plan(fps: DataFrame, most: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """(mask, threshold) of each part, from counts over all fingerprints."""
    n, both = bit_counts(fps)
    grouped = group_bits(n, both, parts)
    masks = [sum(1 << b for b in g) for g in grouped]
    values = F.array(*(F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("v")) for i, m in enumerate(masks)))
    same = fps.select(F.inline(values)).groupBy("part", "v").agg(F.count(F.lit(1)).alias("c")).groupBy("part").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).collect()
    pairs = {r.part: r.pairs for r in same}
    p = np.diag(both) / max(n, 1)
    costs = []
    for i, g in enumerate(grouped):
        # Pairs that agree in all bits are counted; pairs that differ in few follow from the odds of each bit.
        odds = [2 * p[b] * (1 - p[b]) / max(p[b] ** 2 + (1 - p[b]) ** 2, 1e-9) for b in g]
        reach, keys, poly, own = 0.0, 0.0, [1.0, *[0.0] * (most + 1)], [0.0]
        for o in odds:
            poly = [poly[0], *(poly[k] + o * poly[k - 1] for k in range(1, len(poly)))]
        ones = p[g].sum()
        binomial = 1.0
        for t in range(most + 1):
            reach += poly[t] * pairs.get(i, 0)
            keys += n * binomial
            binomial *= max(ones - t, 0) / (t + 1)
            own.append(reach + 2 * keys)
        costs.append(own)
    return list(zip(masks, allocate(costs, most), strict=True))


def variants(fp: np.ndarray, mask: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and part values with up to t set bits cleared."""
    value = fp & U(mask)
    rows, out, last = [np.arange(len(fp))], [value], [(np.arange(len(fp)), value, np.full(len(fp), -1))]
    bits = [b for b in range(64) if mask >> b & 1]
    for _ in range(t):
        following = []
        for r, v, top in last:
            for b in bits:
                fit = np.flatnonzero((v >> U(b) & U(1) == 1) & (top < b))
                if len(fit):
                    following.append((r[fit], v[fit] & ~U(1 << b), np.full(len(fit), b)))
        rows += [f[0] for f in following]
        out += [f[1] for f in following]
        last = following
    return np.concatenate(rows), np.concatenate(out)


def post(rows: DataFrame, parts: dict[int, list[tuple[int, int, int]]]) -> DataFrame:
    """part, v, fp: each fingerprint of ``rows`` (part, v, fp) under every value that it is looked up by.

    ``parts``: for each part of ``rows`` the (number, mask, threshold) of those that follow it; their bits are added to ``v``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, v, fp = (b.column(n).to_numpy() for n in ("part", "v", "fp"))
            for before in np.unique(part).tolist():
                at = np.flatnonzero(part == before)
                for number, mask, t in parts[before]:
                    if t >= 0:
                        rows, value = variants(fp[at].view("u8"), mask, t)
                        value = value.view("i8") | v[at[rows]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), number), pa.int32()), pa.array(value, pa.int64()), pa.array(fp[at[rows]], pa.int64())], ["part", "v", "fp"])

    return rows.select("part", "v", "fp").mapInArrow(run, "part int, v long, fp long")


def deeper(used: dict[int, int], most: int) -> tuple[dict[int, list[tuple[int, int, int]]], dict[int, int]]:
    """The two parts that follow each of ``used`` (part: mask of the bits it stands for), halves of the other bits, for `post`, and ``used`` of those."""
    parts, following = {}, {}
    for part, mask in used.items():
        bits = [b for b in range(64) if not mask >> b & 1]
        if len(bits) < 8:
            return {}, {}
        halves = (sum(1 << b for b in bits[: len(bits) // 2]), most // 2), (sum(1 << b for b in bits[len(bits) // 2 :]), most - 1 - most // 2)
        parts[part] = [(2 * part + i, own, t) for i, (own, t) in enumerate(halves)]
        following |= {number: mask | own for number, own, _ in parts[part]}
    return parts, following


def forest(fp: np.ndarray, starts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside groups that lie one after another (``starts``: first row of each, and the end), a spanning forest of them."""
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = starts[group + 1]
    label = np.arange(len(fp))
    longest = int(np.diff(starts).max(initial=0))
    row = np.arange(len(fp))
    for d in range(1, longest):
        row = row[row + d < end[row]]
        near = row[np.bitwise_count(fp[row] ^ fp[row + d]) <= most]
        if not len(near):
            continue
        a, b = near, near + d
        while True:  # join the trees of both ends, then point every row at its root
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
    kept = np.flatnonzero(label != np.arange(len(fp)))
    return fp[kept], fp[label[kept]]


def buckets(fps: DataFrame, parts: list[tuple[int, int]], most: int, many: int = MANY) -> DataFrame:
    """part, v, fp, n: the fingerprints that share a value with others, n in all; values that more than ``many`` share give way to longer ones."""

    def shared(posted: DataFrame) -> tuple[DataFrame, int]:
        counts = posted.groupBy("part", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = checkpointed(posted.join(counts, ["part", "v"]))
        r = met.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("most")).first()
        return met.coalesce(max(1, -(-r.rows // EDGES))), r.most or 0

    first = [(len(parts) + i, mask, t) for i, (mask, t) in enumerate(parts)]
    met, largest = shared(post(fps.select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("v"), "fp"), {0: first}))
    used, done = {number: mask for number, mask, _ in first}, []
    while True:
        following, used = deeper(used, most)
        if not following or largest <= many:
            break
        done.append(met.where(F.col("n") <= many))
        met, largest = shared(post(met.where(F.col("n") > many), following))
    for other in done:
        met = met.unionByName(other)
    return met


def links(fps: DataFrame, parts: list[tuple[int, int]], most: int, many: int = MANY) -> DataFrame:
    """u, v: verified links, enough of them to connect all that is linked."""
    met = buckets(fps, parts, most, many)
    whole = met.where(F.col("n") <= BLOCK).select("part", "v", F.lit(0).alias("x"), F.lit(0).alias("y"), "fp")
    deal = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = met.where(F.col("n") > BLOCK).withColumn("k", deal).withColumn("x", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
    dealt = dealt.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).where("x != y")
    met = whole.unionByName(dealt.select("part", "v", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "fp"))
    key = ["part", "v", "x", "y"]
    sorted_ = met.repartition(*key).sortWithinPartitions(*key, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                whole = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            elif rest is None:
                return
            else:
                whole = rest
            if not whole.num_rows:
                continue
            c = [whole.column(n).to_numpy() for n in ("part", "v", "x", "y")]
            new = np.concatenate([[True], np.any([a[1:] != a[:-1] for a in c], axis=0)])
            starts = np.append(np.flatnonzero(new), len(new))
            if b is not None:  # the last group may go on in the next batch
                rest = whole.slice(int(starts[-2]))
                starts = starts[:-1]
            if len(starts) > 1:
                u, v = forest(whole.column("fp").to_numpy()[: starts[-1]].view("u8"), starts, most)
                yield pa.RecordBatch.from_arrays([pa.array(u.view("i8"), pa.int64()), pa.array(v.view("i8"), pa.int64())], ["u", "v"])

    return sorted_.mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of each component, by large-star and small-star contractions.

    Tasks follow the number of edges, not the session's number of partitions: a task takes ``EDGES`` of them.
    """
    edges = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        return r.n, r.s

    state = mark(edges)
    while state[0]:
        tasks = -(-state[0] // EDGES)
        side = (lambda d, n=tasks: F.broadcast(d.coalesce(n))) if state[0] <= FEW else (lambda d: d)
        edges = edges.coalesce(tasks)
        # Large star: every larger neighbour goes to the least neighbour, or to the node itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(side(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").coalesce(tasks).distinct().coalesce(tasks)
        # Small star: smaller neighbours and the node itself go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(side(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        following = checkpointed(down.unionByName(least.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct().coalesce(tasks))
        before, state = state, mark(following)
        edges = following
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(marked: DataFrame, most: int, parts: int = PARTS) -> DataFrame:
    """fp, first (its least doc_id), root (a fingerprint that stands for the component), one row for each fingerprint of ``marked`` (doc_id, fp)."""
    fps = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    fps = fps.coalesce(max(1, -(-fps.count() // PRINTS)))
    tree = components(links(fps, plan(fps, most, parts), most))
    return fps.join(tree, fps["fp"] == tree["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id: the smallest doc_id that links of at most ``most`` differing bits reach, its own included; null only where no row of
    the component has one. Null and empty texts have fingerprint 0 and are linked like any other; texts of fewer words than a shingle
    are one shingle. Repeated rows all come out; further columns are not carried; an empty table gives an empty table.
    """
    marked = checkpointed(fingerprints(docs, shingle))
    rooted = classes(marked, most)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(found, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, most: int = 3) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest doc_id stays, on a tie the one with the least fingerprint.

    Rows that repeat an identifier are documents of their own and stay if they are in different components. Rows without an identifier stay
    as they are. All columns are kept, whatever their names; an empty table gives an empty table.
    """
    marked = checkpointed(fingerprints(docs.where("doc_id is not null"), shingle))
    first = classes(marked, most).groupBy("root").agg(F.min(F.struct(F.col("first").alias("doc_id"), F.col("fp").alias("key"))).alias("kept"))
    return keep_first(docs, lambda text: fingerprint(text, shingle), first.select("kept.*"))
