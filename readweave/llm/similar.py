"""Near-duplicate documents by SimHash and the Jaccard similarity of their word shingles (the pipeline's stage).

Documents with equal sets of shingles are one node. Its SimHash votes over the set (64-bit hashes, each shingle once), and operator 10's
search by the generalised pigeonhole principle, as wide as there, puts fingerprints that differ in at most ``MOST`` bits into one class. Every link
inside a class is decided by the exact similarity of both sets.

A similarity of 0.8 lies up to some 20 bits apart, which no threshold covers at a price that grows well, so there is an exact way for the rest: MinHash
bands bring together what SimHash leaves apart, and the same exact similarity decides. ``BANDS`` bands of ``ROWS`` values miss a pair of
similarity 0.8 with a chance of (1 - 0.8**6)**48, less than one in two million. How wide SimHash searches thus changes no result.

Classes and bands alike are buckets. In each, every node is verified against the bucket's least one, which takes as many
pairs as the bucket has nodes; a pair of several buckets is verified once. Buckets whose nodes are still in several components are then compared further:
the bucket's largest component with the others and the others with each other, dealt into blocks, every two of which meet
in one task. Pairs inside one component are never compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .simhash import classes, components, keep_first, majority

#: Bits that fingerprints of a class may differ in, and the parts that they are searched by: operator 10's own. Parts must be so long that few
#: fingerprints share a value by chance, or the rows that meet grow with the square of the table.
MOST, PARTS = 3, 2
BANDS, ROWS, BLOCK = 48, 6, 512
_random = np.random.default_rng(20)
TIMES = _random.integers(0, 1 << 32, BANDS * ROWS, "u4") | np.uint32(1)
PLUS = _random.integers(0, 1 << 32, BANDS * ROWS, "u4")


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """Sorted hashes of the different word shingles; a text of fewer words is one shingle, one without words has none."""
    words = text.lower().split()  # bytes: A-Z alone are lowered, ASCII white space alone parts
    if not words:
        return np.zeros(0, "u8")
    n = max(1, len(words) - shingle + 1)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle])) for i in range(n)), "u8", n))


def set_hash(hashes: np.ndarray) -> int:
    """64 bits that stand for a set of shingles."""
    return xxhash.xxh64_intdigest(hashes.tobytes())


def bands(hashes: np.ndarray) -> np.ndarray:
    """The value of each band."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, "u4")
    low = (hashes >> np.uint64(32)).astype("u4")
    for i in range(0, len(low), 256):
        least = np.minimum(least, (low[i : i + 256, None] * TIMES + PLUS).min(0))
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, ROWS))], "u8").view("i8")


def nodes(docs: DataFrame, shingle: int) -> DataFrame:
    """sid (which set of shingles), first (its least doc_id), fp (its SimHash), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, fp, found = [], [], []
            for t in b.column("text"):
                h = shingles((t.as_py() or "").encode(), shingle)
                sid.append(set_hash(h))
                fp.append(majority(h.astype(">u8").tobytes()))
                found.append(bands(h))
            marks = [pa.array(np.array(x, "u8").view("i8")) for x in (sid, fp)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *marks, pa.array(found, pa.list_(pa.int64()))], ["doc_id", "sid", "fp", "bands"])

    marked = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, sid long, fp long, bands array<long>")
    return marked.groupBy("sid").agg(F.min("doc_id").alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))


def sets_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """sid and grams (hashes of shingles) of the nodes in ``wanted`` (sid, first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [shingles((t.as_py() or "").encode(), shingle) for t in b.column("text")]
            sid = np.array([set_hash(h) for h in held], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([pa.array(sid), pa.array([h.view("i8") for h in held], pa.list_(pa.int64()))], ["sid", "grams"])

    some = docs.select("doc_id", "text").join(wanted.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")
    made = some.select("text").mapInArrow(run, "sid long, grams array<long>")
    return made.join(wanted.select("sid"), "sid", "left_semi").dropDuplicates(["sid"])


def block_links(sid: np.ndarray, root: np.ndarray, grams: list[np.ndarray], least: float, rest: np.ndarray) -> list[tuple[int, int]]:
    """Links of at least ``least`` between nodes of different roots, one of them in ``rest``; one that joins what earlier ones have joined is left out."""
    size = np.array([len(g) for g in grams])
    flat = np.unique(np.concatenate(grams), return_inverse=True)[1]
    start = np.cumsum(size) - size
    label, out = np.unique(root, return_inverse=True)[1], []
    for i in np.flatnonzero(rest):
        other = label != label[i]
        if not size[i] or not other.any():
            continue
        has = np.zeros(flat.max() + 1, "i8")
        has[flat[start[i] : start[i] + size[i]]] = 1
        total = np.concatenate([[0], np.cumsum(has[flat])])
        both = total[start + size] - total[start]
        for j in np.flatnonzero(other & (both >= least * (size + size[i] - both))):
            if label[j] != label[i]:
                out.append((int(sid[i]), int(sid[j])))
                label[label == label[j]] = label[i]
    return out


def further(met: DataFrame, tree: DataFrame, grams: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """u, v: links between nodes of a bucket that ``tree`` (node, root) leaves apart. ``met``: v (bucket), sid."""
    rooted = met.join(tree.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    mark = [F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(sid))").alias("m1"), F.expr("bit_xor(xxhash64(sid, 1))").alias("m2")]
    # Buckets of the same nodes count once.
    apart = rooted.groupBy("v").agg(*mark, F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi and n > 2")
    apart = apart.groupBy("n", "m1", "m2").agg(F.min("v").alias("v")).select("v", "n")
    rooted = checkpointed(rooted.join(apart, "v"))
    main = rooted.groupBy("v", "n", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("v").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.max("c").alias("c"))
    d = rooted.join(main, "v").withColumn("rest", F.col("root") != F.col("main"))
    km, kr = (F.ceil(x / block).cast("int") for x in (F.col("c"), F.col("n") - F.col("c")))
    d = d.select("v", "sid", "root", "rest", km.alias("km"), kr.alias("kr")).withColumn("own", F.pmod(F.xxhash64("sid"), F.when(F.col("rest"), F.col("kr")).otherwise(F.col("km"))).cast("int"))
    upto = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1)).alias("y")
    columns = ["v", "sid", "root", "rest", "own"]
    key = ["v", "kind", "x", "y"]
    m = d.where("not rest").select(*columns, upto("kr")).select("v", "sid", "root", "rest", F.lit(0).alias("kind"), F.col("own").alias("x"), "y")
    r = d.where("rest").select(*columns, upto("km")).select("v", "sid", "root", "rest", F.lit(0).alias("kind"), F.col("y").alias("x"), F.col("own").alias("y"))
    rr = d.where("rest").select(*columns, upto("kr")).select("v", "sid", "root", "rest", F.lit(1).alias("kind"), F.least("own", "y").alias("x"), F.greatest("own", "y").alias("y"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        held = block_links(pdf["sid"].to_numpy(), pdf["root"].to_numpy(), [np.asarray(g, "i8") for g in pdf["grams"]], least, pdf["rest"].to_numpy())
        return pd.DataFrame(held, columns=["u", "v"], dtype="int64")

    return m.unionByName(r).unionByName(rr).join(grams, "sid").groupBy(*key).applyInPandas(run, "u long, v long").distinct()


def company(posted: DataFrame) -> DataFrame:
    """v, sid, n, least: of each bucket of two or more nodes (``posted``: sid, v) its nodes, how many they are, and the least of them."""
    shared = posted.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("sid").alias("least")).where("n > 1")
    return checkpointed(posted.join(shared, "v"))


def joined(met: DataFrame, grams: DataFrame, least: float) -> DataFrame:
    """node, root: the components of links of at least ``least`` between nodes that share a bucket of ``met``."""
    pairs = met.where("sid != least").select(F.col("least").alias("u"), F.col("sid").alias("v")).distinct()
    a, b = grams.select(F.col("sid").alias("u"), F.col("grams").alias("a")), grams.select(F.col("sid").alias("v"), F.col("grams").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    links = pairs.join(a, "u").join(b, "v").withColumn("both", both).where(F.col("both") >= least * (F.size("a") + F.size("b") - F.col("both"))).select("u", "v")
    tree = components(links)
    more = checkpointed(further(met.where("n > 2").select("v", "sid"), tree, grams, least))
    return tree if more.isEmpty() else components(tree.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))


def similar_components(docs: DataFrame, shingle: int, least: float, most: int = MOST) -> DataFrame:
    """sid, first, root: of each different set of shingles its hash, its least doc_id, and the set that stands for its component."""
    found = checkpointed(nodes(docs, shingle))
    classed = classes(found.select(F.col("first").alias("doc_id"), "fp"), most, PARTS).select("fp", F.col("root").alias("v"))
    near = found.select("sid", "fp").join(classed, "fp").select("sid", "v")
    met = company(near.unionByName(found.select("sid", F.explode("bands").alias("v"))))
    wanted = found.join(met.select("sid").distinct(), "sid", "left_semi").select("sid", "first")
    grams = checkpointed(sets_of(docs, wanted, shingle))
    tree = joined(met, grams, least)
    return found.select("sid", "first").join(tree.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))


def drop_similar(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest doc_id stays, on a tie the one with the least set hash.

    Linked are documents whose sets of shingles have a Jaccard similarity of ``least`` or more (0.8 or above, as the bands are made for it).
    Texts without words are copies of each other. Rows that repeat an identifier are documents of their own and stay if they
    are in different components. Rows without an identifier stay as they are. All columns are kept, whatever their names; an empty table gives an
    empty table.
    """
    found = similar_components(docs.where("doc_id is not null").select("doc_id", "text"), shingle, least)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("first").alias("doc_id"), F.col("sid").alias("key"))).alias("kept"))
    return keep_first(docs, lambda text: set_hash(shingles(text, shingle)), first.select("kept.*"))
