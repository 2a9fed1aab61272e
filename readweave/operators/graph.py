"""Overlap graph, contigs and short-read pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readweave.functions.lineage import shared_folder
from readweave.functions.columns import has

from .overlaps import flagged, purge, with_ends


def drop_parallel_overlaps(o: DataFrame) -> DataFrame:
    """Live overlaps of pairs that have only one."""
    live = purge(o) if "flags" in o.columns else o
    once = live.groupBy("aread", "bread").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    return live.join(once, ["aread", "bread"], "left_semi")


def contained_nodes(o: DataFrame, trim: DataFrame) -> DataFrame:
    e = with_ends(o.where("aread <> bread"), trim)
    a = e.where("abpos <= atb and aepos >= ate").select(F.col("aread").alias("rid"))
    return a.unionByName(e.where("bbpos <= btb and bepos >= bte").select(F.col("bread").alias("rid"))).distinct()


def build_edges(o: DataFrame, trim: DataFrame) -> DataFrame:
    """src, dst, side, ovh, div: an edge at A's trimmed start (l) or end (r) where B goes beyond; contained reads have none."""
    e = with_ends(o.where("aread <> bread"), trim)
    inside = contained_nodes(o, trim)
    div = F.floor(200 * F.col("diffs") / (F.col("aepos") - F.col("abpos") + F.col("bepos") - F.col("bbpos")))
    left = e.where("abpos <= atb and bbpos > btb and aepos < ate").select(F.col("aread").alias("src"), F.col("bread").alias("dst"), F.lit("l").alias("side"), (F.col("bbpos") - F.col("btb")).alias("ovh"), div.alias("div"))
    right = e.where("aepos >= ate and bepos < bte and abpos > atb").select(F.col("aread").alias("src"), F.col("bread").alias("dst"), F.lit("r").alias("side"), (F.col("bte") - F.col("bepos")).alias("ovh"), div.alias("div"))
    edges = left.unionByName(right)
    for end in ("src", "dst"):
        edges = edges.join(inside.withColumnRenamed("rid", end), end, "left_anti")
    return edges.select("src", "dst", "side", "ovh", "div")


def lone_overlaps(o: DataFrame, trim: DataFrame) -> DataFrame:
    """Live overlaps of different reads, one for a pair, with the trims."""
    return with_ends(drop_parallel_overlaps(o).where(~has(F.col("flags"), "SYMDISCARD")), trim)


def proper_ends(o: DataFrame, trim: DataFrame) -> DataFrame:
    """Lone overlaps of reads that no overlap holds. Discarded rows still mark reads as held."""
    o = flagged(o).where("aread <> bread")
    e = lone_overlaps(o, trim)
    inside = contained_nodes(o, trim)
    for end in ("aread", "bread"):
        e = e.join(inside.withColumnRenamed("rid", end), end, "left_anti")
    return e


def strand_edges(o: DataFrame, trim: DataFrame) -> DataFrame:
    """src, dst, side, ovh, span, div, kind: edges at both ends of A, and the way back (kind rev) where A also goes beyond B.

    The way back leaves B at the end that meets A: the same side on opposite strands, the other side on one strand.
    """
    e = proper_ends(o, trim).withColumn("div", F.floor(200 * F.col("diffs") / (F.col("aepos") - F.col("abpos") + F.col("bepos") - F.col("bbpos"))))
    c = F.col
    sides = (
        ("l", c("abpos") == c("atb"), c("bbpos") - c("btb"), c("ate") - c("aepos")),
        ("r", c("aepos") == c("ate"), c("bte") - c("bepos"), c("abpos") - c("atb")),
    )
    out = []
    for side, meets, ovh, back in sides:
        rows = e.where(meets & (ovh > 0))
        other = F.when(c("comp") == 1, side).otherwise("r" if side == "l" else "l")
        out.append(rows.select(c("aread").alias("src"), c("bread").alias("dst"), F.lit(side).alias("side"), ovh.alias("ovh"), (c("aepos") - c("abpos")).alias("span"), "div", F.lit("fwd").alias("kind")))
        out.append(rows.where(back > 0).select(c("bread").alias("src"), c("aread").alias("dst"), other.alias("side"), back.alias("ovh"), (c("bepos") - c("bbpos")).alias("span"), "div", F.lit("rev").alias("kind")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def overhang_errors(o: DataFrame, trim: DataFrame) -> DataFrame:
    """Lone overlaps that meet one end of A's trim, not both, while B's part goes beyond B's trim there: broken input."""
    e = lone_overlaps(flagged(o).where("aread <> bread"), trim)
    beyond = "(abpos = atb and bbpos < btb) or (aepos = ate and bepos > bte)"
    return e.where(f"not (abpos = atb and aepos = ate) and ({beyond})").select("aread", "bread", "comp")


def dedup_edges(edges: DataFrame) -> DataFrame:
    """One edge for each target: on the left side if it has one there, of several the longest span (if known), then the smallest overhang."""
    long = [F.desc("span")] if "span" in edges.columns else []
    w = Window.partitionBy("src", "dst").orderBy("side", *long, "ovh", "div")
    return edges.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def node_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count_if(F.col("side") == "l").alias("n_left"), F.count_if(F.col("side") == "r").alias("n_right"))


def dead_ends(edges: DataFrame) -> DataFrame:
    return node_degree(edges).where("n_left = 0 or n_right = 0").select("src")


def vertex_quality(edges: DataFrame) -> DataFrame:
    """1/clamp(left) + 1/clamp(right) + mean divergence/1000, rounded to six places."""
    clamp = lambda c: F.least(F.greatest(c, F.lit(1)), F.lit(10))
    d = edges.groupBy("src").agg(F.count_if(F.col("side") == "l").alias("_l"), F.count_if(F.col("side") == "r").alias("_r"), F.avg("div").alias("_d"))
    return d.select("src", F.round(1 / clamp(F.col("_l")) + 1 / clamp(F.col("_r")) + F.col("_d") / 1000, 6).alias("quality"))


def drop_inversions(edges: DataFrame) -> DataFrame:
    """Edges to targets that are reached from both ends of a node go."""
    bad = edges.groupBy("src", "dst").agg(F.count_distinct("side").alias("_s")).where("_s > 1").drop("_s")
    return edges.join(bad, ["src", "dst"], "left_anti")


def rescue_dead_ends(o: DataFrame, edges: DataFrame, trim: DataFrame, n: int = 1) -> DataFrame:
    """For a proper read without an edge on a side: up to ``n`` contained neighbours there, the longest overlaps first. One round."""
    inside = contained_nodes(o, trim)
    e = with_ends(o.where("aread <> bread"), trim).join(inside.withColumnRenamed("rid", "aread"), "aread", "left_anti").join(inside.withColumnRenamed("rid", "bread"), "bread", "left_semi")
    span = (F.col("aepos") - F.col("abpos")).alias("span")
    left = e.where("abpos <= atb and bbpos > btb").select("aread", "bread", F.lit("l").alias("side"), span)
    right = e.where("aepos >= ate and bepos < bte").select("aread", "bread", F.lit("r").alias("side"), span)
    open_ = left.unionByName(right).join(edges.select(F.col("src").alias("aread"), "side").distinct(), ["aread", "side"], "left_anti")
    w = Window.partitionBy("aread", "side").orderBy(F.desc("span"), "bread")
    return open_.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).select(F.col("aread").alias("src"), F.col("bread").alias("dst"), "side", "span")


def set_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the folder that the cluster names."""
    shared_folder(spark)


def components(edges: DataFrame) -> DataFrame:
    """rid and the least rid of its component; labels spread along edges and jump, lineage is cut each round."""
    set_checkpoints(edges.sparkSession)
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct().checkpoint()
    label = both.select(F.col("src").alias("rid")).distinct().withColumn("component", F.col("rid")).checkpoint()
    while True:
        near = both.join(label.withColumnRenamed("rid", "dst"), "dst").groupBy("src").agg(F.min("component").alias("_m")).withColumnRenamed("src", "rid")
        low = label.join(near, "rid").select("rid", "component", F.least("component", "_m").alias("_c"))
        # A node takes over the label of its label.
        of = low.select(F.col("rid").alias("_c"), F.col("_c").alias("_j"))
        new = low.join(of, "_c", "left").select("rid", F.col("component").alias("_old"), F.coalesce("_j", "_c").alias("component")).checkpoint()
        moved = new.where("_old <> component").limit(1).count()
        label = new.drop("_old")
        if not moved:
            return label


def neighborhood(edges: DataFrame, seeds: DataFrame, radius: int) -> DataFrame:
    """rid and its distance of at most ``radius`` steps from the seeds. Lineage is cut each step, as the plan would double with it."""
    set_checkpoints(edges.sparkSession)
    found = seeds.select("rid").distinct().withColumn("dist", F.lit(0)).checkpoint()
    front = found
    for d in range(1, radius + 1):
        step = front.join(edges, front["rid"] == edges["src"]).select(F.col("dst").alias("rid")).distinct()
        front = step.join(found, "rid", "left_anti").withColumn("dist", F.lit(d)).checkpoint()
        found = found.unionByName(front)
    return found


def graph_rows(edges: DataFrame) -> DataFrame:
    """Text rows of a trivial graph file."""
    return edges.select(F.format_string("%d %d %s %d %d", "src", "dst", "side", F.col("ovh").cast("long"), F.col("div").cast("long")).alias("line"))


def paths_to_rids(paths: DataFrame) -> DataFrame:
    """Distinct read ids of path lines ``PATH id e1 e2 a-b b-c ...``."""
    hops = F.filter(F.split("line", " "), lambda x: x.rlike("^[0-9]+-[0-9]+$"))
    return paths.select(F.explode(F.flatten(F.transform(hops, lambda x: F.split(x, "-")))).cast("long").alias("rid")).distinct()


def split_diploid(contigs: DataFrame, short: int = 100_000) -> DataFrame:
    """alternative or primary: both ends on the same path, or one end set and shorter than ``short``."""
    alt = ((F.col("end1") == F.col("end2")) & (F.col("end1") != -1)) | (((F.col("end1") != -1) | (F.col("end2") != -1)) & (F.col("len") < short))
    return contigs.withColumn("kind", F.when(alt, "alternative").otherwise("primary"))


def tour_relations(contigs: DataFrame) -> DataFrame:
    """bubble, spur, bridge or unique, from the paths on which a contig's ends lie."""
    e1, e2 = F.col("end1"), F.col("end2")
    return contigs.withColumn("relation", F.when((e1 == -1) & (e2 == -1), "unique").when(e1 == e2, "bubble").when((e1 == -1) | (e2 == -1), "spur").otherwise("bridge"))


def classify_contigs(contigs: DataFrame, min_len: int = 1000, max_repeat: int = 100) -> DataFrame:
    """PRIM, ALT or DISCARD with the reason, from length and tour relations."""
    r = tour_relations(contigs)
    kind = F.when(F.col("len") < min_len, "DISCARD").when(F.col("relation").isin("bubble", "spur"), "ALT").otherwise("PRIM")
    return r.withColumn("class", kind).withColumn("reason", F.when(F.col("len") < min_len, "LEN").otherwise(""))


def five_prime_filter(sam: DataFrame) -> DataFrame:
    """One row per read name: the row that stays, and its flag.

    One row: kept if its five-prime end is aligned, else marked unmapped. Two rows of which one is five-prime: that one. Else the
    first row, marked unmapped.
    """
    unmapped, reverse = F.col("flag").bitwiseAND(4) != 0, F.col("flag").bitwiseAND(16) != 0
    starts, ends = F.col("cigar").rlike("^[0-9]+M"), F.col("cigar").rlike("M$")
    five = ~unmapped & F.when(reverse, ends).otherwise(starts)
    three = ~unmapped & ~five & F.when(reverse, starts).otherwise(ends)
    kind = F.when(unmapped, "unmapped").when(five, "five").when(three, "three").otherwise("middle")
    g = sam.withColumn("kind", kind).groupBy("qname").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "five").alias("n5"), F.min_by(F.struct("ord", "flag"), "ord").alias("first"), F.min_by(F.struct("ord", "flag"), F.when(F.col("kind") == "five", F.col("ord"))).alias("best"))
    keep = (F.col("n") <= 2) & (F.col("n5") == 1)
    return g.select("qname", F.when(keep, F.col("best.ord")).otherwise(F.col("first.ord")).alias("ord"), F.when(keep, F.col("best.flag")).otherwise(F.col("first.flag").bitwiseOR(4)).alias("flag"))


def combine_mates(r1: DataFrame, r2: DataFrame, min_mapq: int = 10) -> DataFrame:
    """Mates of the same name: both mapped and of ``min_mapq``; flags and signed distance (0 across references)."""
    a = r1.select("qname", *(F.col(c).alias(f"{c}1") for c in ("flag", "rname", "pos", "mapq")))
    b = r2.select("qname", *(F.col(c).alias(f"{c}2") for c in ("flag", "rname", "pos", "mapq")))
    j = a.join(b, "qname").where((F.col("flag1").bitwiseAND(4) == 0) & (F.col("flag2").bitwiseAND(4) == 0) & (F.col("mapq1") >= min_mapq) & (F.col("mapq2") >= min_mapq))
    strand = lambda own, other, first: F.lit(1 + first) + F.when(F.col(own).bitwiseAND(16) != 0, 16).otherwise(0) + F.when(F.col(other).bitwiseAND(16) != 0, 32).otherwise(0)
    dist = F.when(F.col("rname1") == F.col("rname2"), F.col("pos2") - F.col("pos1")).otherwise(0)
    return j.select("qname", strand("flag1", "flag2", 64).alias("flag1"), strand("flag2", "flag1", 128).alias("flag2"), "rname1", "rname2", "pos1", "pos2", dist.alias("tlen"))


def hic_stats(pairs: DataFrame) -> DataFrame:
    """Pairs in all, on one reference by least distance, and across references: one row."""
    same = F.col("rname1") == F.col("rname2")
    far = [F.count_if(same & (F.abs("tlen") >= k * 1000)).alias(f"intra_{k}kb") for k in (1, 10, 15, 20)]
    return pairs.agg(F.count(F.lit(1)).alias("all_pairs"), F.count_if(same).alias("intra"), *far, F.count_if(~same).alias("inter"))
