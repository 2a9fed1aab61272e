"""Walks through the overlap graph: the best next read, paths, contigs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions.columns import reverse_complement
from readweave.functions.lineage import settled

from .graph import components, set_checkpoints


def with_entry(edges: DataFrame) -> DataFrame:
    """Adds ``enter``, the side of dst that meets src: the side of the edge back. Edges without one go."""
    back = edges.select(F.col("src").alias("dst"), F.col("dst").alias("src"), F.col("side").alias("enter"))
    return edges.join(back, ["src", "dst"]).dropDuplicates(["src", "side", "dst", "enter"])


#: Sides of reads in one part of their walks.
SIDES = 5000


def best_next(edges: DataFrame, lookahead: int = 6, max_walks: int = 1000) -> DataFrame:
    """src, side, dst: the first hop towards the read that most strand-consistent walks of up to ``lookahead`` steps pass.

    Each (src, side) follows at most ``max_walks`` walks, the ones over the smallest read ids; a read met more often wins, then one met
    earlier, then the smaller id.
    """
    set_checkpoints(edges.sparkSession)
    hop = F.struct("dst", F.when(F.col("enter") == "l", "r").otherwise("l").alias("leave"))
    # Neighbours of a read's side as a list, so that a walk without any stays in the same join.
    step = with_entry(edges).groupBy(F.col("src").alias("at"), F.col("side").alias("out")).agg(F.array_sort(F.collect_list(hop)).alias("_to")).checkpoint()
    # Walks lie in parts of SIDES sides each, however many there are: a task sorts no more than those can have.
    parts = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), step.count() // SIDES)
    step = step.repartition(parts, "at", "out")
    walks = step.select(F.col("at").alias("src"), F.col("out").alias("side"), F.explode("_to").alias("_n")).select("src", "side", F.array("_n.dst").alias("path"), F.col("_n.dst").alias("at"), F.col("_n.leave").alias("out"))
    cap = Window.partitionBy("src", "side").orderBy("path")
    for _ in range(lookahead - 1):
        fresh = F.filter("_to", lambda x: ~F.array_contains("path", x["dst"]) & (x["dst"] != F.col("src")))
        # A walk that can't go on, or only back into itself, stays as it is.
        on = walks.repartition(parts, "at", "out").join(step.hint("merge"), ["at", "out"], "left").withColumn("_n", F.explode_outer(F.slice(fresh, 1, max_walks)))
        stop = F.col("_n").isNull()
        walks = on.select("src", "side", F.when(stop, F.col("path")).otherwise(F.concat("path", F.array("_n.dst"))).alias("path"), F.coalesce("_n.dst", "at").alias("at"), F.coalesce("_n.leave", "out").alias("out"))
        walks = walks.repartition(parts, "src", "side").withColumn("_r", F.row_number().over(cap)).where(F.col("_r") <= max_walks).drop("_r")
    met = walks.select("src", "side", F.element_at("path", 1).alias("dst"), F.posexplode("path").alias("at", "node"))
    hits = met.groupBy("src", "side", "node").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("at", "dst")).alias("_f"))
    pick = Window.partitionBy("src", "side").orderBy(F.desc("n"), "_f.at", "node")
    return hits.withColumn("_r", F.row_number().over(pick)).where("_r = 1").select("src", "side", "_f.dst", "node", "n")


def build_paths(edges: DataFrame, best: DataFrame) -> DataFrame:
    """path, rank, rid, comp: maximal paths of reads that are each other's best next; comp = 1 where a read lies reversed.

    A path starts at its end with the smaller rid. A circle is cut before its smallest rid. Ranks come by pointer doubling: the number of
    rounds is the logarithm of the longest path, and lineage is cut in each.
    """
    set_checkpoints(edges.sparkSession)
    e = with_entry(edges).join(best.select("src", "side", "dst"), ["src", "side", "dst"], "left_semi").select("src", "side", "dst", "enter")
    back = e.select(F.col("dst").alias("src"), F.col("enter").alias("side"), F.col("src").alias("dst"), F.col("side").alias("enter"))
    return chain_links(e.join(back, ["src", "side", "dst", "enter"], "left_semi"))


def chain_links(links: DataFrame) -> DataFrame:
    """path, rank, rid, comp from links that run both ways (src, side, dst, enter), each side of a node in one of them at most: see ``build_paths``."""
    set_checkpoints(links.sparkSession)
    links = links.checkpoint()
    comp = components(links).withColumnRenamed("component", "path")
    ring = links.groupBy("src").agg(F.count(F.lit(1)).alias("_d")).join(comp.withColumnRenamed("rid", "src"), "src").groupBy("path").agg(F.min("_d").alias("_d")).where("_d > 1").select("path")
    # The smallest read of a ring loses its link on the left, and its partner there the link back.
    cut = links.where("side = 'l'").join(ring.withColumnRenamed("path", "src"), "src", "left_semi").select("src", "side", "dst", "enter")
    gone = cut.unionByName(cut.select(F.col("dst").alias("src"), F.col("enter").alias("side"), F.col("src").alias("dst"), F.col("side").alias("enter")))
    links = links.join(gone, ["src", "side", "dst", "enter"], "left_anti")

    # A state is a read with the side it is left by; ``to`` is the state ``dist`` steps on.
    states = links.select("src").distinct().select(F.col("src").alias("rid"), F.explode(F.array(F.lit("l"), F.lit("r"))).alias("side"))
    hop = links.select(F.col("src").alias("rid"), "side", F.col("dst").alias("to"), F.when(F.col("enter") == "l", "r").otherwise("l").alias("tside"))
    jump = states.join(hop, ["rid", "side"], "left").select("rid", "side", F.coalesce("to", "rid").alias("to"), F.coalesce("tside", "side").alias("tside"), F.col("to").isNotNull().cast("long").alias("dist")).checkpoint()
    while True:
        ahead = jump.select(F.col("rid").alias("to"), F.col("side").alias("tside"), F.col("to").alias("_to"), F.col("tside").alias("_ts"), F.col("dist").alias("_d"))
        jump2 = jump.join(ahead, ["to", "tside"]).select("rid", "side", F.col("_to").alias("to"), F.col("_ts").alias("tside"), (F.col("dist") + F.col("_d")).alias("dist"), (F.col("_d") > 0).alias("_moved")).checkpoint()
        moved = jump2.where("_moved").limit(1).count()
        jump = jump2.drop("_moved")
        if not moved:
            break
    ends = jump.groupBy("rid").agg(F.max(F.when(F.col("side") == "l", F.struct("to", "dist"))).alias("l"), F.max(F.when(F.col("side") == "r", F.struct("to", "dist"))).alias("r"))
    left_first = F.col("l.to") < F.col("r.to")
    return ends.select("rid", F.least("l.to", "r.to").alias("path"), F.when(left_first, F.col("l.dist")).otherwise(F.col("r.dist")).alias("rank"), F.when(left_first, 0).otherwise(1).alias("comp"))


def join_path_ends(paths: DataFrame, optional: DataFrame) -> DataFrame:
    """Optional edges (src, dst) that join the ends of two paths where the choice is unique in both directions."""
    w = Window.partitionBy("path")
    ends = paths.withColumn("_m", F.max("rank").over(w)).where("rank = 0 or rank = _m").select("rid", "path")
    e = optional.select("src", "dst").distinct().join(ends.toDF("src", "p1"), "src").join(ends.toDF("dst", "p2"), "dst").where("p1 <> p2")
    one = e.withColumn("_a", F.count(F.lit(1)).over(Window.partitionBy("src"))).withColumn("_b", F.count(F.lit(1)).over(Window.partitionBy("dst")))
    return one.where("_a = 1 and _b = 1").select("src", "dst", "p1", "p2")


def suppress_paths(paths: DataFrame, edges: DataFrame, max_dist: int = 3) -> DataFrame:
    """Rows of ``paths`` that may be paths of their own: longest first (then by the smaller path), one goes if all its reads lie less than ``max_dist`` edges from paths that stay.

    Distances run along ``edges`` (src, dst, both ways), from a path's own reads as 0. Each round decides all paths that no longer and undecided
    one comes near, so that rounds follow how paths depend on each other and not their number; lineage is cut in each.
    """
    both = settled(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    key = F.struct((-F.count(F.lit(1))).alias("n"), F.col("path").alias("p")).alias("key")
    nodes = settled(paths.select("path", "rid").join(paths.groupBy("path").agg(key), "path"))

    def spread(labels: DataFrame) -> DataFrame:
        """The least label among the reads less than max_dist edges away."""
        for _ in range(max_dist - 1):
            there = both.join(labels.withColumnRenamed("rid", "src"), "src").select(F.col("dst").alias("rid"), "key")
            labels = labels.unionByName(there).groupBy("rid").agg(F.min("key").alias("key"))
        return labels

    open_, stays, covered = nodes, None, None
    while True:
        if covered is not None:
            gone = open_.join(covered.withColumn("_in", F.lit(1)), "rid", "left").groupBy("path").agg(F.count_if(F.col("_in").isNull()).alias("_o")).where("_o = 0")
            open_ = settled(open_.join(gone, "path", "left_anti"))
        if open_.isEmpty():
            break
        near = spread(open_.select("rid", "key"))
        first = open_.join(near.withColumnRenamed("key", "_k"), "rid").groupBy("path", "key").agg(F.min("_k").alias("_k")).where("_k = key").select("path")
        new = settled(open_.join(first, "path", "left_semi"))
        stays = new if stays is None else stays.unionByName(new)
        reach = spread(new.select("rid", "key")).select("rid")
        covered = settled(reach if covered is None else covered.unionByName(reach).distinct())
        open_ = open_.join(new.select("path").distinct(), "path", "left_anti")
    return paths.join(stays.select("path").distinct(), "path", "left_semi") if stays is not None else paths


def join_paths(paths: DataFrame, optional: DataFrame) -> DataFrame:
    """path, rank, rid, comp: paths joined at their ends over optional edges (src, dst), where a choice is unique in both directions.

    Edges count both ways, so that an end that is taken was nobody else's choice, and one pass is the fixed point. Any number of paths in a row
    becomes one path with ranks anew; the rest stays as it is. A circle of paths is cut before its smallest.
    """
    w = Window.partitionBy("path")
    ends = paths.withColumn("_m", F.max("rank").over(w)).where("rank = 0 or rank = _m").where("_m > 0").select("rid", "path", F.when(F.col("rank") == 0, "l").otherwise("r").alias("side"))
    e = optional.select("src", "dst").unionByName(optional.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    choices = settled(e.join(ends.toDF("src", "p1", "s1"), "src").join(ends.toDF("dst", "p2", "s2"), "dst").where("p1 <> p2").distinct())
    one = choices.withColumn("_a", F.count(F.lit(1)).over(Window.partitionBy("src"))).withColumn("_b", F.count(F.lit(1)).over(Window.partitionBy("dst")))
    taken = settled(one.where("_a = 1 and _b = 1").drop("_a", "_b"))
    if taken.isEmpty():
        return paths.select("path", "rank", "rid", "comp")
    order = chain_links(taken.select(F.col("p1").alias("src"), F.col("s1").alias("side"), F.col("p2").alias("dst"), F.col("s2").alias("enter")))
    order = order.select(F.col("rid").alias("path"), F.col("path").alias("joined"), F.col("rank").alias("place"), F.col("comp").alias("turned"))
    size = paths.groupBy("path").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("joined").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    order = order.join(size, "path").withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    j = paths.join(order, "path", "left")
    rank = F.when(F.col("joined").isNull(), F.col("rank")).otherwise(F.col("start") + F.when(F.col("turned") == 1, F.col("size") - 1 - F.col("rank")).otherwise(F.col("rank")))
    return j.select(F.coalesce("joined", "path").alias("path"), rank.alias("rank"), "rid", F.when(F.col("turned") == 1, 1 - F.col("comp")).otherwise(F.col("comp")).alias("comp"))


def path_to_contigs(paths: DataFrame, reads: DataFrame, trim: DataFrame, edges: DataFrame) -> DataFrame:
    """path, header, seq: the first trimmed read of each path, then from each next read what its edge hangs over."""
    w = Window.partitionBy("path").orderBy("rank")
    p = paths.withColumn("_prev", F.lag("rid").over(w))
    ovh = edges.groupBy(F.col("src").alias("_prev"), F.col("dst").alias("rid")).agg(F.min("ovh").alias("ovh"))
    j = p.join(ovh, ["_prev", "rid"], "left").join(reads.select("rid", "seq"), "rid").join(trim.select("rid", "tb", "te"), "rid")
    body = F.expr("substring(seq, cast(tb as int) + 1, cast(te - tb as int))")
    turned = F.when(F.col("comp") == 1, reverse_complement(body)).otherwise(body)
    j = j.withColumn("_s", turned).withColumn("_piece", F.when(F.col("_prev").isNull(), F.col("_s")).otherwise(F.expr("right(_s, cast(coalesce(ovh, 0) as int))")))
    g = j.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("rank", "rid", F.col("_piece").alias("piece")))).alias("_p"))
    return g.select("path", F.concat(F.lit("path="), "path", F.lit(" reads="), F.concat_ws(",", F.transform("_p", lambda x: x["rid"].cast("string")))).alias("header"), F.concat_ws("", F.transform("_p", lambda x: x["piece"])).alias("seq"))
