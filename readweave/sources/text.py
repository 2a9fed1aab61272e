"""Text and table files: reads, masks, annotations, overlaps, graphs, gaps, paths, short-read alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readweave.functions.columns import bit, has


def columns_of(spark: SparkSession, path: str, names: str, sep: str = "\t", comment: str | None = None) -> DataFrame:
    """Rows of a text file cut at ``sep`` into string columns; missing fields are null, blank and comment lines go."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    if comment:
        lines = lines.where(~F.ltrim("value").startswith(comment))
    parts = F.split("value", sep)
    return lines.select(*(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names.split())))


def whole(name: str) -> Column:
    """A field as a long; null where it isn't one."""
    return F.expr(f"try_cast({name} as long)").alias(name)


# Reads

def fasta_text(df: DataFrame, width: int = 80, case: str | None = None, by_len: bool = False, tracks: DataFrame | None = None) -> DataFrame:
    """One ``value`` per record: header (with the intervals of its tracks) and lines of ``width``; ``case`` is upper, lower or None."""
    if tracks is not None:
        args = tracks.groupBy("rid", "track").agg(F.array_sort(F.collect_list(F.struct("beg", "end_"))).alias("_s"))
        text = F.concat("track", F.lit("="), F.concat_ws(",", F.transform("_s", lambda x: F.concat_ws(",", x["beg"], x["end_"]))))
        args = args.select("rid", text.alias("_a")).groupBy("rid").agg(F.array_sort(F.collect_list("_a")).alias("_a"))
        df = df.join(args, "rid", "left").withColumn("header", F.concat_ws(" ", "header", F.concat_ws(" ", "_a"))).withColumn("header", F.rtrim("header"))
    seq = {"upper": F.upper("seq"), "lower": F.lower("seq")}.get(case, F.col("seq"))
    if by_len:
        df = df.orderBy(F.desc(F.length("seq")), "rid")
    return df.select(F.concat(F.lit(">"), "header", F.lit("\n"), F.regexp_replace(seq, rf"(.{{{width}}})(?=.)", "$1\n")).alias("value"))


def show_reads(reads: DataFrame, ranges: list[tuple[int, int]] | None = None, min_len: int = 0, trim: DataFrame | None = None, case_track: DataFrame | None = None) -> DataFrame:
    """rid, seq of chosen reads; cut to the trim; bases inside intervals of ``case_track`` have the other case."""
    df = reads.where(F.length("seq") >= min_len)
    if ranges:
        hit = F.lit(False)
        for a, b in ranges:
            hit = hit | F.col("rid").between(a, b)
        df = df.where(hit)
    df = df.select("rid", "seq")
    if case_track is not None:
        from readweave.operators.intervals import merge_intervals

        spans = merge_intervals(case_track, by=("rid",)).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(F.col("beg").cast("int").alias("b"), F.col("end_").cast("int").alias("e")))).alias("_s"))
        # From interval to interval: what lies before it as it is, its own bases in the other case.
        step = """aggregate(coalesce(_s, array()), struct('' as t, 0 as at), (acc, x) -> struct(
            concat(acc.t, substring(seq, acc.at + 1, x.b - acc.at), translate(substring(seq, x.b + 1, x.e - x.b), 'ACGTNacgtn', 'acgtnACGTN')) as t, x.e as at),
            acc -> concat(acc.t, substring(seq, acc.at + 1)))"""
        df = df.join(spans, "rid", "left").select("rid", F.expr(step).alias("seq"))
    if trim is not None:
        df = df.join(trim.where("tb < te"), "rid").select("rid", F.expr("substring(seq, cast(tb as int) + 1, cast(te - tb as int))").alias("seq"))
    return df


# Interval tracks

def read_mask_txt(spark: SparkSession, path: str, reads: DataFrame, kind: str = "mask", track: str = "mask") -> DataFrame:
    """Lines ``rid beg end`` (kind mask) or ``rid rid`` (kind pair: from, to); ``bad`` marks rows beyond the read, which stay."""
    if kind == "pair":
        return columns_of(spark, path, "r1 r2", r"\s+").select(whole("r1"), whole("r2"))
    rows = columns_of(spark, path, "rid beg end_", r"\s+").select(F.lit(track).alias("track"), whole("rid"), whole("beg"), whole("end_"))
    return bounded(rows, reads)


def bounded(rows: DataFrame, reads: DataFrame) -> DataFrame:
    j = rows.join(reads.select("rid", "rlen"), "rid", "left")
    ok = (F.col("beg") >= 0) & (F.col("beg") < F.col("end_")) & (F.col("end_") <= F.col("rlen"))
    return j.select(*rows.columns, (~F.coalesce(ok, F.lit(False))).alias("bad"))


def read_gff(spark: SparkSession, path: str, reads: DataFrame) -> DataFrame:
    """Rows of a GFF file as intervals: sequences are ``read_<n>`` or numbers, positions count from 1 and become half open."""
    g = columns_of(spark, path, "sequence source track beg end_ score strand extra", "\t", "#")
    rid = F.expr("try_cast(regexp_extract(sequence, '^(?:read_)?([0-9]+)$', 1) as long)")
    rows = g.withColumn("rid", rid).select("track", "rid", (F.expr("try_cast(beg as long)") - 1).alias("beg"), whole("end_"), "strand", "extra")
    return bounded(rows, reads)


def interval_text(iv: DataFrame, prefix: str | None = None, distances: bool = False) -> DataFrame:
    """Text rows of a track: rid, beg, end, after ``prefix``; ``distances`` adds the gap to the interval before."""
    w = Window.partitionBy("track", "rid").orderBy("beg", "end_")
    gap = [F.coalesce((F.col("beg") - F.lag("end_").over(w)).cast("string"), F.lit("-"))] if distances else []
    return iv.select(F.concat_ws(" ", *([F.lit(prefix)] if prefix else []), "rid", "beg", "end_", *gap).alias("value"))


# Overlaps

def write_overlaps(o: DataFrame, path: str, twidth: int = 100, purge: bool = False, parts: int | None = None) -> None:
    """Parquet in canonical order, by ranges of A-reads; TEMP is never written, ``purge`` leaves discarded rows out."""
    from readweave.operators.overlaps import ORDER

    if "flags" in o.columns:
        o = o.where(~has(F.col("flags"), "DISCARD")) if purge else o
        o = o.withColumn("flags", F.col("flags").bitwiseAND(F.lit(~bit("TEMP"))))
    ranged = o.repartitionByRange(parts, "aread") if parts else o.repartitionByRange("aread")
    ranged.withColumn("twidth", F.lit(twidth)).sortWithinPartitions(*ORDER).write.parquet(path)


def read_overlaps(spark: SparkSession, path: str, twidth: int | None = None) -> DataFrame:
    """The table; with ``twidth``, rows of another trace width raise an error when they are read."""
    o = spark.read.parquet(path)
    if twidth is not None:
        o = o.withColumn("twidth", F.when(F.col("twidth") == twidth, F.col("twidth")).otherwise(F.raise_error(F.concat(F.lit("trace width "), "twidth")).cast("int")))
    return o


# Graphs and paths

def graph_text(nodes: DataFrame, edges: DataFrame, form: str = "tgf") -> DataFrame:
    """(part, value): text of a graph, node rows in part 1 and edge rows in part 3; TGF, GML or GraphML. nodes: (rid, rlen, flags)."""
    n, e = ("rid", "rlen", "flags"), ("src", "dst", "side", "ovh", "div")
    if form == "tgf":
        node, edge, frame = F.format_string("%s %s %s", *n), F.format_string("%s %s %s %s %s", *e), [(2, "#")]
    elif form == "gml":
        node = F.format_string("  node [ id %s length %s flags %s ]", *n)
        edge, frame = F.format_string('  edge [ source %s target %s end "%s" length %s divergence %s ]', *e), [(0, "graph [\n  directed 1"), (4, "]")]
    elif form == "graphml":
        node = F.format_string('    <node id="%s"><data key="length">%s</data><data key="flags">%s</data></node>', *n)
        edge = F.format_string('    <edge source="%s" target="%s"><data key="end">%s</data><data key="length">%s</data><data key="divergence">%s</data></edge>', *e)
        frame = [(0, '<graphml>\n  <graph edgedefault="directed">'), (4, "  </graph>\n</graphml>")]
    else:
        raise ValueError(f"graph format {form} is not known")
    rows = nodes.select(F.lit(1).alias("part"), F.col("rid").alias("k"), node.alias("value")).unionByName(edges.select(F.lit(3).alias("part"), F.col("src").alias("k"), edge.alias("value")))
    rest = nodes.sparkSession.createDataFrame([(p, 0, t) for p, t in frame], "part int, k long, value string")
    return rows.unionByName(rest)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, form: str = "tgf") -> None:
    """Text files that, in the order of their names, are the graph."""
    graph_text(nodes, edges, form).orderBy("part", "k", "value").select("value").write.text(path)


def read_tgf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (rid, rlen, flags) and edges (src, dst, side, ovh, div); rows are told apart by their number of fields, so files may be split."""
    f = spark.read.text(path).where("trim(value) not in ('', '#')").select(F.split(F.trim("value"), r"\s+").alias("f"))
    long = lambda i, n: F.get("f", F.lit(i)).cast("long").alias(n)
    nodes = f.where(F.size("f") == 3).select(long(0, "rid"), long(1, "rlen"), long(2, "flags"))
    return nodes, f.where(F.size("f") == 5).select(long(0, "src"), long(1, "dst"), F.get("f", F.lit(2)).alias("side"), long(3, "ovh"), long(4, "div"))


def path_text(paths: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """Rows ``PATH id e1 e2 a-b b-c ...`` of paths (path, rank, rid); e1 and e2 are the paths at its ends, or -1."""
    g = paths.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("rank", "rid"))).alias("_r"))
    g = g.join(ends, "path", "left") if ends is not None else g.withColumn("e1", F.lit(-1)).withColumn("e2", F.lit(-1))
    hops = F.expr("transform(sequence(1, size(_r) - 1), i -> concat(_r[i - 1].rid, '-', _r[i].rid))")
    return g.select(F.concat_ws(" ", F.lit("PATH"), "path", F.coalesce("e1", F.lit(-1)), F.coalesce("e2", F.lit(-1)), F.when(F.size("_r") > 1, F.concat_ws(" ", hops))).alias("line"))


# Contig evidence and short reads

def read_gap(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    """Optical-map gaps between two named contigs; rows of a contig with itself go, unknown names have a null cid."""
    from readweave.operators.lift import resolve_names

    g = columns_of(spark, path, "name1 name2 scaffold xmap_gap adj_gap len1 len2", "\t", "#").where("name1 <> name2")
    for k in ("1", "2"):
        ids = resolve_names(g.select(F.col(f"name{k}").alias("name")).distinct(), contigs).select(F.col("name").alias(f"name{k}"), F.col("cid").alias(f"cid{k}"), F.col("sub_beg").alias(f"sub_beg{k}"), F.col("sub_end").alias(f"sub_end{k}"))
        g = g.join(ids, f"name{k}", "left")
    gap = [F.expr(f"try_cast({c} as double)").alias(c) for c in ("xmap_gap", "adj_gap")]
    return g.select("cid1", "cid2", "name1", "name2", "scaffold", *gap, whole("len1"), whole("len2"), "sub_beg1", "sub_end1", "sub_beg2", "sub_end2")


def read_agp(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an AGP file; components (not gaps) have beg and end_ on their contig, half open."""
    a = columns_of(spark, path, "obj obj_start obj_end part type f6 f7 f8 f9", "\t", "#")
    gap = F.col("type").isin("N", "U")
    return a.select("obj", whole("obj_start"), whole("obj_end"), whole("part"), "type", F.when(~gap, F.col("f6")).alias("name"), F.when(~gap, F.expr("try_cast(f7 as long)") - 1).alias("beg"), F.when(~gap, F.expr("try_cast(f8 as long)")).alias("end_"), F.when(~gap, F.col("f9")).alias("strand"), F.when(gap, F.expr("try_cast(f6 as long)")).alias("gap"))


def agp_splits(agp: DataFrame) -> DataFrame:
    """Places (name, pos) at which the map cut a contig: where two parts of it meet on different objects or out of order."""
    w = Window.partitionBy("name").orderBy("beg", "end_")
    p = agp.where("name is not null").withColumn("_n", F.lead("beg").over(w)).withColumn("_o", F.lead(F.struct("obj", "part")).over(w))
    apart = (F.col("_o.obj") != F.col("obj")) | (F.abs(F.col("_o.part") - F.col("part")) != 1)
    return p.where(F.col("_n").isNotNull() & apart).select("name", F.col("end_").alias("pos"))


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Alignments (qname, ord, flag, rname, pos, mapq, cigar) and the header lines. ``ord`` counts the rows of a name in file order."""
    raw = spark.read.text(path).select("value", F.input_file_name().alias("_f"), F.monotonically_increasing_id().alias("_i"))
    head = raw.where(F.col("value").startswith("@")).select("value")
    parts = F.split("value", "\t")
    rows = raw.where(~F.col("value").startswith("@") & (F.col("value") != "")).select("_f", "_i", *(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate("qname flag rname pos mapq cigar".split())))
    w = Window.partitionBy("qname").orderBy("_f", "_i")
    return rows.select("qname", F.row_number().over(w).alias("ord"), whole("flag"), "rname", whole("pos"), whole("mapq"), "cigar"), head
