"""Reads: ingest filters, windows, motifs, k-mers, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readweave.functions.columns import MOTIFS, reverse_complement

from .letters import count_kmers, few_places, meet_places, repeated_triplets, send_places
from .numbering import runs_of


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: header, seq. Wrapped lines are joined."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    body = F.regexp_replace("value", r"^>", "")
    header = F.regexp_extract(body, r"^([^\n]*)", 1)
    return raw.select(header.alias("header"), F.regexp_replace(F.regexp_replace(body, r"^[^\n]*", ""), r"\s", "").alias("seq")).where("header <> '' or seq <> ''")


def fasta_rows(df: DataFrame, width: int = 80) -> DataFrame:
    """One text per record, wrapped at ``width``."""
    lines = F.regexp_replace("seq", rf"(.{{{width}}})(?=.)", "$1\n")
    return df.select(F.concat(F.lit(">"), F.col("header"), F.lit("\n"), lines).alias("value"))


def write_fasta(df: DataFrame, path: str, width: int = 80) -> None:
    fasta_rows(df, width).write.text(path)


def parse_headers(df: DataFrame, keep: list[str]) -> DataFrame:
    """``name=v1,v2`` arguments of a header as rows (header, name, pos, value)."""
    pairs = F.filter(F.split("header", r"\s+"), lambda x: x.contains("="))
    d = df.select("header", F.explode(pairs).alias("_p"))
    d = d.select("header", F.split_part("_p", F.lit("="), F.lit(1)).alias("name"), F.split_part("_p", F.lit("="), F.lit(2)).alias("_v"))
    return d.where(F.col("name").isin(keep)).select("header", "name", F.posexplode(F.split("_v", ",")).alias("pos", "value"))


def filter_reads(df: DataFrame, min_len: int = 1000, full_hq: bool = False) -> DataFrame:
    """Reads of ``min_len`` or more; ``full_hq``: only those whose header gives one readType, of 1 or 2."""
    long = df.where(F.length("seq") >= min_len)
    return long.where(F.regexp_extract("header", r"(?:^|\s)readType=(\S*)", 1).isin("1", "2")) if full_hq else long


def best_per_well(df: DataFrame) -> DataFrame:
    """Of each run of consecutive reads of one well, the first longest. Columns: file, seq_id, well, rlen."""
    best = F.max_by(F.struct(*df.columns), F.struct("rlen", -F.col("seq_id"))).alias("_best")
    return runs_of(df, "well", "seq_id", "file").groupBy("file", "run").agg(best).select("_best.*")


def split_scaffolds(df: DataFrame) -> DataFrame:
    """Runs of ACGT of each scaffold with their number and offset (rid, ix, off, seq)."""
    parts = F.regexp_extract_all("seq", F.lit(r"([ACGTacgt]+|[^ACGTacgt]+)"), 1)
    p = df.select("rid", F.posexplode(parts).alias("_k", "seq"))
    w = Window.partitionBy("rid").orderBy("_k")
    p = p.withColumn("off", F.sum(F.length("seq")).over(w) - F.length("seq")).where(F.col("seq").rlike("^[ACGTacgt]"))
    return p.withColumn("ix", F.row_number().over(w) - 1).select("rid", "ix", "off", "seq")


def join_scaffolds(parts: DataFrame) -> DataFrame:
    """Parts joined again with N over the gaps."""
    w = Window.partitionBy("rid").orderBy("ix")
    p = parts.withColumn("_gap", F.col("off") - F.coalesce(F.lag(F.col("off") + F.length("seq")).over(w), F.lit(0)))
    p = p.withColumn("_s", F.concat(F.repeat(F.lit("N"), F.col("_gap").cast("int")), "seq"))
    return p.groupBy("rid").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("ix", "_s"))), lambda x: x["_s"])).alias("seq"))


def split_reads(df: DataFrame, max_len: int = 5000, overlap: int = 1000) -> DataFrame:
    """Windows of ``max_len`` that overlap; the last two share evenly what would leave a short rest."""
    step = max_len - overlap
    n = F.when(F.length("seq") <= max_len, 1).otherwise(F.ceil((F.length("seq") - overlap) / step)).cast("int")
    d = df.select("rid", "seq", F.length("seq").alias("_l"), n.alias("_n")).withColumn("win", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    rest = F.col("_l") - (F.col("_n") - 1) * step
    short = (F.col("_n") > 1) & (rest < overlap + 1500)
    half = F.floor((F.col("_l") - (F.col("_n") - 2) * step + overlap) / 2)
    beg = F.when(short & (F.col("win") == F.col("_n") - 1), F.col("_l") - half).otherwise(F.col("win") * step)
    end = F.when(F.col("win") == F.col("_n") - 1, F.col("_l")).when(short & (F.col("win") == F.col("_n") - 2), F.col("win") * step + half).otherwise(F.col("win") * step + max_len)
    return d.select("rid", "win", beg.cast("int").alias("beg"), end.cast("int").alias("end_"), "seq").withColumn("seq", F.expr("substr(seq, beg + 1, end_ - beg)"))


def trim_lower_tips(df: DataFrame) -> DataFrame:
    """Lower-case letters at both ends go; ``garbage`` marks sequences without upper case."""
    return df.withColumn("trimmed", F.regexp_replace(F.regexp_replace("seq", "^[a-z]+", ""), "[a-z]+$", "")).withColumn("garbage", F.col("trimmed") == "")


def motif_positions(df: DataFrame, enzyme: str) -> DataFrame:
    """1-based places of a restriction site, overlapping ones included."""
    m = MOTIFS[enzyme]
    # In chunks of 64 starts, as finding a place in a long read takes steps through all letters before it.
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("seq") - len(m)) / 64).cast("int")), lambda c: F.lower(F.substr("seq", c * 64 + 1, F.lit(63 + len(m)))))
    d = df.where(F.length("seq") >= len(m)).select("rid", F.posexplode(cut).alias("_c", "_s")).where(F.contains("_s", F.lit(m)))
    at = F.filter(F.sequence(F.lit(1), F.length("_s") - len(m) + 1), lambda i: F.substr("_s", i, F.lit(len(m))) == m)
    return d.select("rid", "_c", F.explode(at).alias("_p")).select("rid", (F.col("_c") * 64 + F.col("_p")).alias("pos"))


def read_stats(reads: DataFrame, bin_: int = 1000) -> DataFrame:
    """Histogram of read lengths with counts and bases from the longest bin on."""
    h = reads.withColumn("bin", F.floor(F.length("seq") / bin_) * bin_).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("seq")).alias("bases"))
    w = Window.orderBy(F.desc("bin"))  # one row for each bin
    return h.withColumn("cum_n", F.sum("n").over(w)).withColumn("cum_bases", F.sum("bases").over(w))


def base_counts(reads: DataFrame) -> DataFrame:
    """One row: reads, bases and each base's count."""
    count = lambda b: F.sum(F.length("seq") - F.length(F.replace(F.col("seq"), F.lit(b)))).alias(f"n_{b}")
    return reads.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("seq")).alias("bases"), *map(count, "acgt"))


def chunks(reads: DataFrame, k: int, chunk: int) -> DataFrame:
    """rid, _c, _s: stretches that hold ``chunk`` starts of k-mers each (the last one fewer), spread by hash, which evens out long reads."""
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("seq") - k) / chunk).cast("int")), lambda c: F.substr("seq", c * chunk + 1, F.lit(chunk + k - 1)))
    return reads.where(F.length("seq") >= k).select("rid", F.posexplode(cut).alias("_c", "_s")).repartition("rid", "_c")


def kmers(reads: DataFrame, k: int, chunk: int = 256) -> DataFrame:
    """rid, pos (from 1), kmer.

    Reads are cut into chunks of ``chunk`` starts first, so that no k-mer row carries or scans its whole read; to spread them
    moves a small part of what the k-mers weigh.
    """
    d = chunks(reads, k, chunk).select("rid", "_c", "_s", F.explode(F.sequence(F.lit(1), F.length("_s") - k + 1)).alias("_p"))
    return d.select("rid", (F.col("_c") * chunk + F.col("_p")).alias("pos"), F.substr("_s", F.col("_p"), F.lit(k)).alias("kmer"))


def kmer_places(reads: DataFrame, k: int) -> DataFrame:
    """code, kmer, c: how often each k-mer occurs. ``code`` stands for k-mers of a, c, g and t, two bits a letter, ``kmer`` for others.

    Tasks count before they send, so rows are those of different k-mers and not of all places.
    """
    some = chunks(reads, k, 4096).select("_s").mapInArrow(count_kmers(k), "code long, kmer string, n long")
    # Tasks have counted: to do so once more before rows are sent would only fill their memory.
    return some.repartition("code", "kmer").groupBy("code", "kmer").agg(F.sum("n").alias("c"))


def kmer_counts(reads: DataFrame, k: int) -> DataFrame:
    return kmer_places(reads, k).select(F.coalesce("kmer", kmer_text(F.col("code"), k)).alias("kmer"), F.least("c", F.lit(255)).alias("n"))


def kmer_histogram(reads: DataFrame, k: int) -> DataFrame:
    return kmer_places(reads, k).groupBy(F.least("c", F.lit(255)).alias("n")).agg(F.count(F.lit(1)).alias("kmers"))


#: k-mer places in one part: a task holds those of a part at once, some 60 to 100 bytes each.
PART = 2_000_000
#: Places in one stretch of a read that is sent with its k-mers.
STRETCH = 32_768


def packed_places(reads: DataFrame, k: int, below: int, both_strands: bool = False, together: bool = False) -> DataFrame:
    """All places of k-mers of a, c, g and t as packed rows (see ``send_places``), one partition for each part of them; ``k`` is 31 at most.

    The parts are as many as PART asks for, and no fewer than shuffles have: what a task holds doesn't grow with the table. A k-mer of
    ``below`` places or more sends no more than that from each task.
    """
    usual = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    letters = reads.agg(F.sum(F.length("seq"))).first()[0] or 0
    parts = max(usual, -(-letters * (2 if both_strands else 1) // PART))
    rows = chunks(reads, k, STRETCH).select(F.coalesce(F.col("rid").cast("long"), F.lit(NO_RID)).alias("rid"), "_c", "_s", F.lit(0).alias("strand"))
    if both_strands:
        turned = reads.withColumn("seq", reverse_complement(F.col("seq")))
        rows = rows.unionByName(chunks(turned, k, STRETCH).select(F.coalesce(F.col("rid").cast("long"), F.lit(NO_RID)).alias("rid"), "_c", "_s", F.lit(1).alias("strand")))
    sent = rows.mapInArrow(send_places(k, STRETCH, below, parts, together), "part int, code binary, off binary, rid binary, pos binary, n binary, strand int")
    return sent.repartitionById(parts, "part")


#: Stands for a read without a number while places are packed.
NO_RID = -(2**63)


def with_rids(places: DataFrame, reads: DataFrame, *names: str) -> DataFrame:
    kind = reads.schema["rid"].dataType
    return places.withColumns({n: F.nullif(F.col(n), F.lit(NO_RID)).cast(kind) for n in names})


def kmer_text(code: Column, k: int) -> Column:
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "acgt")


def other_kmers(reads: DataFrame, k: int) -> DataFrame:
    """rid, pos, kmer of k-mers with other letters than a, c, g and t (``k`` over 31: of all)."""
    if k > 31:
        return kmers(reads, k)
    return kmers(reads.where(F.col("seq").rlike("[^acgt]")), k).where(F.col("kmer").rlike("[^acgt]"))


def rare_kmers(reads: DataFrame, k: int, below: int) -> DataFrame:
    """rid, pos, kmer, n: places of the k-mers that occur ``n`` times, fewer than ``below``. No row of a place is sent."""
    # Other letters are few, and a window holds no more than ``below`` of a k-mer from each task.
    w = Window.partitionBy("kmer")
    odd = other_kmers(reads, k).withColumn("_r", F.row_number().over(w.orderBy("rid", "pos"))).where(F.col("_r") <= below).withColumn("n", F.max("_r").over(w).cast("long")).where(F.col("n") < below)
    odd = odd.select("rid", F.col("pos").cast("long").alias("pos"), "kmer", "n")
    if k > 31:
        return odd
    got = packed_places(reads, k, below).mapInArrow(few_places(k, below), "rid long, pos long, code long, n long")
    return with_rids(got, reads, "rid").select("rid", "pos", kmer_text(F.col("code"), k).alias("kmer"), "n").unionByName(odd)


def cap_kmers(reads: DataFrame, k: int, t: int) -> DataFrame:
    """rid, pos, kmer: k-mers that occur fewer than ``t`` times."""
    return rare_kmers(reads, k, t).drop("n")


def choose_cap(reads: DataFrame, k: int, budget: int) -> DataFrame:
    """The largest cap whose pairs stay within ``budget``: one row."""
    h = kmer_places(reads, k).groupBy("c").agg((F.count(F.lit(1)) * F.col("c") * F.col("c")).alias("pairs"))
    w = Window.orderBy("c")  # one row for each count
    return h.withColumn("_run", F.sum("pairs").over(w)).where(F.col("_run") <= budget).agg((F.max("c") + 1).alias("cap"))


def scaled_cap(reads: DataFrame, k: int, pairs: int) -> DataFrame:
    """The largest cap whose pairs stay within ``pairs`` for each k-mer place of the table, whatever its size: one row."""
    h = kmer_places(reads, k).groupBy("c").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("c")  # one row for each count
    h = h.withColumn("_run", F.sum(F.col("_n") * F.col("c") * F.col("c")).over(w)).withColumn("_all", F.sum(F.col("_n") * F.col("c")).over(Window.partitionBy()))
    return h.where(F.col("_run") <= pairs * F.col("_all")).agg((F.max("c") + 1).alias("cap"))


def mask_kmers(reads: DataFrame, iv: DataFrame, k: int) -> DataFrame:
    """rid, pos, kmer: k-mers that touch no interval of their read.

    The intervals of a read meet it as one array, and k-mers are made of the stretches between them: no row of a k-mer is sent.
    """
    from .intervals import merge_intervals

    spans = merge_intervals(iv.select("rid", "beg", "end_"), by=("rid",)).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("beg", "end_"))).alias("_iv"))
    d = reads.select("rid", "seq", F.length("seq").alias("_l")).where(F.length("seq") >= k).join(spans, "rid", "left")
    none = F.array().cast(spans.schema["_iv"].dataType)
    # A stretch goes from the end of an interval to the begin of the next.
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.coalesce("_iv", none), lambda x: F.greatest(x["end_"], F.lit(0)).cast("long")))
    ends = F.concat(F.transform(F.coalesce("_iv", none), lambda x: F.least(x["beg"], F.col("_l")).cast("long")), F.array(F.col("_l").cast("long")))
    free = F.filter(F.arrays_zip(begins.alias("b"), ends.alias("e")), lambda x: x["e"] - x["b"] >= k)
    d = d.select("rid", "seq", F.explode(free).alias("_x"))
    # In chunks, so that no k-mer scans its read.
    d = d.select("rid", "_x.b", F.expr("substr(seq, cast(_x.b as int) + 1, cast(_x.e - _x.b as int))").alias("seq"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("seq") - k) / 256).cast("int")), lambda c: F.substr("seq", c * 256 + 1, F.lit(255 + k)))
    d = d.select("rid", "b", F.posexplode(cut).alias("_c", "_s")).select("rid", "b", "_c", "_s", F.explode(F.sequence(F.lit(1), F.length("_s") - k + 1)).alias("_p"))
    return d.select("rid", (F.col("b") + F.col("_c") * 256 + F.col("_p")).alias("pos"), F.substr("_s", F.col("_p"), F.lit(k)).alias("kmer"))


def seed_pairs(reads: DataFrame, k: int, cap: int | DataFrame, both_strands: bool = False) -> DataFrame:
    """Pairs of reads a < b that share a k-mer below the cap: aread, bread, comp, apos, bpos; where comp is 1, bpos counts on the turned read.

    Of each k-mer no more than ``cap`` places are sent by a task (a number; of a one-row table, what it says), so a k-mer that a third of all
    places hold sends no more than the cap from each, and the groups that pairs are made from are smaller than it. Places go packed.
    """
    if isinstance(cap, DataFrame):
        row = cap.select("cap").first()
        cap = int(row.cap) if row is not None and row.cap is not None else 0
    km = other_kmers(reads, k).withColumn("comp", F.lit(0))
    if both_strands:
        km = km.unionByName(other_kmers(reads.withColumn("seq", reverse_complement(F.col("seq"))), k).withColumn("comp", F.lit(1)))
    own = Window.partitionBy("kmer", "comp") if both_strands else Window.partitionBy("kmer")
    km = km.withColumn("_r", F.row_number().over(own.orderBy("rid", "pos")))
    few = km.where(F.col("_r") <= cap).withColumn("_n", F.max("_r").over(own)).where(F.col("_n") < cap)
    place = F.struct("rid", "pos", "comp")
    met = few.groupBy("kmer").agg(F.collect_list(F.when(F.col("comp") == 0, place)).alias("a"), F.collect_list(place).alias("b")).where(F.size("b") > 1)
    pairs = met.select(F.explode("a").alias("a"), "b").select("a", F.explode("b").alias("b")).where("a.rid < b.rid")
    odd = pairs.select(F.col("a.rid").alias("aread"), F.col("b.rid").alias("bread"), "b.comp", F.col("a.pos").cast("long").alias("apos"), F.col("b.pos").cast("long").alias("bpos"))
    if k > 31:
        return odd
    # Seeds of a pair that follow each other are made by the same task, which counts them before it sends.
    got = packed_places(reads.where("rid is not null"), k, cap, both_strands, together=True)
    return with_rids(got.mapInArrow(meet_places(k, cap), "aread long, bread long, comp int, apos long, bpos long"), reads, "aread", "bread").unionByName(odd)


def band_scores(seeds: DataFrame, k: int, w: int = 6, h: int = 35) -> DataFrame:
    """Bands of diagonals whose covered bases, with the next band's, reach ``h``, and the extent of their seeds."""
    pair, key = ["aread", "bread", "comp"], ["aread", "bread", "comp", "band"]
    # Seeds go to their pair once; a band meets the next one there.
    d = seeds.withColumn("band", F.floor((F.col("apos") - F.col("bpos")) / (1 << w))).repartition(*pair)
    lag = F.lag("apos").over(Window.partitionBy(*key).orderBy("apos", "bpos"))
    s = d.withColumn("_c", F.least(F.lit(k), F.coalesce(F.col("apos") - lag, F.lit(k)))).groupBy(*key).agg(F.sum("_c").alias("score"), F.min("apos").alias("amin"), F.max("apos").alias("amax"))
    up = Window.partitionBy(*pair).orderBy("band")
    following = F.when(F.lead("band").over(up) == F.col("band") + 1, F.lead("score").over(up))
    j = s.withColumn("total", F.col("score") + F.coalesce(following, F.lit(0)))
    return j.where(F.col("total") >= h)


def low_complexity(reads: DataFrame, w: int = 64, t: float = 2.0) -> DataFrame:
    """Fixed windows in which triplets repeat: sum of c(c-1)/2 over the window's length minus 3 exceeds ``t``; then the union."""
    from .intervals import merge_intervals

    # A chunk holds 64 windows and the two letters behind them.
    many = chunks(reads, 3, 64 * w).select("rid", (F.col("_c").cast("long") * 64).alias("_c"), "_s")
    c = many.mapInArrow(repeated_triplets(w, t), f"rid {reads.schema['rid'].dataType.simpleString()}, win long")
    hit = c.select(F.lit("dust").alias("track"), "rid", (F.col("win") * w).alias("beg"), ((F.col("win") + 1) * w).alias("end_"))
    lens = reads.select("rid", F.length("seq").alias("_l"))
    return merge_intervals(hit.join(lens, "rid").withColumn("end_", F.least("end_", "_l")).drop("_l"))


def n50(contigs: DataFrame, fractions: tuple[int, ...] = (10, 50, 90), gsize: int | None = None) -> DataFrame:
    """For each percent: the length at which the longest contigs first hold that share of all bases, or of ``gsize``, and their number."""
    # Contigs are few; sums by length keep the single window to one row for each different length.
    by = contigs.groupBy("len").agg(F.count(F.lit(1)).alias("c"), F.sum("len").alias("b"))
    w = Window.orderBy(F.desc("len"))
    run = by.withColumn("cum", F.sum("b").over(w)).withColumn("cn", F.sum("c").over(w)).crossJoin(F.broadcast(contigs.agg((F.sum("len") if gsize is None else F.lit(gsize).cast("long")).alias("total"))))
    need = F.explode(F.array(*map(F.lit, fractions))).alias("pct")
    d = run.select("*", need).where(F.col("cum") * 100 >= F.col("total") * F.col("pct"))
    first = d.groupBy("pct").agg(F.max_by(F.struct("len", "cum", "b", "cn", "c", "total"), "len").alias("x")).select("pct", "x.*")
    before = F.col("cum") - F.col("b")
    count = F.col("cn") - F.col("c") + F.ceil((F.ceil(F.col("total") * F.col("pct") / 100) - before) / F.col("len"))
    return first.select("pct", F.col("len").alias("n_len"), count.alias("n_count"))
