"""All queries over the supplied tables, each with the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readweave.functions.columns import edge_divergence, flag_labels, reverse_complement
from readweave.operators import graph as G
from readweave.operators import intervals as I
from readweave.operators import overlaps as O
from readweave.operators import reads as R
from readweave.registry import Registry
from readweave.sources.fixtures import Fixtures, duck_views

REGISTRY = Registry()

#: Queries that read a derived table many times: it is computed once for them.
STORED = {"missed_adapters", "missed_adapters_repeats", "neighborhood_of_dead_ends", "strand_edges", "dedup_strand_edges", "strand_components", "overhang_errors", "drop_parallel_live", "stitch", "stitch_aggressive"}


def add(name: str, build: Callable[[Fixtures], DataFrame], ints: str, others: str, sql: str, views: str, recursive: bool = False) -> None:
    """Register a query; ``ints`` come out as longs on both sides. ``sql``: more WITH items and the final SELECT, after ``views``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = Fixtures(spark, sf_dir)
        return build(v.stored() if name in STORED else v).select(*(F.col(c).cast("long").alias(c) for c in ints.split()), *others.split())

    body, _, last = sql.rpartition(";;")
    columns = ", ".join([*(f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()), *others.split()])
    head = duck_views(*views.split())
    head = head.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else head
    REGISTRY.add(name, query, f"{head}{',' + body if body.strip() else ''}\nSELECT {columns} FROM ({last}) AS result_")


#: Union of intervals as SQL: islands of rows of {src} by {by}.
UNION = """ SELECT {by}, min(beg) AS beg, max(end_) AS end_ FROM (
 SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY beg, end_ ROWS UNBOUNDED PRECEDING) AS g FROM (
 SELECT *, CASE WHEN beg <= max(end_) OVER (PARTITION BY {by} ORDER BY beg, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 0 ELSE 1 END AS n FROM {src}))
 GROUP BY {by}, g"""


def union(src: str, by: str = "track, rid", gap: int = 0) -> str:
    return UNION.format(src=src, by=by, gap=gap)


ENDS = """ e AS (SELECT o.*, CASE WHEN a.tb < a.te THEN a.tb ELSE 0 END AS atb, CASE WHEN a.tb < a.te THEN a.te ELSE 0 END AS ate,
 CASE WHEN b.tb < b.te THEN CASE WHEN o.comp = 1 THEN o.blen - b.te ELSE b.tb END ELSE 0 END AS btb,
 CASE WHEN b.tb < b.te THEN CASE WHEN o.comp = 1 THEN o.blen - b.tb ELSE b.te END ELSE 0 END AS bte
 FROM {o} o LEFT JOIN {trim} a ON a.rid = o.aread LEFT JOIN {trim} b ON b.rid = o.bread)"""
OVL_ENDS = ENDS.format(o="ovl", trim="trim")
WHOLE = " w AS (SELECT rid, 0 AS tb, rlen AS te FROM lens)"
DOVE_ENDS = WHOLE + "," + ENDS.format(o="dove", trim="w")

SWEEP = """ r1 AS (SELECT *, sum(delta) OVER (PARTITION BY aread ORDER BY pos, delta, ovl_id ROWS UNBOUNDED PRECEDING) AS n FROM ev),
r2 AS (SELECT *, coalesce(last_value(CASE WHEN n > {hi} THEN 1 WHEN n < {lo} THEN 0 END IGNORE NULLS) OVER (PARTITION BY aread ORDER BY pos, delta, ovl_id ROWS UNBOUNDED PRECEDING), 0) AS s FROM r1{cov}),
r3 AS (SELECT *, coalesce(lag(s) OVER (PARTITION BY aread ORDER BY pos, delta, ovl_id), 0) AS p FROM r2),
r4 AS (SELECT *, lead(pos) OVER (PARTITION BY aread ORDER BY pos, delta, ovl_id) AS nx FROM r3 WHERE s <> p),
reg AS (SELECT aread AS rid, pos AS beg, nx AS end_ FROM r4 WHERE s = 1 AND nx IS NOT NULL)"""
EV = " ev AS (SELECT aread, ovl_id, abpos AS pos, 1 AS delta FROM {0} WHERE aread <> bread{1} UNION ALL SELECT aread, ovl_id, aepos - 1, -1 FROM {0} WHERE aread <> bread{1})"

READ_COV = f""" us AS (SELECT aread AS rid, abpos AS beg, aepos AS end_ FROM ovl WHERE aread <> bread), act AS ({union("us", "rid")}),
rc AS (SELECT b.rid AS aread, b.bases, a.active, b.bases // a.active AS cov FROM (SELECT rid, sum(end_ - beg) AS bases FROM us GROUP BY rid) b
 JOIN (SELECT rid, sum(end_ - beg) AS active FROM act GROUP BY rid) a ON a.rid = b.rid),
cv AS (SELECT cov FROM (SELECT cov, count(*) AS n FROM rc WHERE cov < 200 GROUP BY cov) ORDER BY n DESC, cov LIMIT 1)"""
REGIONS = READ_COV + "," + EV.format("ovl", "") + "," + SWEEP.format(hi="floor(cov * 2.0)", lo="floor(cov * 1.7)", cov=", cv")
# fmt: off
REPEATS = f""" m AS ({{union}}), sd AS (SELECT ovl_id, 'a' AS side, aread AS rid, abpos AS b, aepos AS e FROM ovl UNION ALL
 SELECT ovl_id, 'b', bread, CASE WHEN comp = 1 THEN blen - bepos ELSE bbpos END, CASE WHEN comp = 1 THEN blen - bbpos ELSE bepos END FROM ovl),
ins AS (SELECT ovl_id, sum(CASE WHEN side = 'a' THEN least(e, end_) - greatest(b, beg) END) AS xa, sum(CASE WHEN side = 'b' THEN least(e, end_) - greatest(b, beg) END) AS xb
 FROM sd JOIN m ON m.rid = sd.rid AND least(e, end_) > greatest(b, beg) GROUP BY ovl_id),
fr AS (SELECT o.*, CASE WHEN aepos - abpos - coalesce(xa, 0) < 500 OR bepos - bbpos - coalesce(xb, 0) < 500 THEN 10 ELSE 0 END AS flags FROM ovl o LEFT JOIN ins i ON i.ovl_id = o.ovl_id)"""
# fmt: on


def flagship_slice(v: Fixtures) -> DataFrame:
    """Overlaps by flag after those that don't keep 500 bases outside over-covered regions are marked."""
    regions = O.coverage_regions(v.ovl, O.coverage_estimate(v.ovl))
    return O.filter_repeat(v.ovl, regions, 500).groupBy("flags").agg(F.count(F.lit(1)).alias("n"))


add("minimum_slice", flagship_slice, "flags n", "", REGIONS + "," + REPEATS.replace("{union}", union("reg", "rid")) + ";; SELECT flags, count(*) AS n FROM fr GROUP BY flags", "ovl")
add("coverage_estimate", lambda v: O.coverage_estimate(v.ovl), "cov", "", READ_COV + ";; SELECT cov FROM cv", "ovl")
add("coverage_regions", lambda v: O.coverage_regions(v.ovl, O.coverage_estimate(v.ovl)), "rid beg end_", "", REGIONS + ";; SELECT * FROM reg", "ovl")
add("coverage_regions_merged", lambda v: O.coverage_regions(v.ovl, O.coverage_estimate(v.ovl), gap=500), "rid beg end_", "", REGIONS + ";;" + union("reg", "rid", 500), "ovl")
add("local_breaks", lambda v: O.local_breaks(v.ovl, v.trim), "rid beg end_", "", OVL_ENDS + ", ins_ AS (SELECT * FROM e WHERE ((abpos > atb AND bbpos > btb) OR (aepos < ate AND bepos < bte)) AND atb < ate AND btb < bte)," + EV.format("ins_", "") + "," + SWEEP.format(hi=5, lo=3, cov="") + ";; SELECT * FROM reg", "ovl trim")

# Intervals
add("merge_intervals", lambda v: I.merge_intervals(v.iv), "rid beg end_", "track", ";;" + union("iv"), "iv")
add("combine_tracks", lambda v: I.combine_tracks(v.iv, ["dust", "repeats"], "all"), "rid beg end_", "track", " c AS (SELECT 'all' AS track, rid, beg, end_ FROM iv);;" + union("c"), "iv")
add("merge_blocks", lambda v: I.merge_blocks(v.iv.where("rid % 2 = 0"), v.iv.where("rid % 2 = 1")), "rid beg end_", "track", ";; SELECT * FROM iv", "iv")
add("interval_gaps", lambda v: I.interval_gaps(I.merge_intervals(v.iv)), "rid beg end_ gap", "track", f" m AS ({union('iv')});; SELECT *, beg - lag(end_) OVER (PARTITION BY track, rid ORDER BY beg, end_) AS gap FROM m", "iv")
add("clip_intervals", lambda v: I.clip_intervals(v.iv, v.lens), "rid beg end_", "track", ";; SELECT track, rid, beg, end_ FROM (SELECT track, i.rid, greatest(beg, 1500) AS beg, least(end_, rlen - 1500) AS end_ FROM iv i JOIN lens l ON l.rid = i.rid) WHERE beg < end_", "iv")
add("interval_stats", lambda v: I.interval_stats(v.iv, v.lens), "bin n bases cum_n cum_bases pct", "track", " h AS (SELECT track, (end_ - beg) // 100 * 100 AS bin, count(*) AS n, sum(end_ - beg) AS bases FROM iv GROUP BY ALL), c AS (SELECT *, sum(n) OVER w AS cum_n, sum(bases) OVER w AS cum_bases FROM h WINDOW w AS (PARTITION BY track ORDER BY bin DESC));; SELECT *, 100 * cum_bases // (SELECT sum(rlen) FROM lens) AS pct FROM c", "iv")
add("interval_join", lambda v: I.interval_join(v.ovl.select("ovl_id", F.col("aread").alias("rid"), "abpos", "aepos"), I.merge_intervals(v.iv), "rid", ("abpos", "aepos"), ("beg", "end_")), "ovl_id rid beg end_ bp", "track", f" m AS ({union('iv')});; SELECT ovl_id, m.rid, track, beg, end_, least(aepos, end_) - greatest(abpos, beg) AS bp FROM ovl JOIN m ON m.rid = aread AND least(aepos, end_) > greatest(abpos, beg)", "ovl iv")
UNIQUE = f""" m AS ({union("iv", "rid")}), sp AS (SELECT l.rid, coalesce(tb, 0) AS tb, coalesce(te, 0) AS te FROM lens l LEFT JOIN {{0}} t ON t.rid = l.rid WHERE coalesce(tb, 0) < coalesce(te, 0)),
k AS (SELECT m.rid, greatest(beg, tb) AS beg, least(end_, te) AS end_ FROM m JOIN sp ON sp.rid = m.rid WHERE greatest(beg, tb) < least(end_, te) UNION ALL SELECT rid, te, te FROM sp),
u0 AS (SELECT k.rid, coalesce(lag(end_) OVER (PARTITION BY k.rid ORDER BY beg, end_), tb) AS ubeg, beg AS uend FROM k JOIN sp ON sp.rid = k.rid)"""
add("unique_intervals", lambda v: I.unique_intervals(v.iv, v.lens, v.trim), "rid beg end_", "", UNIQUE.format("trim") + ";; SELECT rid, ubeg AS beg, uend AS end_ FROM u0 WHERE uend - ubeg > 10", "iv trim")
add("unique_tip_trim", lambda v: I.unique_tip_trim(v.iv, v.lens), "rid tb te", "", WHOLE + "," + UNIQUE.format("w") + ";; SELECT rid, min(ubeg) AS tb, max(uend) AS te FROM u0 WHERE uend - ubeg > 499 GROUP BY rid", "iv")
add("spanning_reads", lambda v: I.spanning_reads(v.iv, v.trim), "rid beg end_", "track", ";; SELECT track, i.rid, beg, end_ FROM iv i JOIN trim t ON t.rid = i.rid WHERE beg - tb >= 300 AND te - end_ >= 300", "iv trim")
add("nested_round_trip", lambda v: I.to_long(I.to_nested(v.iv)), "rid beg end_", "track", ";; SELECT * FROM iv", "iv")
add("bed_rows", lambda v: I.bed_rows(I.merge_intervals(v.iv)), "rid", "track line", f" m AS ({union('iv')});; SELECT track, rid, 'read_' || rid || chr(9) || beg || chr(9) || end_ || chr(9) || track AS line FROM m", "iv")

# Overlap rules
FLAG = "CASE WHEN {0} THEN {1} ELSE 0 END"
RULES = f"""SELECT ovl_id, {FLAG.format('rl', 1026)} | {FLAG.format('ol', 514)} | {FLAG.format('lo', 18)} | {FLAG.format('df', 34)} AS flags FROM (SELECT ovl_id,
 ate - atb < 2500 OR bte - btb < 2500 AS rl, aepos - abpos < 800 OR bepos - bbpos < 800 AS ol,
 (abpos - atb > 500 AND bbpos - btb > 500) OR (ate - aepos > 500 AND bte - bepos > 500) AS lo, diffs / least(aepos - abpos, bepos - bbpos) > 0.08::DOUBLE AS df FROM e)"""
add("filter_overlaps", lambda v: O.filter_overlaps(v.ovl, v.trim), "ovl_id flags", "", OVL_ENDS + ";;" + RULES, "ovl trim")
add("with_ends", lambda v: O.with_ends(v.ovl, v.trim), "ovl_id atb ate btb bte", "", OVL_ENDS + ";; SELECT * FROM e", "ovl trim")
add("filter_repeat", lambda v: O.filter_repeat(v.ovl, v.iv, 500), "ovl_id flags", "", REPEATS.replace("{union}", union("iv", "rid")) + ";; SELECT * FROM fr", "ovl iv")
add("filter_trace", lambda v: O.filter_trace(v.ovl, v.trace.where("ovl_id % 50 <> 0 or seg > 0")), "ovl_id", "", ";; SELECT o.ovl_id FROM ovl o LEFT JOIN (SELECT ovl_id, sum(blen) AS s FROM trace WHERE ovl_id % 50 <> 0 OR seg > 0 GROUP BY ovl_id) t ON t.ovl_id = o.ovl_id WHERE bbpos + coalesce(s, 0) <> bepos", "ovl trace")
add("filter_segment_error", lambda v: O.filter_segment_error(v.ovl, v.trace, 60), "ovl_id flags", "", " l AS (SELECT ovl_id, max(seg) AS last FROM trace GROUP BY ovl_id), b AS (SELECT DISTINCT t.ovl_id FROM trace t JOIN l ON l.ovl_id = t.ovl_id WHERE seg < last AND 100 * diffs > 60 * blen);; SELECT o.ovl_id, CASE WHEN b.ovl_id IS NULL THEN 0 ELSE 34 END AS flags FROM ovl o LEFT JOIN b ON b.ovl_id = o.ovl_id", "ovl trace")
add("downsample", lambda v: O.downsample(v.ovl, v.lens, 40), "ovl_id aread bread", "", " m AS (SELECT count(*) * 40 // 100 AS m FROM lens);; SELECT ovl_id, aread, bread FROM ovl, m WHERE aread <= m AND bread <= m", "ovl")
add("remove_overlaps", lambda v: O.remove_overlaps(O.flagged(v.ovl), ["identity"]), "ovl_id flags", "", ";; SELECT ovl_id, CASE WHEN aread = bread THEN 2 ELSE 0 END AS flags FROM ovl", "ovl")
add("show_overlaps", lambda v: O.show_overlaps(v.ovl, 2500, 800, 95, [(1, 50), (90, 120)]), "ovl_id identity", "", ";; SELECT * FROM (SELECT *, 100 - 100 * diffs // (aepos - abpos) AS identity FROM ovl) WHERE alen >= 2500 AND blen >= 2500 AND aepos - abpos >= 800 AND identity >= 95 AND (aread BETWEEN 1 AND 50 OR aread BETWEEN 90 AND 120)", "ovl")
add("show_all_overlaps", lambda v: O.show_overlaps(v.ovl, 2500, 800, 95), "ovl_id identity", "", ";; SELECT * FROM (SELECT *, 100 - 100 * diffs // (aepos - abpos) AS identity FROM ovl) WHERE alen >= 2500 AND blen >= 2500 AND aepos - abpos >= 800 AND identity >= 95", "ovl")
add("flag_labels", lambda v: O.filter_overlaps(v.ovl, v.trim).select("ovl_id", flag_labels(F.col("flags")).alias("labels")), "ovl_id", "labels", OVL_ENDS + f", f AS ({RULES});; SELECT ovl_id, concat_ws(',', CASE WHEN flags & 2 > 0 THEN 'DISCARD' END, CASE WHEN flags & 16 > 0 THEN 'LOCAL' END, CASE WHEN flags & 32 > 0 THEN 'DIFF' END, CASE WHEN flags & 512 > 0 THEN 'OLEN' END, CASE WHEN flags & 1024 > 0 THEN 'RLEN' END) AS labels FROM f", "ovl trim")
BROKEN = "SELECT * EXCLUDE (aepos), CASE WHEN ovl_id % 97 = 0 THEN alen + 5 ELSE aepos END AS aepos FROM ovl"
add("check_overlaps", lambda v: O.check_overlaps(v.ovl.withColumn("aepos", F.expr("case when ovl_id % 97 = 0 then alen + 5 else aepos end"))), "ovl_id", "rule", f" b AS ({BROKEN}), d AS (SELECT *, coalesce(lag((comp, abpos, aepos, bbpos, bepos)) OVER (PARTITION BY aread, bread ORDER BY comp, abpos, aepos, bbpos, bepos, ovl_id) = (comp, abpos, aepos, bbpos, bepos), false) AS dup FROM b);; SELECT ovl_id, 'a_bounds' AS rule FROM d WHERE abpos < 0 OR aepos > alen UNION ALL SELECT ovl_id, 'b_bounds' FROM d WHERE bbpos < 0 OR bepos > blen UNION ALL SELECT ovl_id, 'empty' FROM d WHERE abpos >= aepos OR bbpos >= bepos UNION ALL SELECT ovl_id, 'duplicate' FROM d WHERE dup", "ovl")
add("extract_overlaps", lambda v: O.extract_overlaps(v.ovl, v.lens.where("rlen > 4000")), "ovl_id", "", ";; SELECT ovl_id FROM ovl WHERE aread IN (SELECT rid FROM lens WHERE rlen > 4000)", "ovl")
add("include_exclude", lambda v: O.include_exclude(v.ovl, v.lens.where("rlen > 4000"), v.lens.where("rid % 9 = 0")), "ovl_id flags", "", " i AS (SELECT rid FROM lens WHERE rlen > 4000);; SELECT ovl_id, CASE WHEN aread % 9 = 0 OR bread % 9 = 0 OR NOT (aread IN (SELECT rid FROM i) OR bread IN (SELECT rid FROM i)) THEN 2 ELSE 0 END AS flags FROM ovl", "ovl")
PAIRS = OVL_ENDS + f", f AS ({RULES}), p AS (SELECT DISTINCT least(aread, bread) AS r1, greatest(aread, bread) AS r2 FROM ovl o JOIN f ON f.ovl_id = o.ovl_id WHERE f.flags & 2 > 0)"
add("discarded_pairs", lambda v: O.discarded_pairs(O.filter_overlaps(v.ovl, v.trim)), "r1 r2", "", PAIRS + ";; SELECT * FROM p", "ovl trim")
add("sym_discard", lambda v: O.sym_discard(v.ovl, O.discarded_pairs(O.filter_overlaps(v.ovl, v.trim))), "ovl_id flags", "", PAIRS + ";; SELECT ovl_id, CASE WHEN r1 IS NULL THEN 0 ELSE 258 END AS flags FROM ovl LEFT JOIN p ON r1 = least(aread, bread) AND r2 = greatest(aread, bread)", "ovl trim")
add("contained_reads", lambda v: O.contained_reads(v.ovl, v.trim, 200), "rid", "", OVL_ENDS + ";; SELECT aread AS rid FROM e WHERE aread <> bread AND atb < ate AND abpos <= atb + 200 AND aepos >= ate - 200 UNION SELECT bread FROM e WHERE aread <> bread AND btb < bte AND bbpos <= btb + 200 AND bepos >= bte - 200", "ovl trim")
add("overlap_stats", lambda v: O.overlap_stats(v.ovl), "bin n n_comp n_identity bases cum_n cum_bases", "", " h AS (SELECT (aepos - abpos) // 500 * 500 AS bin, count(*) AS n, sum(comp) AS n_comp, count(*) FILTER (aread = bread) AS n_identity, sum(aepos - abpos) AS bases FROM ovl GROUP BY 1);; SELECT *, sum(n) OVER (ORDER BY bin DESC) AS cum_n, sum(bases) OVER (ORDER BY bin DESC) AS cum_bases FROM h", "ovl")
add("filter_summary", lambda v: O.filter_summary(O.filter_overlaps(v.ovl, v.trim)), "n", "reason", OVL_ENDS + f", f AS ({RULES});; SELECT reason, count(*) AS n FROM f, (VALUES ('DISCARD', 2), ('LOCAL', 16), ('DIFF', 32), ('OLEN', 512), ('RLEN', 1024)) AS b(reason, bit) WHERE flags & bit > 0 GROUP BY reason", "ovl trim")
add("tile_coverage", lambda v: O.tile_coverage(v.ovl), "aread tile cov", "", ";; SELECT aread, tile, count(*) AS cov FROM (SELECT aread, unnest(range(CAST(abpos // 100 AS BIGINT), CAST((aepos - 1) // 100 AS BIGINT) + 1)) AS tile FROM ovl) GROUP BY ALL", "ovl")
add("read_coverage", lambda v: O.read_coverage(v.ovl), "aread bases active cov", "", READ_COV + ";; SELECT * FROM rc", "ovl")
add("tandem_mask", lambda v: O.tandem_mask(v.ovl), "rid beg end_", "track", " t AS (SELECT 'tan' AS track, aread AS rid, bbpos AS beg, aepos AS end_ FROM ovl WHERE abpos - bepos <= 20 AND aepos - bbpos > 500);;" + union("t"), "ovl")
QUAL = """ fu AS (SELECT t.aread, tile, t.diffs, row_number() OVER (PARTITION BY t.aread, tile ORDER BY t.diffs, t.ovl_id) AS r FROM trace t JOIN ovl o ON o.ovl_id = t.ovl_id WHERE o.aread <> o.bread AND t.diffs < 100 AND t.blen = 100),
ag AS (SELECT aread, tile, count(*) AS n, sum(diffs) AS s FROM fu WHERE r <= 20 GROUP BY ALL),
tl AS (SELECT rid, unnest(range(0, CAST((rlen + 99) // 100 AS BIGINT))) AS tile FROM lens),
tq AS (SELECT tl.rid, tl.tile, coalesce(CASE WHEN n < 5 THEN 0 WHEN s = 0 THEN 1 ELSE (2 * s + n) // (2 * n) END, 0) AS q FROM tl LEFT JOIN ag ON ag.aread = tl.rid AND ag.tile = tl.tile)"""
add("segment_quality", lambda v: O.segment_quality(v.ovl, v.piles, v.lens), "rid tile q", "", QUAL + ";; SELECT * FROM tq", "ovl trace")
add("quality_trim", lambda v: O.quality_trim(O.segment_quality(v.ovl, v.piles, v.lens), v.lens, d=9), "rid tb te", "", QUAL + """, ru AS (SELECT rid, min(tile) AS a, max(tile) AS b FROM (SELECT *, tile - row_number() OVER (PARTITION BY rid ORDER BY tile) AS g FROM tq WHERE q > 0 AND q < 9) GROUP BY rid, g HAVING max(tile) - min(tile) + 1 >= 6),
en AS (SELECT rid, min(a) * 100 AS tb, (max(b) + 1) * 100 AS te FROM ru GROUP BY rid);; SELECT l.rid, CASE WHEN least(te, rlen) - tb >= 1000 THEN tb ELSE 0 END AS tb, CASE WHEN least(te, rlen) - tb >= 1000 THEN least(te, rlen) ELSE 0 END AS te FROM lens l LEFT JOIN en ON en.rid = l.rid""", "ovl trace")
add("update_trim", lambda v: O.update_trim(v.ovl, v.trim), "rid tb te", "", " c AS (SELECT aread, min(abpos) AS b, max(aepos) AS e FROM ovl WHERE aread <> bread GROUP BY aread), j AS (SELECT t.rid, b, greatest(tb, b) AS nb, least(te, e) AS ne FROM trim t LEFT JOIN c ON c.aread = t.rid);; SELECT rid, CASE WHEN b IS NOT NULL AND nb < ne THEN nb ELSE 0 END AS tb, CASE WHEN b IS NOT NULL AND nb < ne THEN ne ELSE 0 END AS te FROM j", "ovl trim")
TIP = f""" n AS (SELECT aread, count(*) FILTER (abpos <= atb) AS enter_, count(*) FILTER (aepos >= ate) AS leave_, min(atb) AS atb, min(ate) AS ate FROM e WHERE aread <> bread AND atb < ate GROUP BY aread),
cs AS (SELECT aread AS rid, greatest(abpos, atb) AS beg, least(aepos, ate) AS end_ FROM e WHERE aread <> bread AND atb < ate AND greatest(abpos, atb) < least(aepos, ate)), cm AS ({union("cs", "rid")}), ca AS (SELECT rid, sum(end_ - beg) AS active FROM cm GROUP BY rid)"""
add("tip_coverage", lambda v: O.tip_coverage(v.ovl, v.trim), "rid enter_ leave_ open_", "", OVL_ENDS + "," + TIP + ";; SELECT * FROM (SELECT aread AS rid, enter_, leave_, ate - atb - coalesce(active, 0) AS open_ FROM n LEFT JOIN ca ON ca.rid = n.aread) WHERE enter_ <= 2 OR leave_ <= 2 OR open_ > 500", "ovl trim")
PAIR = " x AS (SELECT * FROM ovl), y AS (SELECT * FROM ovl)"
add("drop_contained", lambda v: O.drop_contained(v.ovl), "ovl_id flags", "", PAIR + ", g AS (SELECT DISTINCT y.ovl_id FROM x JOIN y ON x.aread = y.aread AND x.bread = y.bread AND x.comp = y.comp AND x.abpos <= y.abpos AND x.aepos >= y.aepos AND x.bbpos <= y.bbpos AND x.bepos >= y.bepos AND (x.abpos, x.aepos, x.bbpos, x.bepos, x.ovl_id) < (y.abpos, y.aepos, y.bbpos, y.bepos, y.ovl_id) AND (x.aread <> x.bread OR (x.abpos = y.abpos AND x.aepos = y.aepos AND x.bbpos = y.bbpos AND x.bepos = y.bepos)));; SELECT o.ovl_id, CASE WHEN g.ovl_id IS NULL THEN 0 ELSE 32770 END AS flags FROM ovl o LEFT JOIN g ON g.ovl_id = o.ovl_id", "ovl")
add("drop_multimappers", lambda v: O.drop_multimappers(v.ovl), "ovl_id flags", "", PAIR + ", g AS (SELECT DISTINCT x.aread, x.bread FROM x JOIN y ON x.aread = y.aread AND x.bread = y.bread AND x.ovl_id <> y.ovl_id AND ((x.abpos <= y.abpos AND x.aepos >= y.aepos) OR (x.bbpos <= y.bbpos AND x.bepos >= y.bepos)));; SELECT o.ovl_id, CASE WHEN g.aread IS NULL THEN 0 ELSE 2 END AS flags FROM ovl o LEFT JOIN g ON g.aread = o.aread AND g.bread = o.bread", "ovl")
add("prefer_proper", lambda v: O.prefer_proper(v.ovl, v.trim, 100), "ovl_id flags", "", OVL_ENDS + ", p AS (SELECT *, CASE WHEN (abpos <= atb + 100 OR bbpos <= btb + 100) AND (aepos >= ate - 100 OR bepos >= bte - 100) THEN 1 ELSE 0 END AS pr FROM e);; SELECT ovl_id, CASE WHEN sum(pr) OVER w = 1 AND count(*) OVER w > 1 AND pr = 0 THEN 2 ELSE 0 END AS flags FROM p WINDOW w AS (PARTITION BY aread, bread)", "ovl trim")
add("fully_discarded", lambda v: O.fully_discarded(O.filter_overlaps(v.ovl, v.trim), v.trim, 1000), "rid", "", OVL_ENDS + f", f AS ({RULES}), d AS (SELECT aread FROM ovl o JOIN f ON f.ovl_id = o.ovl_id GROUP BY aread HAVING bool_and(f.flags & 2 > 0));; SELECT aread AS rid FROM d JOIN trim ON rid = aread WHERE te - tb > 1000", "ovl trim")
add("chain_flags", lambda v: O.chain_flags(O.filter_overlaps(v.ovl, v.trim)), "ovl_id", "role", OVL_ENDS + f", f AS ({RULES});; SELECT o.ovl_id, CASE WHEN f.flags & 2 > 0 THEN 'gone' WHEN row_number() OVER (PARTITION BY aread, bread ORDER BY f.flags & 2 > 0, comp, abpos, aepos, bbpos, bepos, o.ovl_id) = 1 THEN 'start' ELSE 'next' END AS role FROM ovl o JOIN f ON f.ovl_id = o.ovl_id", "ovl trim")
add("find_gaps", lambda v: O.find_gaps(v.ovl, v.trim), "aread gaps first_gap", "", " x AS (SELECT aread, bread, min(abpos) AS b, max(aepos) AS e FROM ovl WHERE aread <> bread GROUP BY ALL), s AS (SELECT rid AS aread, unnest(range(CAST(tb + 1000 AS BIGINT), CAST(te - 999 AS BIGINT), 1000)) AS pos FROM trim WHERE te - tb > 2000), n AS (SELECT s.aread, pos, count(*) FILTER (b <= pos - 250 AND e >= pos + 250) AS n FROM s LEFT JOIN x ON x.aread = s.aread GROUP BY ALL);; SELECT aread, count(*) AS gaps, min(pos) AS first_gap FROM n WHERE n < 2 GROUP BY aread", "ovl trim")
add("drop_chimeras", lambda v: O.drop_chimeras(v.ovl, v.trim), "aread weakest", "", " c AS (SELECT o.aread, abpos, aepos, min(abpos) OVER w AS l, max(aepos) OVER w AS r FROM ovl o JOIN trim t ON t.rid = o.aread WHERE aread <> bread AND tb < te WINDOW w AS (PARTITION BY aread)), p AS (SELECT aread, abpos AS pos FROM c WHERE abpos > l + 200 AND abpos < r - 200 UNION SELECT aread, aepos FROM c WHERE aepos > l + 200 AND aepos < r - 200), n AS (SELECT p.aread, pos, count(*) FILTER (abpos <= pos - 200 AND aepos >= pos + 200) AS n FROM p JOIN c ON c.aread = p.aread GROUP BY ALL);; SELECT aread, min(n) AS weakest FROM n GROUP BY aread HAVING min(n) < 2", "ovl trim")
add("split_overlaps", lambda v: O.split_overlaps(v.ovl, 4), "ovl_id part", "", " c AS (SELECT aread, count(*) AS c FROM ovl GROUP BY aread), p AS (SELECT aread, (sum(c) OVER (ORDER BY aread) - c) * 4 // (SELECT count(*) FROM ovl) AS part FROM c);; SELECT ovl_id, part FROM ovl o JOIN p ON p.aread = o.aread", "ovl")
add("union_overlaps", lambda v: O.union_overlaps(v.ovl.where("aread % 3 = 0"), v.ovl.where("aread % 3 <> 0")), "ovl_id aread bread", "", ";; SELECT * FROM ovl", "ovl")
add("edge_divergence", lambda v: v.ovl.select("ovl_id", edge_divergence(F.col("diffs"), F.col("aepos") - F.col("abpos"), F.col("bepos") - F.col("bbpos")).alias("div")), "ovl_id div", "", ";; SELECT ovl_id, 200 * diffs // (aepos - abpos + bepos - bbpos) AS div FROM ovl", "ovl")

# Reads and k-mers
add("filter_reads", lambda v: R.filter_reads(v.reads), "rid", "source", ";; SELECT * FROM reads WHERE length(seq) >= 1000", "reads")
add("reverse_complement", lambda v: v.reads.select("rid", F.md5(reverse_complement(F.col("seq"))).alias("digest")), "rid", "digest", ";; SELECT rid, md5(reverse(translate(seq, 'ACGTacgt', 'TGCAtgca'))) AS digest FROM reads", "reads")
add("read_stats", lambda v: R.read_stats(v.reads), "bin n bases cum_n cum_bases", "", " h AS (SELECT length(seq) // 1000 * 1000 AS bin, count(*) AS n, sum(length(seq)) AS bases FROM reads GROUP BY 1);; SELECT *, sum(n) OVER (ORDER BY bin DESC) AS cum_n, sum(bases) OVER (ORDER BY bin DESC) AS cum_bases FROM h", "reads")
add("base_counts", lambda v: R.base_counts(v.reads), "n bases n_a n_c n_g n_t", "", ";; SELECT count(*) AS n, sum(length(seq)) AS bases, " + ", ".join(f"sum(length(seq) - length(replace(seq, '{b}', ''))) AS n_{b}" for b in "acgt") + " FROM reads", "reads")
add("split_reads", lambda v: R.split_reads(v.reads), "rid win beg end_", "", """ b AS (SELECT rid, length(seq) AS l, CASE WHEN length(seq) <= 5000 THEN 1 ELSE (length(seq) - 1000 + 3999) // 4000 END AS n FROM reads), w AS (SELECT *, unnest(range(0, CAST(n AS BIGINT))) AS win FROM b),
h AS (SELECT *, n > 1 AND l - (n - 1) * 4000 < 2500 AS sh, (l - (n - 2) * 4000 + 1000) // 2 AS half FROM w);; SELECT rid, win, CASE WHEN sh AND win = n - 1 THEN l - half ELSE win * 4000 END AS beg, CASE WHEN win = n - 1 THEN l WHEN sh AND win = n - 2 THEN win * 4000 + half ELSE win * 4000 + 5000 END AS end_ FROM h""", "reads")
add("trim_lower_tips", lambda v: R.trim_lower_tips(v.table("documents").select(F.col("doc_id").alias("rid"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"))).select("rid", F.length("trimmed").alias("n"), F.col("garbage").cast("int").alias("garbage")), "rid n garbage", "", " t AS (SELECT doc_id AS rid, regexp_replace(regexp_replace(regexp_replace(text, '[^A-Za-z]', '', 'g'), '^[a-z]+', ''), '[a-z]+$', '') AS s FROM documents);; SELECT rid, length(s) AS n, CASE WHEN s = '' THEN 1 ELSE 0 END AS garbage FROM t", "lens")
add("motif_positions", lambda v: R.motif_positions(v.reads, "DpnII"), "rid pos", "", ";; SELECT rid, pos FROM (SELECT rid, seq, unnest(range(1, length(seq) - 2)) AS pos FROM reads) WHERE substr(seq, pos, 4) = 'gatc'", "reads")
SCAF = "translate(regexp_replace(text, '[^A-Za-z]', 'N'{g}), 'BDEFHIJKLMOPQRSUVWXYZbdefhijklmnopqrsuvwxyz', 'NNNNNNNNNNNNNNNNNNNNNacgtacgtacgtacgtacgtac')"
add("split_scaffolds", lambda v: R.split_scaffolds(v.table("documents").select(F.col("doc_id").alias("rid"), F.expr(SCAF.format(g="")).alias("seq"))).select("rid", "ix", "off", F.length("seq").alias("n")), "rid ix off n", "", f" s AS (SELECT doc_id AS rid, {SCAF.format(g=', ' + chr(39) + 'g' + chr(39))} AS seq FROM documents), p AS (SELECT rid, unnest(regexp_extract_all(seq, '([ACGTacgt]+|[^ACGTacgt]+)')) AS x, generate_subscripts(regexp_extract_all(seq, '([ACGTacgt]+|[^ACGTacgt]+)'), 1) AS k FROM s), o AS (SELECT *, sum(length(x)) OVER (PARTITION BY rid ORDER BY k) - length(x) AS off FROM p);; SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY k) - 1 AS ix, off, length(x) AS n FROM o WHERE regexp_matches(x, '^[ACGTacgt]')", "lens")
add("scaffold_round_trip", lambda v: R.join_scaffolds(R.split_scaffolds(v.table("documents").select(F.col("doc_id").alias("rid"), F.expr(SCAF.format(g="")).alias("seq")))).select("rid", F.md5("seq").alias("digest")), "rid", "digest", f" s AS (SELECT doc_id AS rid, {SCAF.format(g=', ' + chr(39) + 'g' + chr(39))} AS seq FROM documents);; SELECT rid, md5(regexp_replace(seq, '[^ACGTacgt]+$', '')) AS digest FROM s WHERE regexp_matches(seq, '[ACGTacgt]')", "lens")
add("parse_headers", lambda v: R.parse_headers(v.lens.select(F.format_string("read/%d/0_%d trim=%d,%d source=%d", "rid", "rlen", F.col("rid") % 100, F.col("rlen") - 50, F.col("rid") % 7).alias("header")), ["trim"]), "pos", "header name value", " h AS (SELECT 'read/' || rid || '/0_' || rlen || ' trim=' || rid % 100 || ',' || (rlen - 50) || ' source=' || rid % 7 AS header, rid % 100 AS a, rlen - 50 AS b FROM lens);; SELECT header, 'trim' AS name, 0 AS pos, CAST(a AS VARCHAR) AS value FROM h UNION ALL SELECT header, 'trim', 1, CAST(b AS VARCHAR) FROM h", "lens")
add("best_per_well", lambda v: R.best_per_well(v.reads.select(F.col("source").alias("file"), F.col("rid").alias("seq_id"), F.floor(F.col("rid") / 60).alias("well"), F.length("seq").alias("rlen"))), "seq_id well rlen", "file", " r AS (SELECT source AS file, rid AS seq_id, rid // 60 AS well, length(seq) AS rlen FROM reads);; SELECT file, seq_id, well, rlen FROM r QUALIFY row_number() OVER (PARTITION BY file, well ORDER BY rlen DESC, seq_id) = 1", "reads")
KM = " km AS (SELECT rid, pos, substr(seq, pos, 14) AS kmer FROM (SELECT rid, seq, unnest(range(1, length(seq) - 12)) AS pos FROM reads WHERE length(seq) >= 14))"
add("kmer_counts", lambda v: R.kmer_counts(v.reads, 14), "n", "kmer", KM + ";; SELECT kmer, least(count(*), 255) AS n FROM km GROUP BY kmer", "reads")
add("kmer_histogram", lambda v: R.kmer_histogram(v.reads, 14), "n kmers", "", KM + ";; SELECT n, count(*) AS kmers FROM (SELECT kmer, least(count(*), 255) AS n FROM km GROUP BY kmer) GROUP BY n", "reads")
add("cap_kmers", lambda v: R.cap_kmers(v.reads, 14, 4).groupBy("rid").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("s")), "rid n s", "", KM + ";; SELECT rid, count(*) AS n, sum(pos) AS s FROM km WHERE kmer IN (SELECT kmer FROM km GROUP BY kmer HAVING count(*) < 4) GROUP BY rid", "reads")
add("choose_cap", lambda v: R.choose_cap(v.reads, 14, 2_000_000), "cap", "", KM + ", h AS (SELECT c, count(*) * c * c AS pairs FROM (SELECT count(*) AS c FROM km GROUP BY kmer) GROUP BY c);; SELECT max(c) + 1 AS cap FROM (SELECT c, sum(pairs) OVER (ORDER BY c) AS r FROM h) WHERE r <= 2000000", "reads")
add("mask_kmers", lambda v: R.mask_kmers(v.reads, v.iv, 14).groupBy("rid").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("s")), "rid n s", "", KM + ";; SELECT rid, count(*) AS n, sum(pos) AS s FROM km WHERE NOT EXISTS (SELECT 1 FROM iv WHERE iv.rid = km.rid AND beg < pos - 1 + 14 AND end_ > pos - 1) GROUP BY rid", "reads iv")
SEEDS = KM + ", fk AS (SELECT * FROM km WHERE kmer IN (SELECT kmer FROM km GROUP BY kmer HAVING count(*) < 5)), sd AS (SELECT a.rid AS aread, b.rid AS bread, a.pos AS apos, b.pos AS bpos FROM fk a JOIN fk b ON a.kmer = b.kmer AND a.rid < b.rid)"
add("seed_pairs", lambda v: R.seed_pairs(v.reads, 14, 5).groupBy("aread", "bread").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("apos") - F.col("bpos")).alias("s")), "aread bread n s", "", SEEDS + ";; SELECT aread, bread, count(*) AS n, sum(apos - bpos) AS s FROM sd GROUP BY ALL", "reads")
add("band_scores", lambda v: R.band_scores(R.seed_pairs(v.reads, 14, 5), 14), "aread bread comp band score total amin amax", "", SEEDS + """, bd AS (SELECT *, 0 AS comp, CAST(floor((apos - bpos) / 64) AS BIGINT) AS band FROM sd),
sc AS (SELECT aread, bread, comp, band, sum(c) AS score, min(apos) AS amin, max(apos) AS amax FROM (SELECT *, least(14, coalesce(apos - lag(apos) OVER (PARTITION BY aread, bread, band ORDER BY apos, bpos), 14)) AS c FROM bd) GROUP BY ALL);;
SELECT * FROM (SELECT a.*, a.score + coalesce(b.score, 0) AS total FROM sc a LEFT JOIN sc b ON b.aread = a.aread AND b.bread = a.bread AND b.band = a.band + 1) WHERE total >= 35""", "reads")
SEEDS2 = KM + """, tk AS (SELECT rid, pos, substr(seq, pos, 14) AS kmer FROM (SELECT rid, seq, unnest(range(1, length(seq) - 12)) AS pos FROM (SELECT rid, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) AS seq FROM reads WHERE length(seq) >= 14))),
hc AS (SELECT c, count(*) AS n FROM (SELECT count(*) AS c FROM km GROUP BY kmer) GROUP BY c), cp AS (SELECT max(c) + 1 AS cap FROM (SELECT c, sum(n * c * c) OVER (ORDER BY c) AS r, sum(n * c) OVER () AS t FROM hc) WHERE r <= 8 * t),
fk AS (SELECT * FROM km WHERE kmer IN (SELECT kmer FROM km GROUP BY kmer HAVING count(*) < (SELECT cap FROM cp))), ft AS (SELECT * FROM tk WHERE kmer IN (SELECT kmer FROM tk GROUP BY kmer HAVING count(*) < (SELECT cap FROM cp))),
sd AS (SELECT a.rid AS aread, b.rid AS bread, b.comp, a.pos AS apos, b.pos AS bpos FROM fk a JOIN (SELECT *, 0 AS comp FROM fk UNION ALL SELECT *, 1 FROM ft) b ON a.kmer = b.kmer AND a.rid < b.rid)"""
stranded = lambda v: R.seed_pairs(v.reads, 14, R.scaled_cap(v.reads, 14, 8), both_strands=True)
add("seed_pairs_stranded", lambda v: stranded(v).groupBy("aread", "bread", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("apos") - F.col("bpos")).alias("s")), "aread bread comp n s", "", SEEDS2 + ";; SELECT aread, bread, comp, count(*) AS n, sum(apos - bpos) AS s FROM sd GROUP BY ALL", "reads")
add("band_scores_stranded", lambda v: R.band_scores(stranded(v), 14), "aread bread comp band score total amin amax", "", SEEDS2 + """, bd AS (SELECT *, CAST(floor((apos - bpos) / 64) AS BIGINT) AS band FROM sd),
sc AS (SELECT aread, bread, comp, band, sum(c) AS score, min(apos) AS amin, max(apos) AS amax FROM (SELECT *, least(14, coalesce(apos - lag(apos) OVER (PARTITION BY aread, bread, comp, band ORDER BY apos, bpos), 14)) AS c FROM bd) GROUP BY ALL);;
SELECT * FROM (SELECT a.*, a.score + coalesce(b.score, 0) AS total FROM sc a LEFT JOIN sc b ON b.aread = a.aread AND b.bread = a.bread AND b.comp = a.comp AND b.band = a.band + 1) WHERE total >= 35""", "reads")
add("low_complexity", lambda v: R.low_complexity(v.reads, t=0.6), "rid beg end_", "track", f""" k3 AS (SELECT rid, pos, substr(seq, pos, 3) AS kmer FROM (SELECT rid, seq, unnest(range(1, length(seq) - 1)) AS pos FROM reads WHERE length(seq) >= 3)),
lw AS (SELECT rid, (pos - 1) // 64 AS win, kmer, count(*) AS c FROM k3 WHERE (pos - 1) % 64 <= 61 GROUP BY ALL), lh AS (SELECT 'dust' AS track, w.rid, win * 64 AS beg, least((win + 1) * 64, length(seq)) AS end_ FROM (SELECT rid, win, sum(c * (c - 1) / 2) AS s FROM lw GROUP BY ALL) w JOIN reads r ON r.rid = w.rid WHERE s > 0.6 * 61);;{union("lh")}""", "reads")
add("n50", lambda v: R.n50(v.contigs), "pct n_len n_count", "", " r AS (SELECT len, sum(len) OVER (ORDER BY len DESC, cid ROWS UNBOUNDED PRECEDING) AS cum, row_number() OVER (ORDER BY len DESC, cid) AS k, sum(len) OVER () AS total FROM contigs);; SELECT pct, arg_min(len, k) AS n_len, min(k) AS n_count FROM r, (VALUES (10), (50), (90)) AS p(pct) WHERE cum * 100 >= total * pct GROUP BY pct", "contigs")

# Graph, contigs, short reads
whole = lambda v: v.lens.select("rid", F.lit(0).alias("tb"), F.col("rlen").alias("te"))
INSIDE = " cn AS (SELECT aread AS rid FROM e WHERE abpos <= atb AND aepos >= ate UNION SELECT bread FROM e WHERE bbpos <= btb AND bepos >= bte)"
EDGES = DOVE_ENDS + "," + INSIDE + """, ed AS (SELECT * FROM (SELECT aread AS src, bread AS dst, 'l' AS side, bbpos - btb AS ovh, 200 * diffs // (aepos - abpos + bepos - bbpos) AS div FROM e WHERE abpos <= atb AND bbpos > btb AND aepos < ate
 UNION ALL SELECT aread, bread, 'r', bte - bepos, 200 * diffs // (aepos - abpos + bepos - bbpos) FROM e WHERE aepos >= ate AND bepos < bte AND abpos > atb) WHERE src NOT IN (SELECT rid FROM cn) AND dst NOT IN (SELECT rid FROM cn))"""
edges = lambda v: G.build_edges(v.dove, whole(v))
add("drop_parallel_overlaps", lambda v: G.drop_parallel_overlaps(v.ovl), "ovl_id", "", ";; SELECT ovl_id FROM ovl QUALIFY count(*) OVER (PARTITION BY aread, bread) = 1", "ovl")
add("contained_nodes", lambda v: G.contained_nodes(v.dove, whole(v)), "rid", "", DOVE_ENDS + "," + INSIDE + ";; SELECT * FROM cn", "dove")
add("build_edges", edges, "src dst ovh div", "side", EDGES + ";; SELECT * FROM ed", "dove")
add("dedup_edges", lambda v: G.dedup_edges(edges(v)), "src dst ovh div", "side", EDGES + ";; SELECT * FROM ed QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY side, ovh, div) = 1", "dove")
add("node_degree", lambda v: G.node_degree(edges(v)), "src n_left n_right", "", EDGES + ";; SELECT src, count(*) FILTER (side = 'l') AS n_left, count(*) FILTER (side = 'r') AS n_right FROM ed GROUP BY src", "dove")
add("dead_ends", lambda v: G.dead_ends(edges(v)), "src", "", EDGES + ";; SELECT src FROM ed GROUP BY src HAVING count(DISTINCT side) = 1", "dove")
add("vertex_quality", lambda v: G.vertex_quality(edges(v)), "src", "quality", EDGES + ";; SELECT src, round(1.0::DOUBLE / least(greatest(count(*) FILTER (side = 'l'), 1), 10) + 1.0::DOUBLE / least(greatest(count(*) FILTER (side = 'r'), 1), 10) + avg(div) / 1000, 6) AS quality FROM ed GROUP BY src", "dove")
add("drop_inversions", lambda v: G.drop_inversions(edges(v)), "src dst ovh div", "side", EDGES + ";; SELECT * FROM ed WHERE (src, dst) NOT IN (SELECT (src, dst) FROM ed GROUP BY src, dst HAVING count(DISTINCT side) > 1)", "dove")
add("rescue_dead_ends", lambda v: G.rescue_dead_ends(v.dove, edges(v), whole(v)), "src dst span", "side", EDGES + """, rs AS (SELECT aread AS src, bread AS dst, 'l' AS side, aepos - abpos AS span FROM e WHERE abpos <= atb AND bbpos > btb UNION ALL SELECT aread, bread, 'r', aepos - abpos FROM e WHERE aepos >= ate AND bepos < bte);;
SELECT * FROM rs WHERE src NOT IN (SELECT rid FROM cn) AND dst IN (SELECT rid FROM cn) AND NOT EXISTS (SELECT 1 FROM ed WHERE ed.src = rs.src AND ed.side = rs.side) QUALIFY row_number() OVER (PARTITION BY src, side ORDER BY span DESC, dst) = 1""", "dove")
add("graph_rows", lambda v: G.graph_rows(edges(v)), "", "line", EDGES + ";; SELECT src || ' ' || dst || ' ' || side || ' ' || ovh || ' ' || div AS line FROM ed", "dove")
add("neighborhood", lambda v: G.neighborhood(edges(v), v.lens.where("rid = 30"), 3), "rid dist", "", EDGES + ", s1 AS (SELECT DISTINCT dst AS rid FROM ed WHERE src = 30), s2 AS (SELECT DISTINCT dst AS rid FROM ed JOIN s1 ON s1.rid = src), s3 AS (SELECT DISTINCT dst AS rid FROM ed JOIN s2 ON s2.rid = src);; SELECT rid, min(d) AS dist FROM (SELECT rid, 0 AS d FROM lens WHERE rid = 30 UNION ALL SELECT rid, 1 FROM s1 UNION ALL SELECT rid, 2 FROM s2 UNION ALL SELECT rid, 3 FROM s3) GROUP BY rid", "dove")
add("split_diploid", lambda v: G.split_diploid(v.contigs, 5000), "cid len", "kind", ";; SELECT cid, len, CASE WHEN (end1 = end2 AND end1 <> -1) OR ((end1 <> -1 OR end2 <> -1) AND len < 5000) THEN 'alternative' ELSE 'primary' END AS kind FROM contigs", "contigs")
REL = " rl AS (SELECT *, CASE WHEN end1 = -1 AND end2 = -1 THEN 'unique' WHEN end1 = end2 THEN 'bubble' WHEN end1 = -1 OR end2 = -1 THEN 'spur' ELSE 'bridge' END AS relation FROM contigs)"
add("tour_relations", lambda v: G.tour_relations(v.contigs), "cid", "relation", REL + ";; SELECT * FROM rl", "contigs")
add("classify_contigs", lambda v: G.classify_contigs(v.contigs).withColumnRenamed("class", "kind"), "cid", "kind reason", REL + ";; SELECT cid, CASE WHEN len < 1000 THEN 'DISCARD' WHEN relation IN ('bubble', 'spur') THEN 'ALT' ELSE 'PRIM' END AS kind, CASE WHEN len < 1000 THEN 'LEN' ELSE '' END AS reason FROM rl", "contigs")
add("five_prime_filter", lambda v: G.five_prime_filter(v.sam), "ord flag", "qname", """ k AS (SELECT *, flag & 4 = 0 AND regexp_matches(cigar, CASE WHEN flag & 16 > 0 THEN 'M$' ELSE '^[0-9]+M' END) AS five FROM sam), g AS (SELECT qname, count(*) AS n, count(*) FILTER (five) AS n5, arg_min(flag, ord) AS f1, min(ord) AS o1, arg_min(flag, ord) FILTER (five) AS f5, min(ord) FILTER (five) AS o5 FROM k GROUP BY qname);;
SELECT qname, CASE WHEN n <= 2 AND n5 = 1 THEN o5 ELSE o1 END AS ord, CASE WHEN n <= 2 AND n5 = 1 THEN f5 ELSE f1 | 4 END AS flag FROM g""", "sam")
MATES = " mt AS (SELECT a.qname, 65 + CASE WHEN a.flag & 16 > 0 THEN 16 ELSE 0 END + CASE WHEN b.flag & 16 > 0 THEN 32 ELSE 0 END AS flag1, 129 + CASE WHEN b.flag & 16 > 0 THEN 16 ELSE 0 END + CASE WHEN a.flag & 16 > 0 THEN 32 ELSE 0 END AS flag2, a.rname AS rname1, b.rname AS rname2, a.pos AS pos1, b.pos AS pos2, CASE WHEN a.rname = b.rname THEN b.pos - a.pos ELSE 0 END AS tlen FROM sam a JOIN sam b ON a.qname = b.qname AND a.ord = 1 AND b.ord = 2 WHERE a.flag & 4 = 0 AND b.flag & 4 = 0 AND a.mapq >= 10 AND b.mapq >= 10)"
mates = lambda v: G.combine_mates(v.sam.where("ord = 1"), v.sam.where("ord = 2"))
add("combine_mates", mates, "flag1 flag2 rname1 rname2 pos1 pos2 tlen", "qname", MATES + ";; SELECT * FROM mt", "sam")
add("hic_stats", lambda v: G.hic_stats(mates(v)), "all_pairs intra intra_1kb intra_10kb intra_15kb intra_20kb inter", "", MATES + ";; SELECT count(*) AS all_pairs, count(*) FILTER (rname1 = rname2) AS intra, " + ", ".join(f"count(*) FILTER (rname1 = rname2 AND abs(tlen) >= {k}000) AS intra_{k}kb" for k in (1, 10, 15, 20)) + ", count(*) FILTER (rname1 <> rname2) AS inter FROM mt", "sam")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY.queries["minimum_slice"](spark, sf_dir)


REGISTRY.add("components", lambda spark, sf_dir: G.components(edges(Fixtures(spark, sf_dir))))
