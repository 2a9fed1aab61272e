"""Queries over ids, summaries, edges with strands, stitches, trims and turned reads, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.operators import graph as G
from readweave.operators import intervals as I
from readweave.operators import numbering as N
from readweave.operators import overlaps as O
from readweave.operators import reads as R
from readweave.operators import stitching as S
from readweave.operators import summaries as U
from readweave.sources.fixtures import Fixtures

from .catalog import DOVE_ENDS, EDGES, INSIDE, OVL_ENDS, QUAL, RULES, add, edges, union, whole

# Ids and reads
numbered = lambda v: v.reads.select(F.col("source").alias("file"), F.col("rid").alias("seq_id"), F.length("seq").alias("rlen"))
NUMBERED = " nr AS (SELECT source AS file, rid AS seq_id, length(seq) AS rlen FROM reads)"
BEFORE = "(ORDER BY file, seq_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
add(
    "assign_rids", lambda v: N.assign_rids(numbered(v)), "rid boff seq_id rlen", "file",
    NUMBERED + f";; SELECT *, coalesce(count(*) OVER {BEFORE}, 0) AS rid, coalesce(sum(rlen) OVER {BEFORE}, 0) AS boff FROM nr", "reads",
)
add("id_totals", lambda v: N.id_totals(numbered(v)), "n_reads bases longest", "", NUMBERED + ";; SELECT count(*) AS n_reads, sum(rlen) AS bases, max(rlen) AS longest FROM nr", "reads")
HEADED = "concat('m/', rid, CASE rid % 5 WHEN 0 THEN '' WHEN 1 THEN ' readType=1' WHEN 2 THEN ' readType=2' WHEN 3 THEN ' readType=3' ELSE ' readType=1,2' END)"
add(
    "full_hq_reads", lambda v: R.filter_reads(v.reads.withColumn("header", F.expr(HEADED)), full_hq=True), "rid", "source",
    ";; SELECT rid, source FROM reads WHERE length(seq) >= 1000 AND rid % 5 IN (1, 2)", "reads",
)
add(
    "track_values", lambda v: I.track_values(v.iv, "dust", v.lens).select("rid", F.size("spans").alias("n"), F.concat_ws(",", F.transform("spans", lambda x: F.concat(x["beg"], F.lit("-"), x["end_"]))).alias("spans")), "rid n", "spans",
    ";; SELECT l.rid, count(i.rid) AS n, coalesce(string_agg(beg || '-' || end_, ',' ORDER BY beg, end_), '') AS spans FROM lens l LEFT JOIN iv i ON i.rid = l.rid AND track = 'dust' GROUP BY l.rid", "iv",
)
add("has_track", lambda v: I.has_track(v.iv, "dust", v.lens), "rid", "", ";; SELECT rid FROM lens WHERE rid IN (SELECT rid FROM iv WHERE track = 'dust')", "iv")

# Summaries
LEN = " ln AS (SELECT length(seq) AS rlen FROM reads)"
read_lens = lambda v: v.reads.select(F.length("seq").alias("rlen"))
add(
    "read_summary", lambda v: U.read_summary(read_lens(v)), "n bases mean deviation", "",
    LEN + ", s AS (SELECT count(*) AS n, sum(rlen) AS bases, sum(rlen) // count(*) AS mean FROM ln);; "
    "SELECT n, bases, mean, floor(sqrt((SELECT sum((rlen - mean) * (rlen - mean)) FROM ln)::DOUBLE / n)) AS deviation FROM s", "reads",
)
add(
    "length_table", lambda v: U.length_table(read_lens(v), 1000, 1_000_000), "bin n average", "pct_reads pct_bases coverage",
    LEN + """, h AS (SELECT rlen // 1000 * 1000 AS bin, count(*) AS n, sum(rlen) AS bases FROM ln GROUP BY 1), c AS (SELECT *, sum(n) OVER w AS cn, sum(bases) OVER w AS cb FROM h WINDOW w AS (ORDER BY bin DESC));;
 SELECT bin, n, cb // cn AS average, 100::DOUBLE * cn / (SELECT sum(n) FROM h) AS pct_reads, 100::DOUBLE * cb / (SELECT sum(bases) FROM h) AS pct_bases, cb / 1000000::DOUBLE AS coverage FROM c""", "reads",
)
add(
    "overlap_summary", lambda v: U.overlap_summary(O.filter_overlaps(v.ovl, v.trim), v.trim, 400), "n n_comp n_identity n_a n_b n_any n_contained", "",
    OVL_ENDS + f""", f AS ({RULES}), lv AS (SELECT e.* FROM e JOIN f ON f.ovl_id = e.ovl_id WHERE f.flags & 2 = 0), ct AS (SELECT aread AS rid FROM lv WHERE aread <> bread AND atb < ate AND abpos <= atb + 400 AND aepos >= ate - 400
 UNION SELECT bread FROM lv WHERE aread <> bread AND btb < bte AND bbpos <= btb + 400 AND bepos >= bte - 400);;
 SELECT count(*) AS n, count(*) FILTER (comp = 1) AS n_comp, count(*) FILTER (aread = bread) AS n_identity, count(DISTINCT aread) AS n_a, count(DISTINCT bread) AS n_b,
 (SELECT count(*) FROM (SELECT aread FROM lv UNION SELECT bread FROM lv)) AS n_any, (SELECT count(*) FROM ct) AS n_contained FROM lv""", "ovl trim",
)
big = lambda v: v.contigs.select("cid", (F.col("len") * 400).alias("len"))
BIG = " bg AS (SELECT cid, len * 400 AS len FROM contigs), rk AS (SELECT len, sum(len) OVER (ORDER BY len DESC, cid ROWS UNBOUNDED PRECEDING) AS cum, row_number() OVER (ORDER BY len DESC, cid) AS k, sum(len) OVER () AS total FROM bg)"
add(
    "ng_table", lambda v: U.ng_table(big(v), 300_000_000), "pct n_len n_count", "",
    BIG + ";; SELECT pct, arg_min(len, k) AS n_len, min(k) AS n_count FROM rk, (SELECT unnest(range(10, 101, 10)) AS pct) WHERE cum * 100 >= 300000000::HUGEINT * pct GROUP BY pct", "contigs",
)
BOUNDS = "(SELECT count(*) FROM bg WHERE len >= {0} AND len < {1}) AS c{2}"
EDGE_LENGTHS = [0, 200_000, 1_000_000, 5_000_000, 10_000_000, 20_000_000, 10**15]
add(
    "assembly_summary", lambda v: U.assembly_summary(big(v), 1_000_000_000), "n bases n50 n50_count ng50 ng50_count longest_1 longest_2 longest_3 c0 c1 c2 c3 c4 c5", "",
    BIG + ", n AS (SELECT arg_min(len, k) AS n50, min(k) AS n50_count FROM rk WHERE cum * 2 >= total), g AS (SELECT arg_min(len, k) AS n, min(k) AS c FROM rk WHERE cum * 2 >= 1000000000);; "
    "SELECT (SELECT count(*) FROM bg) AS n, (SELECT sum(len) FROM bg) AS bases, n50, n50_count, coalesce(g.n, n50) AS ng50, coalesce(c, n50_count) AS ng50_count, "
    + ", ".join(f"(SELECT len FROM rk WHERE k = {i}) AS longest_{i}" for i in (1, 2, 3)) + ", "
    + ", ".join(BOUNDS.format(a, b, i) for i, (a, b) in enumerate(zip(EDGE_LENGTHS, EDGE_LENGTHS[1:], strict=False))) + " FROM n LEFT JOIN g ON true", "contigs",
)

# Rules that need rows to break them
add(
    "filter_broken_traces", lambda v: O.filter_trace(v.ovl, v.trace.where("ovl_id % 7 <> 0 or seg > 0")), "ovl_id", "",
    ";; SELECT o.ovl_id FROM ovl o LEFT JOIN (SELECT ovl_id, sum(blen) AS s FROM trace WHERE ovl_id % 7 <> 0 OR seg > 0 GROUP BY ovl_id) t ON t.ovl_id = o.ovl_id WHERE bbpos + coalesce(s, 0) <> bepos", "ovl trace",
)
MARKED = "CASE WHEN ovl_id % 3 = 0 THEN 128 ELSE 0 END + CASE WHEN ovl_id % 5 = 0 THEN 262144 ELSE 0 END"
add(
    "remove_overlap_kinds", lambda v: O.remove_overlaps(v.ovl.withColumn("flags", F.expr(MARKED)), ["stitched", "module"]), "ovl_id flags", "",
    f" m AS (SELECT ovl_id, {MARKED} AS flags FROM ovl);; SELECT ovl_id, CASE WHEN flags > 0 THEN flags + 2 ELSE 0 END AS flags FROM m", "ovl",
)

# Ends of overlaps and of trims
PLANT = """SELECT ovl_id, aread, seg, tile, CASE WHEN seg = 0 AND ovl_id % 7 = 0 THEN blen WHEN seg = m AND ovl_id % 11 < 2 THEN 5 WHEN seg = m AND ovl_id % 11 = 2 THEN blen ELSE diffs END AS diffs,
 CASE WHEN (seg = 0 AND ovl_id % 13 = 0) OR (seg = m AND ovl_id % 11 < 2) THEN 0 ELSE blen END AS blen FROM (SELECT *, max(seg) OVER (PARTITION BY ovl_id) AS m FROM {trace}) t"""
add(
    "trim_indel_ends", lambda v: S.trim_indel_ends(v.ovl, v.spark.sql(PLANT, trace=v.trace)), "ovl_id abpos aepos bbpos bepos", "cut_first cut_last",
    f""" pt AS ({PLANT.format(trace="trace")}), en AS (SELECT ovl_id, count(*) AS n, arg_min(diffs, seg) AS fd, arg_min(blen, seg) AS fb, arg_max(diffs, seg) AS ld, arg_max(blen, seg) AS lb FROM pt GROUP BY ovl_id),
 ru AS (SELECT o.*, fd, ld, n > 1 AND ((fd = fb AND fd = CASE WHEN abpos = 0 THEN 0 ELSE (abpos + 99) // 100 * 100 - abpos END) OR (fd > 0 AND fb = 0)) AS cut_first,
 n > 1 AND ((ld = lb AND ld = aepos % 100) OR (ld > 2 AND lb = 0)) AS cut_last FROM ovl o JOIN en ON en.ovl_id = o.ovl_id);;
 SELECT ovl_id, CASE WHEN cut_first THEN abpos // 100 * 100 + 100 ELSE abpos END AS abpos, CASE WHEN cut_last THEN aepos // 100 * 100 ELSE aepos END AS aepos,
 CASE WHEN cut_first THEN bbpos + fd ELSE bbpos END AS bbpos, CASE WHEN cut_last THEN bepos - ld ELSE bepos END AS bepos, cut_first, cut_last FROM ru""", "ovl trace",
)
add(
    "rerun_trim", lambda v: O.rerun_trim(O.filter_overlaps(v.ovl, v.trim, max_div=0.06), v.trim, O.segment_quality(v.ovl, v.piles, v.lens), v.lens, d=12), "rid tb te", "",
    OVL_ENDS + "," + QUAL + f""", f AS ({RULES.replace("0.08", "0.06")}), pi AS (SELECT aread AS rid, min(abpos) FILTER (f.flags & 2 = 0 AND aread <> bread) AS b, max(aepos) FILTER (f.flags & 2 = 0 AND aread <> bread) AS x
 FROM ovl o JOIN f ON f.ovl_id = o.ovl_id GROUP BY aread), jt AS (SELECT t.rid, tb, te, b, x, p.rid IS NOT NULL AND (b IS NULL OR tb < b OR te > x) AS redo FROM trim t LEFT JOIN pi p ON p.rid = t.rid),
 gt AS (SELECT q.rid, tile, tile - row_number() OVER (PARTITION BY q.rid ORDER BY tile) AS g FROM tq q JOIN jt ON jt.rid = q.rid WHERE redo AND tile >= (b + 99) // 100 AND tile < x // 100 AND q > 0 AND q < 12),
 rn AS (SELECT rid, min(tile) AS a, max(tile) AS z FROM gt GROUP BY rid, g HAVING count(*) >= 6), nt AS (SELECT r.rid, min(a) * 100 AS nb, least(max(z) * 100 + 100, min(rlen)) AS ne FROM rn r JOIN lens l ON l.rid = r.rid GROUP BY r.rid);;
 SELECT jt.rid, CASE WHEN NOT redo THEN tb WHEN ne - nb >= 1000 THEN nb ELSE 0 END AS tb, CASE WHEN NOT redo THEN te WHEN ne - nb >= 1000 THEN ne ELSE 0 END AS te FROM jt LEFT JOIN nt ON nt.rid = jt.rid""", "ovl trace trim",
)

# Stitches: each overlap in three pieces with holes of different widths
PIECES = """SELECT (aread * 1000000000 + bread) * 3 + p AS ovl_id, aread, bread, comp, alen, blen, CASE WHEN p = 1 THEN 18 ELSE 0 END AS flags,
 abpos + CAST(floor((aepos - abpos) * p / 3) AS BIGINT) AS abpos, abpos + CAST(floor((aepos - abpos) * (p + 1) / 3) AS BIGINT) - CASE WHEN p < 2 THEN (aread * 7 + bread * 3 + p) % 60 ELSE 0 END AS aepos,
 bbpos + CAST(floor((bepos - bbpos) * p / 3) AS BIGINT) AS bbpos, bbpos + CAST(floor((bepos - bbpos) * (p + 1) / 3) AS BIGINT) - CASE WHEN p < 2 THEN (aread + bread * 5) % 70 ELSE 0 END AS bepos, diffs + p AS diffs
 FROM {dove} CROSS JOIN (VALUES (0), (1), (2)) AS s(p)"""
KEYS = "x.aread = y.aread AND x.bread = y.bread AND x.comp = y.comp AND x.ovl_id <> y.ovl_id"
STITCHED = f""" pc AS ({PIECES.format(dove="dove")}), nf AS (SELECT x.ovl_id AS x, arg_max(y.ovl_id, y.aepos - y.abpos) AS y FROM pc x JOIN pc y ON {KEYS} AND x.abpos < y.abpos AND abs(x.aepos - y.abpos) < 40
 AND abs(x.bepos - y.bbpos) < 40 {{0}} GROUP BY x.ovl_id), ch AS (SELECT p.ovl_id, coalesce(n2.y, n1.y) AS last, n1.y AS y1, n2.y AS y2 FROM pc p LEFT JOIN nf n1 ON n1.x = p.ovl_id LEFT JOIN nf n2 ON n2.x = n1.y
 WHERE p.ovl_id NOT IN (SELECT y FROM nf));;
 SELECT p.ovl_id, coalesce(l.aepos, p.aepos) AS aepos, coalesce(l.bepos, p.bepos) AS bepos, p.diffs + coalesce(a.diffs, 0) + coalesce(b.diffs, 0) AS diffs,
 CASE WHEN c.ovl_id IS NULL THEN p.flags | 130 WHEN last IS NULL THEN p.flags ELSE 0 END AS flags FROM pc p LEFT JOIN ch c ON c.ovl_id = p.ovl_id LEFT JOIN pc l ON l.ovl_id = last LEFT JOIN pc a ON a.ovl_id = y1 LEFT JOIN pc b ON b.ovl_id = y2"""
pieces = lambda v: v.spark.sql(PIECES, dove=v.dove)
add("stitch", lambda v: S.stitch(pieces(v)), "ovl_id aepos bepos diffs flags", "", STITCHED.format("AND abs(abs(x.aepos - y.abpos) - abs(x.bepos - y.bbpos)) < 40"), "dove")
add("stitch_aggressive", lambda v: S.stitch(pieces(v).where("diffs % 5 < 4"), aggressive=True), "ovl_id aepos bepos diffs flags", "", STITCHED.replace("AS s(p))", "AS s(p) WHERE (diffs + p) % 5 < 4)").format(""), "dove")

# Reads that turn back on themselves, planted among the overlaps
TURNS = """SELECT 1000000000000 + rid * 10 AS ovl_id, rid AS aread, rid AS bread, 1 AS comp, rlen AS alen, rlen AS blen, CAST(floor(rlen / 4) AS BIGINT) AS abpos, CAST(floor(rlen / 4) AS BIGINT) + 700 + rid % 300 AS aepos,
 CAST(floor(rlen / 4) AS BIGINT) + rid % 7 * 20 AS bbpos, CAST(floor(rlen / 4) AS BIGINT) + rid % 7 * 20 + 700 + rid % 300 AS bepos, 0 AS diffs FROM {lens} WHERE rid % 4 = 1
 UNION ALL SELECT 1000000000000 + rid * 10 + k, rid, rid, 1, rlen, rlen, 300 + 800 * k, 900 + 800 * k, rlen - 1680 + 750 * k, rlen - 1080 + 750 * k, 0 FROM {lens} CROSS JOIN (VALUES (0), (1)) AS s(k) WHERE rid % 4 = 3
 UNION ALL SELECT 1000000000000 + rid * 10, rid, rid, 1, rlen, rlen, 200 + rid % 100, rlen - 200, 200 + rid % 50, rlen - 200 - rid % 100 + rid % 50, 0 FROM {lens} WHERE rid % 4 = 2"""


def turned(v: Fixtures) -> tuple[DataFrame, DataFrame]:
    """All overlaps with the planted ones, and the planted ones' traces."""
    flips = v.spark.sql(TURNS, lens=v.lens)
    tiles = F.explode(F.sequence(F.floor(F.col("abpos") / 100), F.floor((F.col("aepos") - 1) / 100))).alias("tile")
    t = flips.select("ovl_id", "abpos", "aepos", tiles).withColumn("seg", F.col("tile") - F.floor(F.col("abpos") / 100))
    length = F.least("aepos", (F.col("tile") + 1) * 100) - F.greatest("abpos", F.col("tile") * 100)
    return v.ovl.unionByName(flips), t.select("ovl_id", "seg", length.alias("blen"))


MEET = "least({1}, {3}) > greatest({0}, {2})"
TURNED = f""" fl AS ({TURNS.format(lens="lens")}), al AS (SELECT aread, abpos, aepos FROM ovl UNION ALL SELECT aread, abpos, aepos FROM fl),
 al2 AS (SELECT * FROM ovl WHERE aread = bread AND comp = 1 UNION ALL SELECT * FROM fl),
 so AS (SELECT *, row_number() OVER w AS ord, lead(abpos) OVER w AS nab, lead(bbpos) OVER w AS nbb FROM al2 WINDOW w AS (PARTITION BY aread ORDER BY abpos, aepos, bbpos, bepos, ovl_id)),
 sg AS (SELECT *, tile - abpos // 100 AS seg, (aepos - 1) // 100 - abpos // 100 + 1 AS n, greatest(abpos, tile * 100) AS lo, tile * 100 + 100 AS hi, bbpos + greatest(abpos, tile * 100) - abpos AS sb, bbpos + least(aepos, tile * 100 + 100) - abpos AS se
 FROM (SELECT *, unnest(range(CAST(abpos // 100 AS BIGINT), CAST((aepos - 1) // 100 AS BIGINT) + 1)) AS tile FROM so WHERE ovl_id >= 1000000000000 AND {MEET.format("abpos", "aepos", "alen - bepos", "alen - bbpos")})),
 ev AS (SELECT aread, 0 AS kind, ord, seg AS at_, lo, hi, lo AS clo, hi AS chi FROM sg WHERE seg <= n - 3 AND {MEET.format("lo", "hi + 1", "alen - se", "alen - sb - 1")}
 UNION ALL SELECT aread, 1, ord, 0, aepos, nab, (aepos + nab) // 2, (aepos + nab) // 2 FROM so WHERE nab IS NOT NULL AND {MEET.format("aepos", "nab", "alen - nbb", "alen - bepos")}),
 et AS (SELECT ev.*, tb, te, CASE WHEN hi - lo{{0}} < 100 THEN 800 ELSE 400 END AS side FROM ev JOIN trim ON rid = aread WHERE tb < clo AND chi < te),
 ek AS (SELECT *, row_number() OVER (PARTITION BY aread ORDER BY kind, ord, at_) AS k FROM et WHERE (SELECT count(*) FROM al WHERE al.aread = et.aread AND abpos <= greatest(tb, lo - side) AND aepos >= least(te, hi + side)) <= 1),
 fo AS (SELECT DISTINCT aread AS rid, CAST(0 AS BIGINT) AS k, CAST(tb AS BIGINT) AS tb, CAST(te AS BIGINT) AS te FROM ek
 UNION ALL SELECT fo.rid, ek.k, CAST(CASE WHEN fo.tb < clo AND chi < fo.te AND clo - fo.tb < fo.te - chi THEN chi ELSE fo.tb END AS BIGINT), CAST(CASE WHEN fo.tb < clo AND chi < fo.te AND clo - fo.tb >= fo.te - chi THEN clo ELSE fo.te END AS BIGINT)
 FROM fo JOIN ek ON ek.aread = fo.rid AND ek.k = fo.k + 1);; SELECT rid, arg_max(tb, k) AS tb, arg_max(te, k) AS te, max(k) AS n FROM fo GROUP BY rid"""
add("missed_adapters", lambda v: S.missed_adapters(*turned(v), v.trim), "rid tb te n", "", TURNED.format(""), "ovl trim", True)
add(
    "missed_adapters_repeats", lambda v: S.missed_adapters(*turned(v), v.trim, I.merge_intervals(v.iv, by=("rid",))), "rid tb te n", "",
    TURNED.replace(" et AS", f" mi AS ({union('iv', 'rid')}), et AS", 1).format(" - coalesce((SELECT sum(least(hi, mi.end_) - greatest(lo, mi.beg)) FROM mi WHERE mi.rid = ev.aread AND least(hi, mi.end_) > greatest(lo, mi.beg)), 0)"), "ovl trim iv", True,
)

# Edges with strands
add(
    "drop_parallel_live", lambda v: G.drop_parallel_overlaps(O.filter_overlaps(v.ovl, v.trim, max_div=0.2)), "ovl_id", "",
    OVL_ENDS + f", f AS ({RULES.replace('0.08', '0.2')});; SELECT o.ovl_id FROM ovl o JOIN f ON f.ovl_id = o.ovl_id WHERE f.flags & 2 = 0 QUALIFY count(*) OVER (PARTITION BY aread, bread) = 1", "ovl trim",
)
STRANDS = DOVE_ENDS + "," + INSIDE + """, pe AS (SELECT *, 200 * diffs // (aepos - abpos + bepos - bbpos) AS div FROM e WHERE aread NOT IN (SELECT rid FROM cn) AND bread NOT IN (SELECT rid FROM cn)),
 se AS (SELECT aread AS src, bread AS dst, 'l' AS side, bbpos - btb AS ovh, aepos - abpos AS span, div, 'fwd' AS kind FROM pe WHERE abpos = atb AND bbpos > btb
 UNION ALL SELECT bread, aread, CASE WHEN comp = 1 THEN 'l' ELSE 'r' END, ate - aepos, bepos - bbpos, div, 'rev' FROM pe WHERE abpos = atb AND bbpos > btb AND aepos < ate
 UNION ALL SELECT aread, bread, 'r', bte - bepos, aepos - abpos, div, 'fwd' FROM pe WHERE aepos = ate AND bepos < bte
 UNION ALL SELECT bread, aread, CASE WHEN comp = 1 THEN 'r' ELSE 'l' END, abpos - atb, bepos - bbpos, div, 'rev' FROM pe WHERE aepos = ate AND bepos < bte AND abpos > atb)"""
strand = lambda v: G.strand_edges(v.dove, whole(v))
add("strand_edges", strand, "src dst ovh span div", "side kind", STRANDS + ";; SELECT * FROM se", "dove")
add("dedup_strand_edges", lambda v: G.dedup_edges(strand(v)), "src dst ovh span div", "side", STRANDS + ";; SELECT * FROM se QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY side, span DESC, ovh, div) = 1", "dove")
BAD_TRIM = "SELECT rid, CASE WHEN rid % 6 = 0 THEN 700 ELSE 0 END AS tb, CASE WHEN rid % 6 = 1 THEN rlen - 40 ELSE rlen END AS te FROM {0}"
add(
    "overhang_errors", lambda v: G.overhang_errors(v.dove, v.spark.sql(BAD_TRIM.format("{lens}"), lens=v.lens)), "aread bread", "",
    f" w AS ({BAD_TRIM.format('lens')})" + DOVE_ENDS[DOVE_ENDS.index(", e AS"):]
    + ";; SELECT aread, bread FROM e WHERE NOT (abpos = atb AND aepos = ate) AND ((abpos = atb AND bbpos < btb) OR (aepos = ate AND bepos > bte))", "dove",
)
STEPS = "".join(f", s{d} AS (SELECT DISTINCT dst AS rid FROM ed JOIN s{d - 1} ON s{d - 1}.rid = src)" for d in (1, 2, 3))
add(
    "neighborhood_of_dead_ends", lambda v: G.neighborhood(edges(v), G.dead_ends(edges(v)).select(F.col("src").alias("rid")), 3), "rid dist", "",
    EDGES + ", s0 AS (SELECT src AS rid FROM ed GROUP BY src HAVING count(DISTINCT side) = 1)" + STEPS
    + ";; SELECT rid, min(d) AS dist FROM (" + " UNION ALL ".join(f"SELECT rid, {d} AS d FROM s{d}" for d in range(4)) + ") GROUP BY rid", "dove",
)
add(
    "strand_components", lambda v: G.components(strand(v)), "rid component", "",
    STRANDS + ", bo AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM se UNION ALL SELECT dst, src FROM se)), rc AS (SELECT DISTINCT src AS rid, src AS root FROM bo UNION SELECT dst, root FROM rc JOIN bo ON src = rc.rid);;"
    " SELECT rid, min(root) AS component FROM rc GROUP BY rid", "dove", True,
)
