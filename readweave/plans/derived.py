"""Queries over lifted coordinates, pile evidence, chains, paths, patches and the coverage stream, with their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readweave.functions.lineage import shared_folder
from readweave.operators import chains as C
from readweave.operators import evidence as E
from readweave.operators import intervals as I
from readweave.operators import lift as L
from readweave.operators import overlaps as O
from readweave.operators import patches as P
from readweave.operators import paths as W
from readweave.operators import reads as R
from readweave.sources import text as T
from readweave.sources.fixtures import Fixtures
from readweave.streaming import coverage as S

from .catalog import KM, OVL_ENDS, REGISTRY, UNIQUE, add, edges, union, whole

# Lift-over
SEG = """ sg AS (SELECT t.ovl_id, tile, t.diffs AS sdiffs, t.blen AS sl, greatest(abpos, tile * 100) AS sa, least(aepos, (tile + 1) * 100) AS ea,
 bbpos + sum(t.blen) OVER (PARTITION BY t.ovl_id ORDER BY tile ROWS UNBOUNDED PRECEDING) - t.blen AS sb FROM trace t JOIN ovl o ON o.ovl_id = t.ovl_id)"""
LIFT = (
    SEG
    + """, ct AS (SELECT ovl_id, greatest(abpos, beg) AS abeg, least(aepos, end_) AS aend FROM ovl JOIN iv ON iv.rid = aread AND least(aepos, end_) > greatest(abpos, beg)),
 lb AS (SELECT ct.*, x.sb + (abeg - x.sa) * x.sl // (x.ea - x.sa) AS bb, y.sb + (aend - y.sa) * y.sl // (y.ea - y.sa) AS be FROM ct JOIN sg x ON x.ovl_id = ct.ovl_id AND x.tile = abeg // 100 JOIN sg y ON y.ovl_id = ct.ovl_id AND y.tile = (aend - 1) // 100),
 lf AS (SELECT lb.ovl_id, aread, bread AS rid, CASE WHEN comp = 1 THEN blen - be ELSE bb END AS beg, CASE WHEN comp = 1 THEN blen - bb ELSE be END AS end_, abeg, aend FROM lb JOIN ovl o ON o.ovl_id = lb.ovl_id WHERE bb < be)"""
)
add("lift_intervals", lambda v: L.lift_intervals(v.ovl, v.piles, v.iv), "ovl_id aread rid beg end_ abeg aend", "", LIFT + ";; SELECT * FROM lf", "ovl trace iv")
add("homogenize", lambda v: L.homogenize(v.iv, v.ovl, v.piles, v.trim), "rid beg end_", "", LIFT + ", hl AS (SELECT rid, beg, end_ FROM lf WHERE aread <> rid AND aend - abeg >= 500);;" + union("hl", "rid"), "ovl trace iv")
TRIMMED = (
    SEG
    + ","
    + OVL_ENDS
    + """, cl AS (SELECT s.*, CASE WHEN btb > sb AND sl > 0 THEN sa - ((sb - btb) * (ea - sa)) // sl ELSE sa END AS h, CASE WHEN bte < sb + sl AND sl > 0 THEN ea + ((bte - sb - sl) * (ea - sa)) // sl ELSE ea END AS t, atb, ate FROM sg s JOIN e ON e.ovl_id = s.ovl_id),
 cm AS (SELECT *, greatest(sa, atb, h) AS lo, least(ea, ate, t) AS hi FROM cl WHERE greatest(sa, atb, h) < least(ea, ate, t)),
 kp AS (SELECT ovl_id, min(lo) AS ab, max(hi) AS ae, min(sb + (lo - sa) * sl // (ea - sa)) AS bb, max(sb + (hi - sa) * sl // (ea - sa)) AS be, sum(sdiffs * (hi - lo) // (ea - sa)) AS d FROM cm GROUP BY ovl_id)"""
)
add("trim_overlaps", lambda v: L.trim_overlaps(v.ovl, v.trace, v.trim), "ovl_id abpos aepos bbpos bepos diffs flags", "", TRIMMED + ";; SELECT o.ovl_id, coalesce(ab, abpos) AS abpos, coalesce(ae, aepos) AS aepos, coalesce(bb, bbpos) AS bbpos, coalesce(be, bepos) AS bepos, coalesce(d, diffs) AS diffs, CASE WHEN ab IS NULL THEN 131074 ELSE 0 END AS flags FROM ovl o LEFT JOIN kp ON kp.ovl_id = o.ovl_id", "ovl trace trim")
# Edits of the lift to corrected reads: each overlap's start gains or loses a few bases there.
EDITS = "SELECT aread AS rid, abpos AS pos, ovl_id % 7 - 3 AS n FROM ovl WHERE ovl_id % 7 <> 3 AND abpos > 0"
add(
    "lift_corrected",
    lambda v: L.lift_corrected(v.iv.select("rid", F.col("beg").alias("pos")), v.ovl.where("ovl_id % 7 <> 3 and abpos > 0").select(F.col("aread").alias("rid"), F.col("abpos").alias("pos"), (F.col("ovl_id") % 7 - 3).alias("n")), v.lens),
    "rid pos new_pos",
    "",
    f""" ed AS (SELECT rid, pos, sum(n) AS n FROM ({EDITS} UNION ALL SELECT rid, 0, 0 FROM lens) GROUP BY ALL),
 bk AS (SELECT ed.rid, pos, n, sum(n) OVER w AS shift, coalesce(lead(pos) OVER w, rlen) AS oe FROM ed JOIN lens l ON l.rid = ed.rid WINDOW w AS (PARTITION BY ed.rid ORDER BY pos));;
 SELECT iv.rid, iv.beg AS pos, iv.beg + shift AS new_pos FROM iv LEFT JOIN bk ON bk.rid = iv.rid AND iv.beg >= bk.pos - least(n, 0) AND iv.beg < oe""",
    "ovl iv",
)

# Evidence from piles
add("extend_edges", lambda v: E.extend_edges(I.merge_intervals(v.iv, by=("rid",)), v.ovl, v.lens, more_than=0), "rid beg end_", "", f""" m AS ({union("iv", "rid")}), lo AS (SELECT * FROM ovl WHERE aread <> bread);;
 SELECT m.rid, CASE WHEN beg < 1000 AND EXISTS (SELECT 1 FROM lo WHERE lo.aread = m.rid AND abpos = 0 AND abs(aepos - m.end_) <= 200) THEN 0 ELSE beg END AS beg,
 CASE WHEN rlen - end_ < 1000 AND EXISTS (SELECT 1 FROM lo WHERE lo.aread = m.rid AND aepos = alen AND abs(abpos - m.beg) <= 200) THEN rlen ELSE end_ END AS end_ FROM m JOIN lens l ON l.rid = m.rid""", "ovl iv")  # fmt: skip
GAPS = """ us AS (SELECT * FROM ovl WHERE aread <> bread), th AS (SELECT aread, CAST((abpos + 450) // 100 AS BIGINT) AS b, CAST((aepos - 450) // 100 AS BIGINT) AS e FROM us x WHERE (abpos + 450) // 100 <= (aepos - 450) // 100
 AND NOT EXISTS (SELECT 1 FROM us y WHERE y.aread = x.aread AND y.bread = x.bread AND x.abpos < y.aepos AND y.abpos < x.aepos AND (y.aepos - y.abpos, -y.ovl_id) > (x.aepos - x.abpos, -x.ovl_id))),
 cb AS (SELECT aread, bin, count(*) AS n FROM (SELECT aread, unnest(range(b, e + 1)) AS bin FROM th) GROUP BY ALL), en AS (SELECT aread, min(b) AS b, max(e) AS e FROM th GROUP BY aread),
 lw AS (SELECT a.aread, a.bin FROM (SELECT aread, unnest(range(b, e + 1)) AS bin FROM en) a LEFT JOIN cb ON cb.aread = a.aread AND cb.bin = a.bin WHERE coalesce(n, 0) <= 1),
 rn AS (SELECT aread, min(bin) * 100 AS beg, (max(bin) + 1) * 100 AS end_ FROM (SELECT *, bin - row_number() OVER (PARTITION BY aread ORDER BY bin) AS g FROM lw) GROUP BY aread, g),
 gp AS (SELECT rn.* FROM rn JOIN en ON en.aread = rn.aread WHERE beg > b * 100 AND end_ < (e + 1) * 100)"""
add("pile_gaps", lambda v: E.pile_gaps(v.ovl), "aread beg end_", "", GAPS + ";; SELECT * FROM gp", "ovl")
add("detect_gaps", lambda v: E.detect_gaps(v.ovl), "ovl_id flags", "", GAPS + """, lg AS (SELECT aread, (abpos + aepos) // 2 AS m FROM us QUALIFY row_number() OVER (PARTITION BY aread ORDER BY aepos - abpos DESC, ovl_id) = 1),
 si AS (SELECT gp.aread, max(CASE WHEN beg <= m THEN beg END) AS l, min(CASE WHEN beg > m THEN end_ END) AS r FROM gp JOIN lg ON lg.aread = gp.aread GROUP BY gp.aread);;
 SELECT ovl_id, CASE WHEN o.aread <> bread AND (coalesce(abpos + aepos < 2 * l, false) OR coalesce(abpos + aepos > 2 * r, false)) THEN 65538 ELSE 0 END AS flags FROM ovl o LEFT JOIN si ON si.aread = o.aread""", "ovl")  # fmt: skip
add("drop_worst", lambda v: E.drop_worst(v.ovl, v.trim), "ovl_id flags", "", OVL_ENDS + """, lv AS (SELECT *, aepos - abpos AS span, 1000000 * diffs // (aepos - abpos) AS div, CASE WHEN abpos <= atb THEN 1 ELSE 0 END AS i, CASE WHEN aepos >= ate THEN 1 ELSE 0 END AS x FROM e WHERE aread <> bread),
 rk AS (SELECT *, CASE WHEN 100 * sum(span) OVER w <= 10 * sum(span) OVER p AND div >= 50000 AND (sum(i) OVER p - sum(i) OVER w >= 3 OR i = 0) AND (sum(x) OVER p - sum(x) OVER w >= 3 OR x = 0) THEN 1 ELSE 0 END AS ok FROM lv
 WINDOW p AS (PARTITION BY aread), w AS (PARTITION BY aread ORDER BY div DESC, ovl_id ROWS UNBOUNDED PRECEDING)), dw AS (SELECT ovl_id, min(ok) OVER (PARTITION BY aread ORDER BY div DESC, ovl_id ROWS UNBOUNDED PRECEDING) AS ok FROM rk);;
 SELECT o.ovl_id, CASE WHEN ok = 1 THEN 34 ELSE 0 END AS flags FROM ovl o LEFT JOIN dw ON dw.ovl_id = o.ovl_id""", "ovl trim")  # fmt: skip
from .catalog import QUAL  # noqa: E402

add("q_histogram", lambda v: E.q_histogram(O.segment_quality(v.ovl, v.piles, v.lens), v.trim, v.lens, v.iv), "q n", "", QUAL + ", tr AS (SELECT * FROM trim WHERE te - tb >= 1000)," + UNIQUE.format("tr") + """, ut AS (SELECT rid, unnest(range(CAST((ubeg + 199) // 100 AS BIGINT), CAST((uend - 100) // 100 AS BIGINT))) AS tile FROM u0 WHERE uend - ubeg > 300);;
 SELECT least(q, 99) AS q, count(*) AS n FROM tq JOIN ut ON ut.rid = tq.rid AND ut.tile = tq.tile GROUP BY 1""", "ovl trace iv trim")  # fmt: skip
add("fit_lognormal", lambda v: E.fit_lognormal(v.lens, "rlen").select(F.round("mu", 6).alias("mu"), F.round("sigma", 6).alias("sigma")), "", "mu sigma", ";; SELECT round(avg(ln(rlen)), 6) AS mu, round(stddev_pop(ln(rlen)), 6) AS sigma FROM lens", "lens")
add("fit_normal", lambda v: E.fit_normal(v.lens, "rlen").select(F.round("mu", 6).alias("mu"), F.round("sigma", 6).alias("sigma")), "", "mu sigma", ";; SELECT round(avg(rlen), 6) AS mu, round(stddev_pop(rlen), 6) AS sigma FROM lens", "lens")
add("repeat_bases", lambda v: E.repeat_bases(v.contigs, v.iv), "cid len bp pct", "", f""" m AS ({union("iv")}), pb AS (SELECT cid, track, sum(least(len, end_) - beg) AS bp FROM contigs JOIN m ON m.rid = cid AND beg < len GROUP BY ALL), mb AS (SELECT cid, max(bp) AS bp FROM pb GROUP BY cid);;
 SELECT c.cid, len, coalesce(bp, 0) AS bp, CASE WHEN len > 0 THEN 100 * coalesce(bp, 0) // len ELSE 0 END AS pct FROM contigs c LEFT JOIN mb ON mb.cid = c.cid""", "contigs iv")  # fmt: skip
KH = KM + ", kc AS (SELECT kmer, least(count(*), 255) AS n FROM km GROUP BY kmer), hs AS (SELECT n, count(*) AS kmers FROM kc GROUP BY n)"
add("kmer_cutoffs", lambda v: E.kmer_cutoffs(R.kmer_histogram(v.reads, 14)), "repeat_cut noise_cut", "", KH + ", hw AS (SELECT n, sum(kmers) OVER (ORDER BY n DESC) AS cum, sum(kmers) OVER () AS al, kmers > lag(kmers) OVER (ORDER BY n) AS rise, lag(n) OVER (ORDER BY n) AS prev FROM hs);; SELECT coalesce(min(CASE WHEN 100 * cum <= al THEN n END), max(n) + 1) AS repeat_cut, coalesce(min(CASE WHEN rise THEN prev END), 1) AS noise_cut FROM hw", "reads")
add("kmer_windows", lambda v: E.kmer_windows(v.reads, 14, 1, 4), "rid beg end_", "track", KH + """, wn AS (SELECT rid, (pos - 1) // 500 AS w, count(*) AS c, count(*) FILTER (n <= 1) AS lo, count(*) FILTER (n >= 4) AS hi FROM km JOIN kc ON kc.kmer = km.kmer GROUP BY ALL),
 wt AS (SELECT CASE WHEN 2 * lo > c THEN 'noise' ELSE 'repeat' END AS track, rid, w * 500 AS beg, w * 500 + c AS end_ FROM wn WHERE 2 * lo > c OR 2 * hi > c);;""" + union("wt"), "reads")  # fmt: skip
add("self_seed_hits", lambda v: E.self_seed_hits(v.reads, k=14), "rid band score total amin amax", "", KM + """, sp AS (SELECT * FROM (SELECT rid, pos, (pos - lag(pos) OVER (PARTITION BY rid, kmer ORDER BY pos)) // 16 AS band FROM km) WHERE band IS NOT NULL),
 sc AS (SELECT rid, band, sum(c) AS score, min(pos) AS amin, max(pos) AS amax FROM (SELECT *, least(14, coalesce(pos - lag(pos) OVER (PARTITION BY rid, band ORDER BY pos), 14)) AS c FROM sp) GROUP BY ALL);;
 SELECT * FROM (SELECT a.*, a.score + coalesce(b.score, 0) AS total FROM sc a LEFT JOIN sc b ON b.rid = a.rid AND b.band = a.band + 1) WHERE total >= 35""", "reads")  # fmt: skip
CR = " cr AS (SELECT DISTINCT aread // 20 AS cid, bread AS rid FROM ovl)"
add("contig_read_intersection", lambda v: E.contig_read_intersection(v.ovl.select(F.floor(F.col("aread") / 20).alias("cid"), F.col("bread").alias("rid"))).withColumn("alternative", F.col("alternative").cast("int")), "c1 c2 shared n1 n2 alternative", "", CR + """, z AS (SELECT cid, count(*) AS n FROM cr GROUP BY cid), sh AS (SELECT a.cid AS c1, b.cid AS c2, count(*) AS shared FROM cr a JOIN cr b ON a.rid = b.rid AND a.cid < b.cid GROUP BY ALL);;
 SELECT c1, c2, shared, x.n AS n1, y.n AS n2, CASE WHEN 2 * shared > least(x.n, y.n) THEN 1 ELSE 0 END AS alternative FROM sh JOIN z x ON x.cid = c1 JOIN z y ON y.cid = c2 WHERE 100 * shared > least(x.n, y.n)""", "ovl")  # fmt: skip
add("contig_coverage", lambda v: E.contig_coverage(v.ovl.select(F.floor(F.col("aread") / 20).alias("cid"), F.col("aread").alias("rid"), "abpos", "aepos", "alen")), "cid rid entering leaving cov open_bins", "", """ fb AS (SELECT aread, count(DISTINCT bin) AS f FROM (SELECT aread, unnest(range(CAST((abpos + 499) // 500 AS BIGINT), CAST(aepos // 500 AS BIGINT))) AS bin FROM ovl) GROUP BY aread), cg AS (SELECT aread, count(*) FILTER (abpos = 0) AS entering, count(*) FILTER (aepos = alen) AS leaving, sum(aepos - abpos) // any_value(alen) AS cov, any_value(alen) AS alen FROM ovl GROUP BY aread);;
 SELECT cg.aread // 20 AS cid, cg.aread AS rid, entering, leaving, cov, alen // 500 - coalesce(f, 0) AS open_bins FROM cg LEFT JOIN fb ON fb.aread = cg.aread""", "ovl")  # fmt: skip

# Chains. The rows with twins chain a pair's overlaps of one strand in their order.
CH = """ ch AS (SELECT *, comp AS chain, row_number() OVER w AS rank, abpos - lag(aepos) OVER w AS agap, bbpos - lag(bepos) OVER w AS bgap FROM ovl WHERE aread <> bread WINDOW w AS (PARTITION BY aread, bread, comp ORDER BY abpos, ovl_id)),
 du AS ({union}), gd AS (SELECT ovl_id FROM ch JOIN du ON du.rid = aread AND du.beg < abpos AND du.end_ > abpos - agap WHERE agap > 0 GROUP BY ovl_id, agap HAVING 100 * sum(least(du.end_, abpos) - greatest(du.beg, abpos - agap)) >= 80 * agap)""".replace("{union}", union("dust", "rid"))
DUST = " dust AS (SELECT * FROM iv WHERE track = 'dust'),"


def strand_chains(v: Fixtures) -> DataFrame:
    w = Window.partitionBy("aread", "bread", "comp").orderBy("abpos", "ovl_id")
    return v.ovl.where("aread <> bread").withColumn("chain", F.col("comp")).withColumn("rank", F.row_number().over(w))


dust = lambda v: v.iv.where("track = 'dust'")
add("validate_chains", lambda v: C.validate_chains(strand_chains(v), v.trim, dust(v)).withColumn("valid", F.col("valid").cast("int")), "aread bread chain n ab ae bb be bad_gaps valid", "", DUST + CH + "," + OVL_ENDS + """, cs AS (SELECT ch.aread, ch.bread, chain, count(*) AS n, min(ch.abpos) AS ab, max(ch.aepos) AS ae, min(ch.bbpos) AS bb, max(ch.bepos) AS be, sum(ch.diffs) AS d, sum(ch.aepos - ch.abpos) AS sa, sum(ch.bepos - ch.bbpos) AS sb, any_value(atb) AS atb, any_value(ate) AS ate, any_value(btb) AS btb, any_value(bte) AS bte,
 count(*) FILTER ((coalesce(agap > 200, false) OR coalesce(bgap > 200, false)) AND NOT (gd.ovl_id IS NOT NULL AND agap > 0)) AS bad_gaps FROM ch JOIN e ON e.ovl_id = ch.ovl_id LEFT JOIN gd ON gd.ovl_id = ch.ovl_id GROUP BY ALL);;
 SELECT *, CASE WHEN (ab <= atb + 200 OR bb <= btb + 200) AND (ae >= ate - 200 OR be >= bte - 200) AND 100 * least(sa, sb) >= 50 * least(ate - atb, bte - btb) AND bad_gaps = 0 AND d <= 0.2::DOUBLE * least(sa, sb) AND sa > 1000 AND sb > 1000 THEN 1 ELSE 0 END AS valid FROM cs""", "ovl trim iv")  # fmt: skip
add("stitch_chains", lambda v: C.stitch_chains(strand_chains(v), dust(v), 400, 1500, 2), "aread bread chain piece abpos aepos bbpos bepos diffs", "", DUST + CH + """, nw AS (SELECT ch.*, CASE WHEN rank > 1 AND (greatest(agap, bgap) < 400 OR (greatest(agap, bgap) < 1500 AND gd.ovl_id IS NOT NULL)) THEN 0 ELSE 1 END AS nw FROM ch LEFT JOIN gd ON gd.ovl_id = ch.ovl_id), pc AS (SELECT *, sum(nw) OVER (PARTITION BY aread, bread, chain ORDER BY rank) - 1 AS piece, sum(nw) OVER (PARTITION BY aread, bread, chain) AS k FROM nw);;
 SELECT aread, bread, chain, piece, min(abpos) AS abpos, max(aepos) AS aepos, min(bbpos) AS bbpos, max(bepos) AS bepos, sum(diffs) AS diffs FROM pc WHERE k <= 2 GROUP BY ALL""", "ovl iv")  # fmt: skip
add("contig_relations", lambda v: C.contig_relations(strand_chains(v)), "aread bread chain cov", "relation", """ cs AS (SELECT aread, bread, comp AS chain, sum(aepos - abpos) AS cov, min(abpos) AS ab, max(aepos) AS ae, any_value(alen) AS alen FROM ovl WHERE aread <> bread GROUP BY ALL);;
 SELECT * FROM (SELECT *, CASE WHEN 2 * cov >= alen THEN 'contained' WHEN cov >= 3000 AND ab >= 100000 AND alen - ae >= 100000 THEN 'bridge' WHEN 10 * cov >= 4 * alen THEN 'repeat' END AS relation FROM cs) WHERE relation IS NOT NULL""", "ovl")  # fmt: skip
add("separate", lambda v: C.separate(strand_chains(v), v.trim, 1), "ovl_id", "", OVL_ENDS + """, cs AS (SELECT aread, bread, comp, (min(abpos) <= min(atb) + 1000 OR min(bbpos) <= min(btb) + 1000) AND (max(aepos) >= min(ate) - 1000 OR max(bepos) >= min(bte) - 1000) AS pr FROM e WHERE aread <> bread GROUP BY ALL), st AS (SELECT aread, bread FROM cs GROUP BY ALL HAVING count(*) = 1 AND NOT bool_or(pr));;
 SELECT ovl_id FROM ovl JOIN st ON st.aread = ovl.aread AND st.bread = ovl.bread""", "ovl trim")  # fmt: skip
add("filter_circular", lambda v: C.filter_circular(v.ovl, 2500, 1000, 25, 30, 2500, 6000), "ovl_id flags", "", """ cg AS (SELECT *, abpos - lag(aepos) OVER w AS ag, coalesce(bbpos < lag(bepos) OVER w - 25, false) AS wr, lag(bepos) OVER w AS lb FROM ovl WINDOW w AS (PARTITION BY aread, bread ORDER BY abpos, ovl_id)),
 cs AS (SELECT aread, bread, count(DISTINCT comp) = 1 AND coalesce(max(greatest(ag, CASE WHEN wr THEN blen - lb + bbpos ELSE bbpos - lb END)), 0) <= 1000 AND count(*) FILTER (wr) <= 1 AND min(abpos) <= 2500 AND any_value(alen) - max(aepos) <= 2500 AND 100 * sum(bepos - bbpos) >= 30 * any_value(blen) AS ok FROM cg GROUP BY ALL);;
 SELECT ovl_id, CASE WHEN ok THEN 0 ELSE 2 END | CASE WHEN blen < 2500 OR blen > 6000 THEN 1026 ELSE 0 END AS flags FROM ovl o JOIN cs ON cs.aread = o.aread AND cs.bread = o.bread""", "ovl")  # fmt: skip
REGISTRY.add("chain_overlaps", lambda spark, d: (lambda v: C.chain_overlaps(v.ovl, v.iv).select("ovl_id", "aread", "bread", "chain", "rank"))(Fixtures(spark, d)))

# Patches and correction
BRK = """ bn AS (SELECT *, lead(abpos) OVER w AS nab, lead(bbpos) OVER w AS nbb FROM ovl WHERE aread <> bread WINDOW w AS (PARTITION BY aread, bread, comp ORDER BY abpos, aepos, ovl_id)),
 bc AS (SELECT aread, bread, comp, aepos // 100 * 100 AS beg, (nab + 99) // 100 * 100 AS end_, bepos AS bb, nbb AS be FROM bn WHERE nab > aepos AND nbb >= bepos AND nbb - bepos <= 10 * (nab - aepos)),
 bk AS (SELECT * FROM bc WHERE (SELECT count(*) FROM ovl o WHERE o.aread = bc.aread AND o.bread <> o.aread AND abpos + 400 <= bc.beg AND aepos - 400 >= bc.end_) <= 7)"""
add("break_candidates", lambda v: P.break_candidates(v.ovl), "aread bread comp beg end_ bb be", "", BRK + ";; SELECT * FROM bk", "ovl")
add("merge_breaks", lambda v: P.merge_breaks(P.break_candidates(v.ovl), max_gap=5000, support=1), "aread beg end_ bread comp bb be support", "", BRK + """, k1 AS (SELECT *, be - bb AS bl, CASE WHEN be - bb - lag(be - bb) OVER w < 50 THEN 0 ELSE 1 END AS nw FROM bk WINDOW w AS (PARTITION BY aread, beg, end_ ORDER BY be - bb)),
 k2 AS (SELECT *, sum(nw) OVER (PARTITION BY aread, beg, end_ ORDER BY bl) AS k FROM k1), k3 AS (SELECT aread, beg, end_, k, count(*) AS n, min((bl, bread, comp, bb, be)) AS b FROM k2 GROUP BY ALL),
 k4 AS (SELECT *, CASE WHEN beg < max(end_) OVER (PARTITION BY aread ORDER BY beg, end_, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS nw FROM k3), k5 AS (SELECT *, sum(nw) OVER (PARTITION BY aread ORDER BY beg, end_, k ROWS UNBOUNDED PRECEDING) AS g FROM k4),
 k6 AS (SELECT *, sum(n) OVER (PARTITION BY aread, g) AS support, row_number() OVER (PARTITION BY aread, g ORDER BY n DESC, beg, end_, k) AS r FROM k5);;
 SELECT aread, beg, end_, b[2] AS bread, b[3] AS comp, b[4] AS bb, b[5] AS be, support FROM k6 WHERE r = 1 AND end_ - beg < 5000""", "ovl")  # fmt: skip
PILE = SEG + """, tp AS (SELECT aread, tile, s.ovl_id, bread, comp, o.blen, sb, sb + sl AS eb, sdiffs, row_number() OVER (PARTITION BY aread, tile ORDER BY sdiffs, s.ovl_id) AS k FROM sg s JOIN ovl o ON o.ovl_id = s.ovl_id WHERE ea - sa = 100 AND aread <> bread QUALIFY k <= 20)"""
add("tile_pile", lambda v: P.tile_pile(v.ovl, v.piles), "aread tile ovl_id sb eb sdiffs k", "", PILE + ";; SELECT * FROM tp", "ovl trace")
LREADS = "substr(repeat(seq, CAST(floor(rlen / length(seq)) AS INT) + 1), 1, CAST(rlen AS INT))"


def long_reads(v: Fixtures) -> DataFrame:
    """Sequences as long as the overlaps say: the text's letters, repeated."""
    return v.reads.where("seq <> ''").join(v.lens, "rid").select("rid", F.expr(LREADS).alias("seq"), "rlen")


LR = f", lr AS (SELECT r.rid, {LREADS} AS seq FROM reads r JOIN lens l ON l.rid = r.rid WHERE seq <> '')"
CONS = PILE + LR + """, vt AS (SELECT aread, tile, substr(CASE WHEN comp = 1 THEN reverse(translate(seq, 'acgt', 'tgca')) ELSE seq END, CAST(sb + 1 AS BIGINT), CAST(eb - sb AS BIGINT)) AS piece, 0 AS own FROM tp JOIN lr ON lr.rid = bread UNION ALL SELECT DISTINCT aread, tile, substr(seq, tile * 100 + 1, 100), 1 FROM tp JOIN lr ON lr.rid = aread),
 vn AS (SELECT aread, tile, piece, count(*) AS n, max(own) AS own FROM vt GROUP BY ALL)"""
add("tile_consensus", lambda v: P.tile_consensus(P.tile_pile(v.ovl, v.piles), long_reads(v)), "aread tile used", "seq", CONS + ";; SELECT aread, tile, piece AS seq, n AS used FROM vn QUALIFY row_number() OVER (PARTITION BY aread, tile ORDER BY n DESC, own DESC, piece) = 1", "ovl trace reads")
add("assemble_corrected", lambda v: P.assemble_corrected(P.tile_consensus(P.tile_pile(v.ovl, v.piles), long_reads(v))).select("rid", "first_tile", "last_tile", F.md5("seq").alias("digest")), "rid first_tile last_tile", "digest", CONS + ", cq AS (SELECT aread, tile, piece FROM vn QUALIFY row_number() OVER (PARTITION BY aread, tile ORDER BY n DESC, own DESC, piece) = 1);; SELECT aread AS rid, min(tile) AS first_tile, max(tile) AS last_tile, md5(string_agg(piece, '' ORDER BY tile)) AS digest FROM cq GROUP BY aread", "ovl trace reads")
patches = lambda v: P.merge_breaks(P.break_candidates(v.ovl), max_gap=5000, support=1)
REGISTRY.add("apply_patches", lambda spark, d: (lambda v: P.apply_patches(long_reads(v), patches(v), v.trim))(Fixtures(spark, d)))
REGISTRY.add("shift_intervals", lambda spark, d: (lambda v: P.shift_intervals(v.iv, P.kept_pieces(patches(v), v.lens, v.trim)))(Fixtures(spark, d)))
REGISTRY.add("weak_tiles", lambda spark, d: (lambda v: P.weak_tiles(P.tile_pile(v.ovl, v.piles), O.segment_quality(v.ovl, v.piles, v.lens), patches(v), 9))(Fixtures(spark, d)))

# Paths and contigs
REGISTRY.add("best_next", lambda spark, d: W.best_next(edges(Fixtures(spark, d)), 4))
paths = lambda v: W.build_paths(edges(v), W.best_next(edges(v), 4))
REGISTRY.add("build_paths", lambda spark, d: paths(Fixtures(spark, d)))
REGISTRY.add("path_to_contigs", lambda spark, d: (lambda v: W.path_to_contigs(paths(v), long_reads(v), whole(v), edges(v)))(Fixtures(spark, d)))
REGISTRY.add("path_rows", lambda spark, d: T.path_text(paths(Fixtures(spark, d))))
add("show_reads", lambda v: T.show_reads(v.reads, [(0, 10**9)], 500).select("rid", F.md5("seq").alias("digest")), "rid", "digest", ";; SELECT rid, md5(seq) AS digest FROM reads WHERE length(seq) >= 500", "reads")
add("interval_rows", lambda v: T.interval_text(I.merge_intervals(v.iv), "x", True), "", "value", f" m AS ({union('iv')});; SELECT 'x ' || rid || ' ' || beg || ' ' || end_ || ' ' || coalesce(CAST(beg - lag(end_) OVER (PARTITION BY track, rid ORDER BY beg, end_) AS VARCHAR), '-') AS value FROM m", "iv")

# Coverage stream
MASK = """ cs AS (SELECT ovl_id % 10 AS batch, aread, bread, greatest(abpos, 100) AS beg, least(aepos, alen - 100) AS end_ FROM ovl WHERE greatest(abpos, 100) < least(aepos, alen - 100)), co AS ({one}),
 dl AS (SELECT rid, pos, sum(d) AS d FROM (SELECT aread AS rid, beg AS pos, 1 AS d FROM co UNION ALL SELECT aread, end_, -1 FROM co) GROUP BY ALL), rs AS (SELECT rid, pos AS beg, lead(pos) OVER w AS end_, least(sum(d) OVER w, 255) AS cov FROM dl WINDOW w AS (PARTITION BY rid ORDER BY pos)), hi AS (SELECT rid, beg, end_ FROM rs WHERE end_ IS NOT NULL AND cov > 10);;""".replace("{one}", union("cs", "batch, aread, bread")) + union("hi", "rid")
batches = lambda v: v.ovl.withColumn("batch_id", F.col("ovl_id") % 10)
add("coverage_mask", lambda v: S.mask_from_coverage(S.coverage_runs(S.coverage_deltas(batches(v), 100)), 5), "rid beg end_", "", MASK, "ovl")


def streamed(v: Fixtures) -> DataFrame:
    """The same mask by way of a stream: the overlaps as files, a folder for each batch, read in several triggers."""
    spark: SparkSession = v.spark
    base = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    batches(v).repartition(5, "batch_id").write.parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
    S.coverage_stream(stream, f"{base}/log", f"{base}/state", keep_ends=100).awaitTermination()
    return S.mask_from_coverage(S.coverage_runs(S.read_log(spark, f"{base}/log")), 5)


add("coverage_stream", streamed, "rid beg end_", "", MASK, "ovl")
