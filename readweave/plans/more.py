"""Queries over chimeras, contig trims, modules, nested chains, shared coverage and error models, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readweave.functions.lineage import settled
from readweave.operators import chains as C
from readweave.operators import chimera as X
from readweave.operators import classes as Y
from readweave.operators import evidence as V
from readweave.operators import intervals as I
from readweave.operators import modules as R
from readweave.operators import patches as P
from readweave.operators import paths as W
from readweave.operators import reads as K
from readweave.operators import trimming as T
from readweave.sources.fixtures import Fixtures

from .catalog import ENDS, REGISTRY, UNIQUE, add, edges, union
from .derived import KH, LR, PILE, long_reads

# Chimeras
WALL_CHAINS = """ sc AS (SELECT aread, bread, comp, count(*) AS n, min(abpos) AS ab, max(aepos) AS ae, min(bbpos) AS bb, max(bepos) AS be, sum(aepos - abpos) AS len, any_value(btb) AS btb, any_value(bte) AS bte
  FROM e WHERE aread <> bread GROUP BY ALL),
 lc AS (SELECT *, sum(n) OVER (PARTITION BY aread, bread) AS al FROM sc QUALIFY row_number() OVER (PARTITION BY aread, bread ORDER BY len DESC, comp) = 1),
 cr AS (SELECT aread, ab + 200 + CASE WHEN al = 1 THEN 1 ELSE 0 END AS low, ae - 200 - CASE WHEN al = 1 THEN 1 ELSE 0 END AS high, CASE WHEN al = 1 OR bb <= btb THEN 0 ELSE ab END AS nl, CASE WHEN al = 1 OR be >= bte THEN 2147483647 ELSE ae END AS nh
  FROM lc WHERE len >= 1000 + CASE WHEN al = 1 THEN 1 ELSE 0 END)"""
WALL_ROWS = """ pf AS (SELECT *, row_number() OVER w AS f, lead(ovl_id) OVER w AS nx, row_number() OVER p AS pk, count(*) OVER (PARTITION BY aread) AS pn,
  bbpos > 1000 AND abpos > atb + 1000 AND abpos + 100 < ate AS late, bepos + 1000 < blen AND aepos + 1000 < ate AND aepos - 100 > atb AS early FROM e WHERE atb < ate
  WINDOW w AS (PARTITION BY aread, bread ORDER BY comp, abpos, aepos, bbpos, bepos, ovl_id), p AS (PARTITION BY aread ORDER BY bread, comp, abpos, aepos, bbpos, bepos, ovl_id)),
 sd AS (SELECT aread, CASE WHEN nx IS NULL AND early THEN 'end' WHEN f = 1 AND late THEN 'begin' END AS side, CASE WHEN nx IS NULL AND early THEN aepos ELSE abpos END // 100 AS tile FROM pf
  WHERE pk > 1 AND pk < pn AND NOT (f = 1 AND nx IS NULL AND early AND late)),
 tl AS (SELECT aread, side, tile, count(*) AS n FROM sd WHERE side IS NOT NULL GROUP BY ALL),
 lk AS (SELECT aread, side, spot, sum(CASE WHEN tile = spot THEN n ELSE 0 END) AS h, sum(n) AS b FROM (SELECT *, unnest([tile, tile - 1]) AS spot FROM tl) WHERE spot >= 0 GROUP BY ALL HAVING sum(n) >= 4),
 wl AS (SELECT aread, side, spot, CASE WHEN h >= 4 THEN spot ELSE spot + 1 END AS wall FROM lk),
 pr AS (SELECT a.aread, a.spot AS i0, a.wall AS wi, b.spot AS j0, b.wall AS wj, least(a.wall, b.wall) * 100 AS lo, greatest(a.wall, b.wall) * 100 AS hi FROM wl a JOIN wl b ON a.aread = b.aread AND a.side = 'end' AND b.side = 'begin')"""
WALL_FOLD = """ rp AS ({union}),
 rb AS (SELECT p.aread, lo, hi, sum(least(hi, end_) - greatest(lo, beg)) AS rep FROM (SELECT DISTINCT aread, lo, hi FROM pr) p JOIN rp ON rp.rid = p.aread AND least(hi, end_) > greatest(lo, beg) GROUP BY ALL),
 cd AS (SELECT pr.*, row_number() OVER (PARTITION BY pr.aread ORDER BY i0, j0) AS k, pr.hi - pr.lo > 8000 OR (pr.hi - pr.lo > 1000 AND 100 * coalesce(rep, 0) < 70 * (pr.hi - pr.lo)) AS rej,
  (SELECT list({'a': nl, 'e': nh}) FROM cr WHERE cr.aread = pr.aread AND low <= pr.lo AND high >= pr.hi) AS sp FROM pr LEFT JOIN rb ON rb.aread = pr.aread AND rb.lo = pr.lo AND rb.hi = pr.hi),
 st AS (SELECT t.rid AS aread, CAST(0 AS BIGINT) AS k, CAST(tb AS BIGINT) AS rb, CAST(te AS BIGINT) AS re, CAST(0 AS BIGINT) AS n, CAST(tb // 100 AS BIGINT) AS ni, CAST(0 AS BIGINT) AS nj, CAST(-1 AS BIGINT) AS ci, false AS act FROM trim t WHERE t.rid IN (SELECT aread FROM cd) AND tb < te
  UNION ALL SELECT aread, k, CASE WHEN cut AND (n = 0 OR lo < re) AND lo - rb <= re - hi THEN hi ELSE rb END, CASE WHEN cut AND (n = 0 OR lo < re) AND lo - rb > re - hi THEN lo ELSE re END, n + CAST(cut AS INT), ni,
   CASE WHEN v AND rej THEN wj + 1 WHEN v AND x THEN wj + 3 ELSE nj END, i0, act AND NOT cut
  FROM (SELECT *, v AND NOT rej AND NOT x AS cut FROM (SELECT *, act AND j0 >= nj AND j0 <= re // 100 AS v, coalesce(len(list_filter(sp, lambda s: s.a <= rb AND s.e >= re)) > 0, false) AS x
   FROM (SELECT c.aread, c.k, rb, re, n, CASE WHEN vi THEN wi + 3 ELSE ni END AS ni, CASE WHEN vi THEN rb // 100 ELSE nj END AS nj, CASE WHEN c.i0 <> ci THEN vi ELSE act END AS act, i0, j0, wj, lo, hi, rej, sp
    FROM (SELECT c.*, s.rb, s.re, s.n, s.ni, s.nj, s.ci, s.act, c.i0 <> s.ci AND c.i0 >= s.ni AND c.i0 <= s.re // 100 AS vi FROM st s JOIN cd c ON c.aread = s.aread AND c.k = s.k + 1) c))))"""
WALLS_SQL = ENDS.format(o="walls", trim="trim") + "," + WALL_CHAINS + "," + WALL_ROWS + "," + WALL_FOLD.replace("{union}", union("iv", "rid"))


def pair_chains(o: DataFrame) -> DataFrame:
    """The overlaps of a pair on one strand as a chain, in their order."""
    w = Window.partitionBy("aread", "bread", "comp").orderBy("abpos", "ovl_id")
    return o.where("aread <> bread").withColumn("chain", F.col("comp")).withColumn("rank", F.row_number().over(w))


def chimeras(v: Fixtures) -> DataFrame:
    v = v.stored()
    return X.chimera_walls(v.walls, v.trim, v.iv, pair_chains(v.walls), border=4, anchor=200, min_chain=1000)


add("chimera_walls", chimeras, "rid tb te chimeras", "", WALLS_SQL + ";; SELECT s.aread AS rid, greatest(rb, tb) AS tb, least(re, te) AS te, n AS chimeras FROM st s JOIN trim t ON t.rid = s.aread WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY s.aread ORDER BY k DESC) = 1", "walls iv trim", recursive=True)

# Contig trims. Contigs are the reads of the overlaps; gaps and splits are made of every eleventh overlap and every seventh interval.
GAPS = """SELECT aread AS cid, CASE ovl_id % 3 WHEN 0 THEN alen ELSE CASE ovl_id % 2 WHEN 0 THEN alen ELSE 1 END END AS a_beg, CASE ovl_id % 2 WHEN 0 THEN 1 ELSE alen END AS a_end,
 bread AS other, CASE WHEN ovl_id % 5 < 3 THEN 1 ELSE 700 END AS b_beg, blen AS b_end, (ovl_id * 37) % 3000 - 2400 AS gap FROM {ovl} WHERE ovl_id % 11 = 0 AND aread <> bread"""
SPLITS = "SELECT rid AS cid, beg, end_ FROM {one} WHERE rid % 7 = 0"


def trims(v: Fixtures, option: int) -> DataFrame:
    contigs = v.lens.select(F.col("rid").alias("cid"), F.col("rlen").alias("len"))
    gaps = v.spark.sql(GAPS, ovl=v.ovl)
    splits = v.spark.sql(SPLITS, one=I.merge_intervals(v.iv.where("track = 'repeats'"), by=("rid",)))
    return T.trim_contigs(contigs, option, splits, gaps, v.ovl, v.trace).withColumn("option", F.lit(option))


def all_trims(v: Fixtures) -> DataFrame:
    v = v.stored()
    out = trims(v, 0)
    for option in (1, 2, 3):
        out = out.unionByName(trims(v, option))
    return out


CUTS = """ gp AS ({gaps}), gw AS (SELECT * FROM gp UNION ALL SELECT other, b_end, b_beg, cid, a_end, a_beg, gap FROM gp),
 ge AS (SELECT g.cid, other, CASE WHEN a_end = 1 THEN 'begin' WHEN a_end = rlen THEN 'end' END AS side, CASE WHEN a_end = 1 THEN 1 + abs(gap) // 2 + 100 ELSE rlen - (1 + abs(gap) // 2 + 100) END AS pos,
  least(a_beg, a_end) AS fr, greatest(a_beg, a_end) AS tt, b_beg = 1 OR a_beg = rlen AS uns FROM gw g JOIN lens l ON l.rid = g.cid WHERE gap < 0),
 co AS (SELECT o.*, lag(aepos) OVER w AS pa, lag(bepos) OVER w AS pb, lag(comp) OVER w AS pc FROM ovl o WHERE aread <> bread WINDOW w AS (PARTITION BY aread, bread ORDER BY abpos, aepos, ovl_id)),
 cg AS (SELECT aread, bread, any_value(alen) AS alen, any_value(blen) AS blen, count(*) AS n, count(*) FILTER (pa IS NOT NULL AND (abs(pa - abpos) > 1500 OR pc <> comp)) AS bad,
  arg_min({'o': ovl_id, 'ab': abpos, 'ae': aepos, 'bb': bbpos, 'be': bepos, 'c': comp}, (abpos, aepos, ovl_id)) AS f, arg_max({'ab': abpos, 'ae': aepos, 'bb': bbpos, 'be': bepos}, (abpos, aepos, ovl_id)) AS l,
  avg(200.0::DOUBLE * diffs / ((aepos - abpos) + (bepos - bbpos))) AS div, sum(greatest(coalesce(abpos - pa, 0), 0)) AS ga, sum(greatest(coalesce(bbpos - pb, 0), 0)) AS gb FROM co GROUP BY ALL),
 ck AS (SELECT *, alen - l.ae AS ta, blen - l.be AS tb FROM cg),
 cl AS (SELECT *, ga + least(f.ab, ta) AS ua, gb + least(f.bb, tb) AS ub, (f.ab <= alen // 2 AND ta <= alen // 2) OR (f.bb <= blen // 2 AND tb <= blen // 2) AS half FROM ck),
 cv AS (SELECT * FROM cl WHERE f.ab <> ta AND f.bb <> tb AND CASE WHEN n = 1 THEN NOT ((f.ab > 1500 AND ta > 1500) OR (f.bb > 1500 AND tb > 1500)) AND NOT half
  ELSE bad = 0 AND (NOT half OR (div < 2 AND ua < 1500 AND ub < 1500 AND (f.ab >= alen // 3 OR ta >= alen // 3) AND (f.bb >= blen // 3 OR tb >= blen // 3))) END),
 cm AS (SELECT *, f.ab + (f.ae - f.ab) // 2 AS pt FROM cv), cn AS (SELECT *, (pt + 50) // 100 * 100 AS nr FROM cm),
 cp AS (SELECT *, CASE WHEN nr <= f.ab OR pt - f.ab < abs(pt - nr) THEN f.ab ELSE nr END AS xa,
  CASE WHEN nr <= f.ab OR pt - f.ab < abs(pt - nr) THEN f.bb ELSE f.bb + (SELECT sum(blen) FROM trace t WHERE t.ovl_id = f.o AND t.tile < nr // 100) END AS xb FROM cn),
 cq AS (SELECT *, f.ab < ta AS ba, f.bb < tb AS b2 FROM cp WHERE n > 1 OR (xa <= f.ae AND xb <= f.be)),
 cr AS (SELECT *, CASE WHEN ba THEN CASE WHEN n = 1 THEN xa ELSE greatest(f.ae, l.ab) END + 100 ELSE CASE WHEN n = 1 THEN xa ELSE least(f.ae, l.ab) END - 100 END AS qa,
  CASE WHEN b2 THEN CASE WHEN n = 1 THEN xb ELSE greatest(f.be, l.bb) END + 100 ELSE CASE WHEN n = 1 THEN xb ELSE least(f.be, l.bb) END - 100 END AS qb FROM cq),
 cs AS (SELECT aread, bread, aread AS cid, bread AS other, CASE WHEN ba THEN 'begin' ELSE 'end' END AS side, qa AS pos FROM cr UNION ALL
  SELECT aread, bread, bread, aread, CASE WHEN b2 <> (f.c = 1) THEN 'begin' ELSE 'end' END, CASE WHEN f.c = 1 THEN blen - qb ELSE qb END FROM cr),
 ce AS (SELECT * FROM cs QUALIFY row_number() OVER (PARTITION BY cid, other, side ORDER BY aread, bread) = 1),
 mr AS ({union}), sp AS (SELECT rid AS cid, beg, end_ FROM mr WHERE rid % 7 = 0),
 pt AS (SELECT rid AS cid, rlen AS len, o AS option, beg, end_ FROM (SELECT unnest([0, 2]) AS o), lens JOIN sp ON sp.cid = rid UNION ALL
  SELECT rid, rlen, o, 0, rlen FROM (SELECT unnest([0, 1, 2, 3]) AS o), lens WHERE o IN (1, 3) OR rid NOT IN (SELECT cid FROM sp)),
 ev AS (SELECT 1 AS option, cid, other, side, pos, 'gap' AS why, 0 AS fr, 2147483647 AS tt FROM ge WHERE side IS NOT NULL UNION ALL SELECT 2, cid, other, side, pos, 'gap', fr, tt FROM ge WHERE side IS NOT NULL AND uns
  UNION ALL SELECT 3, cid, other, side, pos, 'chain', 0, 2147483647 FROM ce),
 bs AS (SELECT p.option, p.cid, p.beg, p.end_, max(CASE WHEN side = 'begin' THEN (pos, -other, why) END) AS lo, min(CASE WHEN side = 'end' THEN (pos, other, why) END) AS hi
  FROM pt p JOIN ev ON ev.option = p.option AND ev.cid = p.cid AND p.beg < tt AND fr < p.end_ GROUP BY ALL),
 ba AS (SELECT p.*, lo, hi, CASE WHEN lo[1] > p.beg THEN lo[1] ELSE p.beg END AS a, CASE WHEN hi[1] < p.end_ THEN hi[1] ELSE p.end_ END AS z FROM pt p LEFT JOIN bs ON bs.option = p.option AND bs.cid = p.cid AND bs.beg = p.beg AND bs.end_ = p.end_),
 bb AS (SELECT *, CASE WHEN a >= z THEN end_ ELSE a END AS kl, CASE WHEN a >= z THEN end_ ELSE z END AS kh FROM ba),
 hl AS (SELECT *, coalesce(max(end_) OVER (PARTITION BY option, cid ORDER BY beg, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pe, lead(beg) OVER (PARTITION BY option, cid ORDER BY beg, end_) AS nb FROM pt);;
 SELECT option, cid, 'kept' AS kind, kl AS beg, kh AS end_, NULL AS reason, NULL AS other FROM bb WHERE kl < kh UNION ALL
 SELECT option, cid, 'removed', beg, kl, CASE WHEN a > beg THEN lo[3] ELSE hi[3] END, CASE WHEN a > beg THEN -lo[2] ELSE hi[2] END FROM bb WHERE beg < kl UNION ALL
 SELECT option, cid, 'removed', kh, end_, hi[3], hi[2] FROM bb WHERE kh < end_ UNION ALL
 SELECT option, cid, 'removed', pe, beg, 'split', NULL FROM hl WHERE pe < beg UNION ALL SELECT option, cid, 'removed', end_, len, 'split', NULL FROM hl WHERE nb IS NULL AND end_ < len"""
REPEATS_ONLY = " rep AS (SELECT * FROM iv WHERE track = 'repeats'),"
add("trim_contigs", all_trims, "option cid beg end_ other", "kind reason", REPEATS_ONLY + CUTS.replace("{gaps}", GAPS.replace("{ovl}", "ovl")).replace("{union}", union("rep", "rid")), "ovl trace iv lens")

# Repeat modules
MODULES = """ os AS (SELECT aread, tb, te, CASE WHEN count(*) FILTER (flags & 2 = 0 AND abpos = tb) = 0 THEN 'l' ELSE 'r' END AS op FROM exits x JOIN trim t ON t.rid = aread WHERE tb < te GROUP BY aread, tb, te
  HAVING count(*) FILTER (abpos = tb AND aepos = te) = 0 AND (count(*) FILTER (flags & 2 = 0 AND abpos = tb) > 0) <> (count(*) FILTER (flags & 2 = 0 AND aepos = te) > 0)),
 mu AS ({union}), mc AS (SELECT aread, greatest(beg, tb) AS beg, least(end_, te) AS end_ FROM mu JOIN os ON aread = rid WHERE greatest(beg, tb) < least(end_, te)),
 mn AS (SELECT *, CASE WHEN beg - lag(end_) OVER w < 900 AND end_ - beg > 100 THEN 0 ELSE 1 END AS nw FROM mc WINDOW w AS (PARTITION BY aread ORDER BY beg, end_)),
 mr AS (SELECT aread, min(beg) AS beg, max(end_) AS end_ FROM (SELECT *, sum(nw) OVER (PARTITION BY aread ORDER BY beg, end_ ROWS UNBOUNDED PRECEDING) AS g FROM mn) GROUP BY aread, g),
 pl AS (SELECT * FROM os WHERE aread IN (SELECT aread FROM mr)),
 rb AS (SELECT aread, beg, stop, unnest(range(first, stop)) AS bin FROM (SELECT r.aread, beg, CAST(greatest(tb + 1000, beg + 500) // 100 AS BIGINT) AS first, CAST(least(te - 1000, end_ - 500) // 100 AS BIGINT) AS stop FROM mr r JOIN pl ON pl.aread = r.aread
  WHERE NOT EXISTS (SELECT 1 FROM exits x WHERE x.aread = r.aread AND flags & 2 = 0 AND abpos + 500 <= beg AND aepos - 500 >= end_))),
 cb AS (SELECT aread, bin, sum(n) AS n FROM (SELECT aread, CASE WHEN flags & 16 > 0 THEN 9 ELSE 1 END AS n, unnest(range(CAST((abpos + 500) // 100 AS BIGINT), CAST((aepos - 500) // 100 AS BIGINT))) AS bin FROM exits WHERE flags & 131200 = 0) GROUP BY ALL),
 ln AS (SELECT rb.aread, beg, stop, rb.bin, rb.bin - row_number() OVER (PARTITION BY rb.aread, beg ORDER BY rb.bin) AS g FROM rb JOIN cb ON cb.aread = rb.aread AND cb.bin = rb.bin WHERE n < 9),
 ju AS (SELECT aread, (min(bin) + max(bin) + 1) // 2 * 100 - 50 AS jb FROM ln GROUP BY aread, beg, stop, g HAVING count(*) > 7 AND max(bin) + 1 < stop),
 jx AS (SELECT aread, jb FROM (SELECT DISTINCT * FROM ju) j WHERE (SELECT count(*) FROM exits x WHERE x.aread = j.aread AND abpos + 100 < jb AND aepos - 100 > jb + 100 AND (flags & 2 = 0 OR (flags & 8 > 0 AND flags & 229552 = 0))) BETWEEN 4 AND 9),
 m1 AS (SELECT DISTINCT x.aread, ovl_id FROM exits x JOIN jx ON jx.aread = x.aread JOIN pl ON pl.aread = x.aread WHERE flags & 8 > 0 AND flags & 229552 = 0 AND NOT (abpos > tb AND aepos < te) AND abpos + 500 < jb AND aepos - 500 > jb + 100),
 oe AS (SELECT x.*, tb, te, op FROM exits x JOIN pl ON pl.aread = x.aread WHERE flags & 229552 = 0 AND CASE op WHEN 'l' THEN abpos = tb ELSE aepos = te END),
 br AS (SELECT mu.rid, greatest(beg, tb) AS beg, least(end_, te) AS end_, te - tb AS tl FROM mu JOIN trim t ON t.rid = mu.rid WHERE tb < te AND greatest(beg, tb) < least(end_, te)),
 bu AS (SELECT rid, any_value(tl) - sum(end_ - beg) AS u FROM br GROUP BY rid),
 bp AS (SELECT aread, ovl_id, bread, flags, (op = 'l') <> (comp = 1) AS lf, CASE WHEN (op = 'l') <> (comp = 1) THEN CASE comp WHEN 1 THEN blen - bepos ELSE bbpos END ELSE CASE comp WHEN 1 THEN blen - bbpos ELSE bepos END END AS p FROM oe WHERE aread NOT IN (SELECT aread FROM m1)),
 lo AS (SELECT aread, ovl_id, CASE WHEN lf THEN p - beg ELSE end_ - p END // 1000 AS bin FROM bp JOIN br ON br.rid = bread AND beg < p AND p < end_ JOIN bu ON bu.rid = bread WHERE u >= 300 AND flags & ~11 = 0),
 m2 AS (SELECT aread, ovl_id FROM lo QUALIFY count(*) OVER (PARTITION BY aread, bin) BETWEEN 3 AND 8),
 le AS (SELECT aread, ovl_id, count(*) OVER (PARTITION BY aread) AS n FROM (SELECT * FROM oe WHERE aread NOT IN (SELECT aread FROM m1) AND aread NOT IN (SELECT aread FROM m2)
  QUALIFY row_number() OVER (PARTITION BY aread, bread ORDER BY aepos - abpos DESC, comp, abpos, aepos, bbpos, bepos, ovl_id) = 1)),
 rs AS (SELECT ovl_id, 262144 AS f FROM m1 UNION ALL SELECT ovl_id, 524288 FROM m2 UNION ALL SELECT ovl_id, 524288 FROM le WHERE n + 1 < 9)"""
def rescued(v: Fixtures) -> DataFrame:
    v = v.stored()
    return R.rescue_modules(v.exits, v.iv, v.trim, 9, 3, 900, 300)


add("rescue_modules", rescued, "ovl_id flags", "", MODULES.replace("{union}", union("iv", "rid")) + ";; SELECT x.ovl_id, CASE WHEN f IS NULL THEN flags ELSE (flags & ~2) | f END AS flags FROM exits x LEFT JOIN rs ON rs.ovl_id = x.ovl_id", "exits iv")

# Chains of local pieces
PIECE_CHAINS = """ us AS (SELECT * FROM pieces WHERE aread <> bread), un AS ({union}),
 ur AS (SELECT ovl_id, sum(least(aepos, end_) - greatest(abpos, beg)) AS r FROM us JOIN un ON rid = aread AND least(aepos, end_) > greatest(abpos, beg) GROUP BY ovl_id),
 fl AS (SELECT aread, bread, list({'c': comp, 'ab': abpos, 'ae': aepos, 'bb': bbpos, 'be': bepos, 'o': us.ovl_id, 'u': aepos - abpos - coalesce(r, 0)}) AS free FROM us LEFT JOIN ur ON ur.ovl_id = us.ovl_id GROUP BY ALL),
 rc AS (SELECT aread, bread, free, 0 AS ph, free[1] AS lf, free[1] AS rt, -1 AS ch, 0 AS rl, 0 AS rr, CAST(NULL AS BIGINT) AS o, 0 AS rk FROM fl UNION ALL
  SELECT aread, bread, CASE WHEN x IS NULL THEN free ELSE list_filter(free, lambda r: r.o <> x.o) END, CASE WHEN ph = 0 THEN 1 WHEN x IS NOT NULL THEN ph ELSE (ph + 1) % 3 END,
   CASE WHEN ph <> 1 AND x IS NOT NULL THEN x ELSE lf END, CASE WHEN ph <> 2 AND x IS NOT NULL THEN x ELSE rt END, CASE WHEN ph = 0 THEN ch + 1 ELSE ch END,
   CASE WHEN ph = 0 THEN 0 WHEN ph = 2 AND x IS NOT NULL THEN rl + 1 ELSE rl END, CASE WHEN ph = 0 THEN 0 WHEN ph = 1 AND x IS NOT NULL THEN rr + 1 ELSE rr END, x.o, CASE ph WHEN 0 THEN 0 WHEN 1 THEN rr + 1 ELSE -rl - 1 END
  FROM (SELECT *, CASE ph WHEN 0 THEN list_sort(list_transform(free, lambda r: {'k1': -r.u, 'k2': r.ab - r.ae, 'k3': r.o, 'r': r}))[1].r
   WHEN 1 THEN list_sort(list_transform(list_filter(free, lambda r: r.c = rt.c AND rt.ab < r.ab AND rt.ae < r.ae AND rt.bb < r.bb AND rt.be < r.be AND 2 * (r.ae - greatest(r.ab, rt.ae)) >= r.ae - r.ab AND greatest(r.ab - rt.ae, r.bb - rt.be, 0) <= 30000),
     lambda r: {'k1': (greatest(r.ab - rt.ae, r.bb - rt.be, 0) + 1999) // 2000, 'k2': r.ab - r.ae, 'k3': r.o, 'r': r}))[1].r
   ELSE list_sort(list_transform(list_filter(free, lambda r: r.c = lf.c AND r.ab < lf.ab AND r.ae < lf.ae AND r.bb < lf.bb AND r.be < lf.be AND 2 * (least(r.ae, lf.ab) - r.ab) >= r.ae - r.ab AND greatest(lf.ab - r.ae, lf.bb - r.be, 0) <= 30000),
     lambda r: {'k1': (greatest(lf.ab - r.ae, lf.bb - r.be, 0) + 1999) // 2000, 'k2': r.ab - r.ae, 'k3': r.o, 'r': r}))[1].r END AS x FROM rc WHERE len(free) > 0)),
 rn AS (SELECT o AS ovl_id, ch AS chain, rk - min(rk) OVER (PARTITION BY aread, bread, ch) AS rank FROM rc WHERE o IS NOT NULL),
 ch AS (SELECT us.*, chain, rank, greatest(coalesce(lag(aepos) OVER w - abpos, 0), 0) AS ia, greatest(coalesce(abpos - lag(aepos) OVER w, 0), 0) AS ga,
  greatest(coalesce(lag(bepos) OVER w - bbpos, 0), 0) AS ib, greatest(coalesce(bbpos - lag(bepos) OVER w, 0), 0) AS gb FROM us JOIN rn ON rn.ovl_id = us.ovl_id WINDOW w AS (PARTITION BY aread, bread, chain ORDER BY rank))"""
CHAINED = PIECE_CHAINS.replace("{union}", union("iv", "rid"))
JUDGED = """, dm AS ({union}), gx AS (SELECT ovl_id, 'a' AS s, aread AS rid, abpos - ga AS b, abpos AS e FROM ch WHERE ga > 60 UNION ALL SELECT ovl_id, 'b', bread, CASE WHEN comp = 1 THEN blen - bbpos ELSE bbpos - gb END, CASE WHEN comp = 1 THEN blen - bbpos + gb ELSE bbpos END FROM ch WHERE gb > 60),
 gd AS (SELECT ovl_id, s FROM gx JOIN dm ON dm.rid = gx.rid AND least(e, end_) > greatest(b, beg) GROUP BY ovl_id, s, b, e HAVING 100 * sum(least(e, end_) - greatest(b, beg)) >= 80 * (e - b)),
 bg AS (SELECT gx.ovl_id, count(*) AS n FROM gx LEFT JOIN gd ON gd.ovl_id = gx.ovl_id AND gd.s = gx.s WHERE gd.ovl_id IS NULL GROUP BY gx.ovl_id),
 js AS (SELECT ch.aread, ch.bread, chain, count(*) AS n, min(ch.abpos) AS ab, max(ch.aepos) AS ae, min(ch.bbpos) AS bb, max(ch.bepos) AS be, any_value(ch.comp) AS c, sum(ch.diffs) AS d, sum(ch.aepos - ch.abpos) AS sa, sum(ch.bepos - ch.bbpos) AS sb,
  sum(ch.aepos - ch.abpos - ia) AS ca, sum(ch.bepos - ch.bbpos - ib) AS cb, any_value(ch.alen) AS al, any_value(ch.blen) AS bl, any_value(atb) AS atb, any_value(ate) AS ate, any_value(btb) AS btb, any_value(bte) AS bte,
  coalesce(sum(bg.n), 0) AS bad_gaps, max(CASE WHEN flags & 131080 = 0 THEN 1 ELSE 0 END) AS an, list({'a': ch.abpos, 'e': ch.aepos, 'b': ch.bbpos, 'f': ch.bepos}) AS ps
  FROM ch JOIN (SELECT ovl_id, atb, ate, btb, bte FROM e) z ON z.ovl_id = ch.ovl_id LEFT JOIN bg ON bg.ovl_id = ch.ovl_id GROUP BY ALL),
 jj AS (SELECT *, (ab <= atb + 60 OR bb <= btb + 60) AND (ae + 60 >= ate OR be + 60 >= bte) AS proper, 100 * greatest(ca, cb) >= 20 * least(al, bl) AS enough, 100.0::DOUBLE * d <= 20 * least(sa, sb) AS alike, least(ca, cb) > 500 AS lng,
  max(an) OVER (PARTITION BY aread, bread) AS anchored, row_number() OVER (PARTITION BY aread, bread ORDER BY sa DESC, chain) AS k FROM js),
 jr AS (SELECT aread, bread, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(c BIGINT, ab BIGINT, ae BIGINT, bb BIGINT, be BIGINT)[]) AS kept, CAST(0 AS BIGINT) AS chain, 0 AS nested, 0 AS valid FROM (SELECT DISTINCT aread, bread FROM jj) UNION ALL
  SELECT aread, bread, k, CASE WHEN valid = 1 THEN list_append(kept, me) ELSE kept END, chain, nested, valid FROM (SELECT *, CASE WHEN ok AND nested = 0 THEN 1 ELSE 0 END AS valid FROM (
   SELECT j.aread, j.bread, j.k, kept, j.chain, CAST({'c': j.c, 'ab': j.ab, 'ae': j.ae, 'bb': j.bb, 'be': j.be} AS STRUCT(c BIGINT, ab BIGINT, ae BIGINT, bb BIGINT, be BIGINT)) AS me, proper AND enough AND alike AND lng AND bad_gaps = 0 AND anchored = 1 AS ok,
   CASE WHEN len(list_filter(kept, lambda y: least(j.ae, y.ae) - greatest(j.ab, y.ab) > 60 OR least(j.be, y.be) - greatest(j.bb, y.bb) > 60 OR (j.c = y.c AND len(list_filter(j.ps, lambda p: (p.a >= y.ab AND p.e <= y.ae) OR (p.b >= y.bb AND p.f <= y.be))) > 0))) > 0 THEN 1 ELSE 0 END AS nested
   FROM jr r JOIN jj j ON j.aread = r.aread AND j.bread = r.bread AND j.k = r.k + 1)))"""
CHAIN_ENDS = ENDS.format(o="pieces", trim="trim")


def piece_chains(v: Fixtures) -> DataFrame:
    return C.chain_overlaps(v.pieces, v.iv)


def judged(v: Fixtures) -> DataFrame:
    return C.judge_chains(settled(piece_chains(v)), v.trim, v.iv.where("track = 'dust'"), fuzz=60, cover=20, min_len=500)


add("chain_pieces", piece_chains, "ovl_id chain rank", "", CHAINED + ";; SELECT ovl_id, chain, rank FROM rn", "pieces iv", recursive=True)
add("judge_chains", judged, "aread bread chain anchored n cover_a cover_b bad_gaps proper enough alike long_ nested valid", "", " dust AS (SELECT * FROM iv WHERE track = 'dust')," + CHAIN_ENDS + "," + CHAINED + JUDGED.replace("{union}", union("dust", "rid")) + """;;
 SELECT j.aread, j.bread, j.chain, anchored, n, ca AS cover_a, cb AS cover_b, bad_gaps, proper, enough, alike, lng AS long_, nested, valid FROM jj j JOIN jr r ON r.aread = j.aread AND r.bread = j.bread AND r.k = j.k""", "pieces iv trim", recursive=True)  # fmt: skip
SEPARATED = """, ss AS (SELECT aread, bread, chain, count(*) AS n, sum(aepos - abpos) AS sa, least(min(abpos), min(bbpos)) < 1000 AND (max(aepos) + 1000 > any_value(alen) OR max(bepos) + 1000 > any_value(blen)) AND max(greatest(ia, ib)) <= 1000
  AND 3 * sum(greatest(aepos - abpos, bepos - bbpos) - greatest(ia, ib)) > 10 * greatest(sum(ga), sum(gb)) AS w FROM ch GROUP BY ALL),
 sb AS (SELECT aread, bread, count(*) AS k, arg_max({'w': w, 'n': n}, (sa, -chain)) AS b FROM ss GROUP BY ALL)"""
for kind, rule in ((0, "NOT b.w"), (1, "b.w AND k = 1 AND b.n > 1")):
    add(f"separate_pairs_{kind}", lambda v, kind=kind: C.separate_pairs(piece_chains(v), kind), "ovl_id", "", CHAINED + SEPARATED + f";; SELECT ovl_id FROM us JOIN sb ON sb.aread = us.aread AND sb.bread = us.bread WHERE {rule}", "pieces iv", recursive=True)

# Contigs of ten reads each, and the reads that overlap them
CONTIG_READS = " cr AS (SELECT aread // 10 AS cid, bread AS rid, min((aread % 10) * 3000 + abpos) AS beg, max((aread % 10) * 3000 + aepos) AS end_ FROM ovl GROUP BY ALL), cl AS (SELECT DISTINCT cid, 33000 + cid % 7 * 1000 AS len FROM cr)"


def contig_reads(v: Fixtures) -> tuple[DataFrame, DataFrame, DataFrame]:
    cid, at = F.floor(F.col("aread") / 10), F.col("aread") % 10 * 3000
    cr = settled(v.ovl.select(cid.alias("cid"), F.col("bread").alias("rid"), (at + F.col("abpos")).alias("beg"), (at + F.col("aepos")).alias("end_")))
    contigs = cr.select("cid", (33000 + F.col("cid") % 7 * 1000).alias("len")).distinct()
    return cr, contigs, V.shared_ranges(cr, contigs)


SHARED = CONTIG_READS + """, rs AS (SELECT a.rid, a.cid AS c1, b.cid AS c2, a.beg AS b1, a.end_ AS e1, b.beg AS b2, b.end_ AS e2 FROM (SELECT * FROM cr JOIN cl USING (cid)) a JOIN (SELECT * FROM cr JOIN cl USING (cid)) b ON a.rid = b.rid AND (a.len > b.len OR (a.len = b.len AND a.cid < b.cid))),
 sp AS (SELECT c1, c2, count(*) AS shared, any_value(n2) AS n2 FROM rs JOIN (SELECT cid, count(*) AS n2 FROM cr GROUP BY cid) z ON z.cid = c2 GROUP BY ALL HAVING 100 * count(*) > any_value(n2)),
 bn AS (SELECT c1, c2, cid, bin, count(*) AS n FROM (SELECT c1, c2, c1 AS cid, unnest(range(CAST(b1 // 100 AS BIGINT), CAST(e1 // 100 + 1 AS BIGINT))) AS bin FROM rs UNION ALL SELECT c1, c2, c2, unnest(range(CAST(b2 // 100 AS BIGINT), CAST(e2 // 100 + 1 AS BIGINT))) FROM rs) JOIN sp USING (c1, c2) GROUP BY ALL),
 bk AS (SELECT c1, c2, cid, min(bin) * 100 AS beg, max(bin) * 100 + 99 AS end_, sum(n) // count(*) AS depth FROM (SELECT *, bin - row_number() OVER (PARTITION BY c1, c2, cid ORDER BY bin) AS g FROM bn) GROUP BY c1, c2, cid, g)"""
add("shared_blocks", lambda v: V.shared_blocks(contig_reads(v)[2]), "c1 c2 cid beg end_ depth", "", SHARED + ";; SELECT * FROM bk", "ovl")


def alternatives(v: Fixtures) -> DataFrame:
    _, contigs, ranges = contig_reads(v)
    return V.read_alternatives(V.shared_blocks(ranges), contigs).withColumn("alternative", F.col("alternative").cast("int"))


add("read_alternatives", alternatives, "c1 c2 shared n2 covered alternative", "", SHARED + """;; SELECT c1, c2, shared, n2, covered, CASE WHEN 100 * shared > 50 * n2 OR 100 * covered >= 50 * len THEN 1 ELSE 0 END AS alternative
 FROM sp JOIN (SELECT c1, c2, sum(end_ - beg) AS covered FROM bk WHERE cid = c2 GROUP BY ALL) USING (c1, c2) JOIN cl ON cl.cid = c2""", "ovl")  # fmt: skip

# Consensus by columns
CONSENSUS = PILE + LR + """, vt AS (SELECT aread, tile, substr(CASE WHEN comp = 1 THEN reverse(translate(seq, 'acgt', 'tgca')) ELSE seq END, CAST(sb + 1 AS BIGINT), CAST(eb - sb AS BIGINT)) AS piece, 0 AS own FROM tp JOIN lr ON lr.rid = bread WHERE sb < eb
  UNION ALL SELECT DISTINCT aread, tile, substr(seq, tile * 100 + 1, 100), 1 FROM tp JOIN lr ON lr.rid = aread),
 sz AS (SELECT aread, tile, length(piece) AS n, count(*) AS used, max(own) AS o FROM vt WHERE piece <> '' GROUP BY aread, tile, length(piece) QUALIFY row_number() OVER (PARTITION BY aread, tile ORDER BY used DESC, o DESC, n) = 1),
 lt AS (SELECT aread, tile, used, own, pos, substr(piece, pos, 1) AS letter FROM (SELECT vt.*, used, unnest(range(1, n + 1)) AS pos FROM vt JOIN sz ON sz.aread = vt.aread AND sz.tile = vt.tile AND n = length(piece))),
 bl AS (SELECT aread, tile, used, pos, letter FROM (SELECT aread, tile, used, pos, letter, count(*) AS k, max(own) AS own FROM lt GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY aread, tile, pos ORDER BY k DESC, own DESC, letter) = 1)"""


def consensus(v: Fixtures) -> DataFrame:
    return P.column_consensus(P.tile_pile(v.ovl, v.piles), long_reads(v))


add("column_consensus", consensus, "aread tile used", "seq", CONSENSUS + ";; SELECT aread, tile, used, string_agg(letter, '' ORDER BY pos) AS seq FROM bl GROUP BY ALL", "ovl trace reads")

# Paths beside others, and paths joined over every fifth edge
def path_edges(v: Fixtures) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All edges, those that count as optional, and the paths over the rest."""
    e = settled(edges(v.stored()))
    some = (F.col("src") + F.col("dst")) % 5 == 0
    firm = settled(e.where(~some))
    return e, e.where(some), settled(W.build_paths(firm, W.best_next(firm, 6, 100)))


def path_rows(build: Callable[[Fixtures], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Fixtures(spark, sf_dir))


def suppressed(v: Fixtures) -> DataFrame:
    e, _, paths = path_edges(v)
    return W.suppress_paths(paths, e)


def joined(v: Fixtures) -> DataFrame:
    _, optional, paths = path_edges(v)
    return W.join_paths(paths, optional)


REGISTRY.add("suppress_paths", path_rows(suppressed))
REGISTRY.add("join_paths", path_rows(joined))

# Anchors: unique stretches that no low-complexity breaks
ANCHORS = UNIQUE.format("trim") + """, uq AS (SELECT rid, ubeg AS beg, uend AS end_ FROM u0 WHERE uend - ubeg > 10), dl AS ({union}),
 lk AS (SELECT uq.rid, beg, end_, o, CASE WHEN o < 0 THEN greatest(beg + o, 0) WHEN o > 0 THEN end_ ELSE beg END AS lb, CASE WHEN o < 0 THEN beg WHEN o > 0 THEN least(end_ + o, rlen) ELSE end_ END AS le
  FROM uq JOIN lens l ON l.rid = uq.rid, (SELECT unnest([0, -100, 100, -200, 200, -250, 250]) AS o) WHERE end_ - beg <= 600),
 lh AS (SELECT lk.rid, lk.beg, lk.end_, o, sum(least(le, dl.end_) - greatest(lb, dl.beg)) AS bp, max(least(le, dl.end_) - greatest(lb, dl.beg)) AS m FROM lk JOIN dl ON dl.rid = lk.rid AND least(le, dl.end_) > greatest(lb, dl.beg) GROUP BY ALL),
 lx AS (SELECT DISTINCT rid, beg, end_ FROM lh WHERE CASE WHEN o = 0 THEN 2 * bp > end_ - beg OR (100 * bp > 15 * (end_ - beg) AND m > 100) OR (end_ - beg < 100 AND m > 20) WHEN o < 0 THEN m > 30 AND 100 * bp > -20 * o ELSE m > 30 AND 100 * bp // o > 20 END),
 lk2 AS (SELECT uq.* FROM uq ANTI JOIN lx USING (rid, beg, end_)),
 lm AS (SELECT k.rid, k.beg, k.end_, greatest(k.beg, d.beg) AS b, least(k.end_, d.end_) AS e FROM lk2 k JOIN dl d ON d.rid = k.rid AND least(k.end_, d.end_) > greatest(k.beg, d.beg) UNION ALL SELECT rid, beg, end_, end_, end_ FROM lk2),
 ln AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY rid, beg, end_ ORDER BY b, e), beg) AS f FROM lm)"""
add("anchors", lambda v: I.anchors(v.iv.where("track = 'repeats'"), v.lens, v.trim, v.iv.where("track = 'dust'"), 600, 250), "rid beg end_", "", " rep AS (SELECT * FROM iv WHERE track = 'repeats'), dust AS (SELECT * FROM iv WHERE track = 'dust'),"
    + ANCHORS.replace(union("iv", "rid"), union("rep", "rid")).replace("{union}", union("dust", "rid")) + ";; SELECT rid, f AS beg, b AS end_ FROM ln WHERE f < b", "iv trim")

# The error model of k-mers
MODEL = "places AS (SELECT 1.5::DOUBLE * 1e6 * 20 * 0.5 AS p), ns AS (SELECT CAST(floor(greatest(1.0, 1.5 * 1e6 * 0.5 / pow(4, 14)) * 20 * (pow(0.85, 15) + (pow(0.85, 13) - pow(0.85, 27)) / 14)) AS BIGINT) AS noise)"
add("kmer_model", lambda v: V.kmer_model(K.kmer_histogram(v.reads, 14), 14, 15.0, 20, 1.5, 500).select("over", "noise", *(F.round(c, 9).alias(c) for c in ("over_expected", "noise_expected", "over_load", "noise_load"))), "over noise", "over_expected noise_expected over_load noise_load",
    KH + ", " + MODEL + """, hb AS (SELECT *, coalesce(sum(kmers) OVER (ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bf, sum(kmers) OVER () AS al FROM hs);;
 SELECT over, noise, round(a / p, 9) AS over_expected, round(b / p, 9) AS noise_expected, round(a / p * 487, 9) AS over_load, round(b / p * 487, 9) AS noise_load
 FROM (SELECT min(CASE WHEN 100 * bf < al THEN n END) - 1 AS over, sum(CASE WHEN 100 * bf < al THEN n * kmers ELSE 0 END)::DOUBLE AS a, sum(CASE WHEN n <= noise THEN n * kmers ELSE 0 END)::DOUBLE AS b, any_value(noise) AS noise FROM hb, ns), places""", "reads")  # fmt: skip

# Groups of overlap ends
REGISTRY.add("cluster_borders", path_rows(lambda v: V.cluster_borders(v.stored().ovl.select(F.col("aread").alias("rid"), F.col("aepos").alias("pos")), 0.02, 3, 400)))

# Classes of contigs: each read of the overlaps stands for a contig
TOURS = "SELECT rid AS cid, CASE WHEN rid % 5 = 0 THEN (rid * 7) % 50 + 1 ELSE -1 END AS end1, CASE WHEN rid % 10 = 0 THEN (rid * 7) % 50 + 1 WHEN rid % 7 = 0 THEN (rid * 3) % 50 + 1 ELSE -1 END AS end2 FROM {lens}"


def related(v: Fixtures) -> DataFrame:
    contigs = v.lens.select(F.col("rid").alias("cid"), F.col("rlen").alias("len"))
    cr = v.ovl.where("aread % 4 = 0").select(F.col("aread").alias("cid"), F.col("bread").alias("rid"), F.col("abpos").alias("beg"), F.col("aepos").alias("end_"))
    ranges = V.shared_ranges(settled(cr), contigs, 10)
    shared = V.read_alternatives(V.shared_blocks(ranges), contigs)
    chained = C.contig_relations(pair_chains(v.ovl.where("diffs % 3 = 0")), 200)
    return settled(Y.all_relations(chained, shared, v.spark.sql(TOURS, lens=v.lens)))


def classified(v: Fixtures, resolve: bool) -> DataFrame:
    v = v.stored()
    n = v.ovl.groupBy(F.col("aread").alias("cid")).agg(F.count_distinct("bread").alias("reads"))
    contigs = v.lens.select(F.col("rid").alias("cid"), F.col("rlen").alias("len"))
    rep = V.repeat_bases(contigs, v.iv).select("cid", F.col("bp").alias("rep"))
    return Y.contig_classes(contigs.join(n, "cid", "left").join(rep, "cid").fillna(0, ["reads"]), related(v), 6000, 27, 45, resolve)


RELATED = """ cr AS (SELECT aread AS cid, bread AS rid, min(abpos) AS beg, max(aepos) AS end_ FROM ovl WHERE aread % 4 = 0 GROUP BY ALL), cl AS (SELECT rid AS cid, rlen AS len FROM lens),
 rs AS (SELECT a.rid, a.cid AS c1, b.cid AS c2, b.beg AS b2, b.end_ AS e2 FROM (SELECT * FROM cr JOIN cl USING (cid)) a JOIN (SELECT * FROM cr JOIN cl USING (cid)) b ON a.rid = b.rid AND (a.len > b.len OR (a.len = b.len AND a.cid < b.cid))),
 sp AS (SELECT c1, c2, count(*) AS shared, any_value(n2) AS n2 FROM rs JOIN (SELECT cid, count(*) AS n2 FROM cr GROUP BY cid) z ON z.cid = c2 GROUP BY ALL HAVING 100 * count(*) > 10 * any_value(n2)),
 bn AS (SELECT DISTINCT c1, c2, unnest(range(CAST(b2 // 100 AS BIGINT), CAST(e2 // 100 + 1 AS BIGINT))) AS bin FROM rs JOIN sp USING (c1, c2)),
 bk AS (SELECT c1, c2, max(bin) * 100 + 99 - min(bin) * 100 AS cov FROM (SELECT *, bin - row_number() OVER (PARTITION BY c1, c2 ORDER BY bin) AS g FROM bn) GROUP BY c1, c2, g),
 ra AS (SELECT c2 AS cid, c1 AS other, 'reads' AS kind FROM sp JOIN (SELECT c1, c2, sum(cov) AS covered FROM bk GROUP BY ALL) USING (c1, c2) JOIN cl ON cl.cid = c2 WHERE 100 * shared > 50 * n2 OR 100 * covered >= 50 * len),
 ch AS (SELECT aread, bread, sum(aepos - abpos) AS cov, min(abpos) AS ab, max(aepos) AS ae, any_value(alen) AS alen FROM ovl WHERE aread <> bread AND diffs % 3 = 0 GROUP BY aread, bread, comp),
 cc AS (SELECT aread AS cid, bread AS other, CASE WHEN 2 * cov >= alen THEN 'contained' WHEN cov >= 600 AND ab >= 100000 AND alen - ae >= 100000 THEN 'bridge' WHEN 10 * cov >= 4 * alen THEN 'repeat' END AS kind FROM ch),
 tr AS (SELECT cid, greatest(end1, end2) AS other, CASE WHEN end1 = end2 AND end1 <> -1 THEN 'bubble' WHEN (end1 = -1) <> (end2 = -1) THEN 'spur' END AS kind FROM ({tours})),
 ow AS (SELECT * FROM cc WHERE kind IS NOT NULL UNION ALL SELECT * FROM ra UNION ALL SELECT * FROM tr WHERE kind IS NOT NULL AND cid <> other),
 rl AS (SELECT * FROM ow UNION SELECT other, cid, CASE WHEN kind = 'bridge' THEN kind ELSE 'has_' || kind END FROM ow WHERE kind <> 'spur'),
 al AS (SELECT DISTINCT cid, other FROM rl WHERE kind IN ('contained', 'repeat', 'reads', 'bubble')),
 mi AS ({union}), pb AS (SELECT rid AS cid, track, sum(least(rlen, end_) - beg) AS bp FROM lens JOIN mi USING (rid) WHERE beg < rlen GROUP BY ALL), rb AS (SELECT cid, max(bp) AS rep FROM pb GROUP BY cid),
 cx AS (SELECT l.rid AS cid, rlen AS len, coalesce(rep, 0) AS rep, coalesce(reads, 0) AS reads, coalesce(na, 0) AS alternatives, coalesce(nb, 0) AS bridges, coalesce(ns, 0) AS spurs FROM lens l LEFT JOIN rb ON rb.cid = l.rid LEFT JOIN (SELECT aread, count(DISTINCT bread) AS reads FROM ovl GROUP BY 1) o ON o.aread = l.rid
  LEFT JOIN (SELECT cid, count(*) AS na FROM al GROUP BY 1) a ON a.cid = l.rid LEFT JOIN (SELECT cid, count(DISTINCT CASE WHEN kind = 'bridge' THEN other END) AS nb, count(DISTINCT CASE WHEN kind = 'spur' THEN other END) AS ns FROM rl GROUP BY 1) b ON b.cid = l.rid),
 cz AS (SELECT *, CASE WHEN alternatives = 1 THEN 'ALT' WHEN alternatives > 1 THEN 'DISCARD' WHEN len > 6000 OR (reads > 27 AND 100 * rep < 45 * len) THEN 'PRIM' ELSE 'DISCARD' END AS class FROM cx),
 cy AS (SELECT *, CASE WHEN alternatives > 1 THEN 'MULTI' WHEN class = 'DISCARD' THEN concat_ws(',', CASE WHEN reads <= 27 THEN 'CREADS' END, CASE WHEN len <= 6000 THEN 'LEN' END, CASE WHEN 100 * rep >= 45 * len THEN 'REPEAT' END) ELSE '' END AS reason FROM cz),
 pa AS (SELECT al.cid, bool_and(coalesce(class = 'PRIM', false)) AS p FROM al LEFT JOIN cz ON cz.cid = al.other GROUP BY 1)"""
RELATED = RELATED.replace("{tours}", TOURS.replace("{lens}", "lens")).replace("{union}", union("iv"))
add("all_relations", lambda v: related(v.stored()), "cid other", "kind", RELATED + ";; SELECT * FROM rl", "ovl iv lens")
add("contig_classes", lambda v: classified(v, False), "cid alternatives bridges spurs", "class reason", RELATED + ";; SELECT * FROM cy", "ovl iv lens")
add("contig_classes_resolved", lambda v: classified(v, True), "cid alternatives bridges spurs", "class reason", RELATED + ";; SELECT cid, alternatives, bridges, spurs, CASE WHEN alternatives > 1 AND p THEN 'ALT' ELSE class END AS class, CASE WHEN alternatives > 1 AND p THEN '' ELSE reason END AS reason FROM cy LEFT JOIN pa USING (cid)", "ovl iv lens")
