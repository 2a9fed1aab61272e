"""Files written and read back, and rows by hand."""

from readweave.sources import text as T

IV = "track string, rid long, beg long, end_ long"


def put(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_fasta_text_and_case(spark):
    reads = spark.createDataFrame([(1, "a", "ACGTA"), (2, "b", "ACGTACG")], "rid long, header string, seq string")
    iv = spark.createDataFrame([("m", 2, 1, 3), ("m", 2, 5, 6)], IV)
    got = [r.value for r in T.fasta_text(reads, 4, "lower", True, iv).collect()]
    assert got == [">b m=1,3,5,6\nacgt\nacg", ">a\nacgt\na"]
    trim = spark.createDataFrame([(1, 0, 0), (2, 1, 7)], "rid long, tb long, te long")
    assert [tuple(r) for r in T.show_reads(reads, [(2, 9)], 3, trim, iv).collect()] == [(2, "cgTAcG")]


def test_masks_and_gff(spark, tmp_path):
    reads = spark.createDataFrame([(1, 100)], "rid long, rlen long")
    m = T.read_mask_txt(spark, put(tmp_path / "m.txt", ["1 5 20", "1  90 120", "9 0 5"]), reads)
    assert sorted((r.rid, r.beg, r.end_, r.bad) for r in m.collect()) == [(1, 5, 20, False), (1, 90, 120, True), (9, 0, 5, True)]
    assert [tuple(r) for r in T.read_mask_txt(spark, put(tmp_path / "p.txt", ["3 4"]), reads, "pair").collect()] == [(3, 4)]
    g = T.read_gff(spark, put(tmp_path / "g.gff", ["##gff", "read_1\ts\trep\t11\t20\t.\t+\tx", "1\ts\trep\t1\t5\t.\t-\ty"]), reads)
    assert sorted((r.rid, r.beg, r.end_, r.bad) for r in g.collect()) == [(1, 0, 5, False), (1, 10, 20, False)]


def test_overlaps_round_trip(spark, tmp_path):
    cols = "ovl_id long, aread long, bread long, comp int, abpos long, aepos long, bbpos long, bepos long, flags int"
    o = spark.createDataFrame([(1, 2, 1, 0, 0, 9, 0, 9, 2048), (2, 1, 2, 0, 0, 9, 0, 9, 2), (3, 1, 1, 0, 0, 9, 0, 9, 0)], cols)
    T.write_overlaps(o, f"{tmp_path}/o", 126, purge=True)
    assert sorted((r.ovl_id, r.flags, r.twidth) for r in T.read_overlaps(spark, f"{tmp_path}/o", 126).collect()) == [(1, 0, 126), (3, 0, 126)]


def test_graph_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([(1, 50, 0), (2, 60, 4)], "rid long, rlen long, flags long")
    edges = spark.createDataFrame([(1, 2, "r", 7, 3)], "src long, dst long, side string, ovh long, div long")
    T.write_graph(nodes, edges, f"{tmp_path}/t")
    n, e = T.read_tgf(spark, f"{tmp_path}/t")
    assert sorted(map(tuple, n.collect())) == [(1, 50, 0), (2, 60, 4)] and [tuple(r) for r in e.collect()] == [(1, 2, "r", 7, 3)]
    for form, part in (("gml", "source 1 target 2"), ("graphml", 'source="1" target="2"')):
        assert sum(part in r.value for r in T.graph_text(nodes, edges, form).collect()) == 1


def test_gap_agp_sam_paths(spark, tmp_path):
    contigs = spark.createDataFrame([(7, "c1"), (8, "c2")], "cid long, name string")
    g = T.read_gap(spark, put(tmp_path / "gap", ["#h", "c1_subseq_1:9\tc2\ts\t-5.5\t-4\t10\t20", "c1\tc1\ts\t1\t1\t1\t1", "c2\tzz\ts\t1\t1\t1\t1"]), contigs)
    assert sorted((r.cid1, r.cid2, r.xmap_gap, r.sub_end1) for r in g.collect() if r.cid2) == [(7, 8, -5.5, 9)] and g.count() == 2
    rows = ["o1\t1\t50\t1\tW\tc1\t1\t50\t+", "o1\t51\t60\t2\tN\t10\tscaffold\tyes\tmap", "o2\t1\t50\t1\tW\tc1\t51\t100\t-"]
    assert [tuple(r) for r in T.agp_splits(T.read_agp(spark, put(tmp_path / "agp", rows))).collect()] == [("c1", 50)]
    rows, head = T.read_sam(spark, put(tmp_path / "sam", ["@HD", "q\t0\tr\t5\t60\t9M", "q\t16\tr\t7\t60\t9M"]))
    assert sorted((r.ord, r.flag, r.pos) for r in rows.collect()) == [(1, 0, 5), (2, 16, 7)] and head.count() == 1
    paths = spark.createDataFrame([(1, 0, 1), (1, 1, 4), (1, 2, 6)], "path long, rank long, rid long")
    assert [r.line for r in T.path_text(paths).collect()] == ["PATH 1 -1 -1 1-4 4-6"]
