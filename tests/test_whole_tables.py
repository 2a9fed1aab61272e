from readweave.plans import REGISTRY
from readweave.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def test_overlaps_of_all_reads(spark):
    v = Fixtures(spark, SF)
    shown = REGISTRY.queries["show_all_overlaps"](spark, SF).join(v.ovl.select("ovl_id", "aread"), "ovl_id")
    assert shown.where("aread > 120").count() > 0
