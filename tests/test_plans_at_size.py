"""What queries must not do on tables that are larger than these."""

from readweave.plans import REGISTRY

SF = "/root/testdata/sf0.001"


def test_intervals_meet_reads_by_equality(spark):
    """A loop over all orders and all reads, however small the reads are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("spanning_reads", "lift_corrected", "homogenize"):
            plan = REGISTRY.queries[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_segments_are_not_sent(spark):
    """Segments meet their overlap where they are made."""
    from readweave.operators.lift import segments
    from readweave.sources.fixtures import Fixtures

    v = Fixtures(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = segments(v.ovl, v.trace)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan[plan.index("Window") : plan.index("Generate")]
