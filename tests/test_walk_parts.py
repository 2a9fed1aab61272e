from readweave.operators import paths


def test_walks_lie_in_parts_of_few_sides(spark, monkeypatch):
    """More sides make more parts, and not larger ones; the rows are the same."""
    edges = spark.createDataFrame([(i, j, "r" if j > i else "l", 10, 0) for i in range(9) for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < 9], "src long, dst long, side string, ovh long, div long")
    want = sorted(map(tuple, paths.best_next(edges, 2).collect()))
    monkeypatch.setattr(paths, "SIDES", 2)
    got = paths.best_next(edges, 2)
    assert want and sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [src" in plan and ", 8" in next(x for x in plan.splitlines() if "RepartitionByExpression [src" in x)
