import random
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from millrace.operators.graph import components
from millrace.sources.scratch import checkpoint, hot_join, hot_keys, scratch, workspace


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(1000, 1000 + i) for i in range(1, 3000)] + [(5000 + i, 5001 + i) for i in range(100)]
    home = {}

    def find(x):
        home.setdefault(x, x)
        while home[x] != x:
            x = home[x]
        return x

    for a, b in edges:
        if a != b and (x := find(a)) != (y := find(b)):
            home[max(x, y)] = min(x, y)
    for few in (0, 10**6):
        got = components(spark.createDataFrame(edges, "a long, b long"), few=few).collect()
        assert {x.node: x.root for x in got} == {x: find(x) for x in home} and len(got) == len(home)


def test_joins_on_hot_keys(spark):
    left = spark.createDataFrame([(0, i) for i in range(500)] + [(i % 40, i) for i in range(300)] + [(None, 1)], "k int, x int")
    right = spark.createDataFrame([(i, f"v{i}") for i in range(0, 60, 2)], "k int, v string")
    hot = hot_keys(left.groupBy("k").agg(F.count("*").alias("n")), ["k"], least=100, most=8)
    assert [(r.k, r.parts) for r in hot.collect()] == [(0, 6)]
    assert hot_keys(left.groupBy("k").agg(F.count("*").alias("n")), ["k"]) is None
    for how in ("inner", "left", "left_semi", "left_anti"):
        want, got = (Counter(tuple(r) for r in df.collect()) for df in (left.join(right, "k", how), hot_join(left, right, ["k"], hot, how)))
        assert got == want


def test_a_workspace_is_deleted(spark):
    with workspace(spark) as folder:
        assert checkpoint(spark.range(3)).count() == 3 and Path(folder).exists()
    assert not Path(folder).exists() and not scratch(spark, "x").startswith(folder)
