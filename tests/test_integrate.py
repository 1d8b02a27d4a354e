import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from millrace.operators import integrate


def frames(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (4, "z"), (None, "w")], "k int, v string")
    return left, right


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("few", [100_000, 0])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_merge_is_the_join_with_either_way(spark, monkeypatch, how, few):
    monkeypatch.setattr(integrate, "FEW_ROWS", few)
    left, right = frames(spark)
    made, audit = integrate.merge(left, right, "k", how)
    assert made.columns == ["k", "v_left", "v_right"]
    assert rows(made) == rows(left.withColumnRenamed("v", "v_left").join(right.withColumnRenamed("v", "v_right"), "k", how))
    assert audit.where("side = 'left'").first()["n_inner"] == 4


def test_audit_by_hand(spark):
    left, right = frames(spark)
    got = {r.side: r.asDict() for r in integrate.merge_audit(left, right, "k").collect()}
    assert got["left"] == {"side": "left", "n_rows": 5, "n_null_keys": 1, "n_keys": 3, "n_repeated_keys": 1, "most_rows_per_key": 2, "n_unmatched_keys": 2, "n_unmatched_rows": 3, "n_matched_rows": 2, "relation": "many_to_many", "n_inner": 4}
    assert (got["right"]["n_unmatched_keys"], got["right"]["n_unmatched_rows"]) == (1, 2)


def test_merge_refuses_what_it_is_told_to(spark):
    left, right = frames(spark)
    for settings in ({"relation": "many_to_one"}, {"max_rows": 3}, {"how": "cross"}, {"relation": "some"}):
        with pytest.raises(ValueError):
            integrate.merge(left, right, "k", **settings)
    integrate.merge(left, right.where("v = 'x'"), "k", relation="many_to_many", max_rows=4)


def test_a_frequent_key_and_nulls_are_spread_over_tasks(spark, monkeypatch):
    """A third of the rows under one key, a third without a key: no task of the join gets either."""
    monkeypatch.setattr(integrate, "FEW_ROWS", 0)
    left = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id END AS k", "id AS v")
    right = spark.range(0, 20_000).selectExpr("id AS k", "id * 2 AS w")
    made, _ = integrate.merge(left, right, "k", "left")
    assert made.count() == 30_000 and made.where("w = 14").count() == 10_001
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from pyspark.sql import functions as F

        sizes = [r["count"] for r in integrate.merge(left, right, "k", "left")[0].groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 6000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_enrich_keeps_rows_and_refuses_repeated_keys(spark):
    left, right = frames(spark)
    made, _ = integrate.enrich(left, right.where("v <> 'y'").withColumnRenamed("v", "w"), "k")
    assert rows(made) == Counter([(1, "a", "x"), (1, "b", "x"), (2, "c", None), (None, "d", None), (3, "e", None)])
    with pytest.raises(ValueError):
        integrate.enrich(left, right, "k")


def asof(left, right, tolerance=None):
    out = []
    for k, t, i in left:
        best = max(((u, x) for j, u, x in right if k is not None and t is not None and j == k and u is not None and u <= t), default=None)
        if best and tolerance and t > best[0] + tolerance:
            best = None
        out.append((k, t, i, *(best or (None, None))))
    return Counter(out)


@pytest.mark.parametrize("tolerance", [None, "3 hours"])
def test_asof_against_all_pairs(spark, tolerance):
    r = random.Random(4)
    at = lambda: datetime(2024, 1, 1) + timedelta(hours=r.randint(0, 200)) if r.random() > 0.05 else None
    key = lambda: r.choice([None, 1, 1, 1, 1, 2, 3])
    left, right = [(key(), at(), i) for i in range(300)], [(key(), at(), i) for i in range(120)]
    a = spark.createDataFrame(left, "k int, t timestamp_ntz, i int")
    b = spark.createDataFrame(right, "k int, u timestamp_ntz, x int")
    got = integrate.align_asof(a, b, "k", "t", "u", tolerance=tolerance)
    assert got.columns == ["k", "t", "i", "u_asof", "x_asof"]
    assert rows(got) == asof(left, right, timedelta(hours=3) if tolerance else None)


def test_asof_of_one_key_carries_over_ranges_and_empty_tables(spark):
    left = spark.range(4000).selectExpr("1 AS k", "id AS t")
    right = spark.createDataFrame([(1, 5, "early")], "k int, t long, x string")
    got = integrate.align_asof(left, right, "k", "t")
    assert {(r.x_asof, r.n) for r in got.groupBy("x_asof").agg({"*": "count"}).toDF("x_asof", "n").collect()} == {(None, 5), ("early", 3995)}
    assert integrate.align_asof(left.limit(0), right, "k", "t").collect() == []
    assert integrate.align_asof(left.limit(2), right.limit(0), "k", "t").where("x_asof is null").count() == 2
