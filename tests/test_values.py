import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import drift, explore, values


def frame(spark):
    r = random.Random(5)
    rows = [(r.choice([None, r.random(), 1.0, float(r.randint(0, 9))]), r.randint(0, 40), r.choice(["a", "b", None])) for _ in range(700)]
    return rows, spark.createDataFrame(rows, "`x.y` double, k int, s string").repartition(5)


@pytest.mark.parametrize("most", [10**6, 0])
def test_quantiles_against_sorting(spark, most):
    rows, df = frame(spark)
    q = (0.0, 0.1, 0.5, 0.77, 1.0)
    got = {r["column_name"]: [r[f"q{i}"] for i in range(len(q))] for r in values.quantiles(df, ["x.y", "k"], q, most_values=most).collect()}
    for n, c in enumerate(["x.y", "k"]):
        v = sorted(float(r[n]) for r in rows if r[n] is not None)
        for share, found in zip(q, got[c], strict=True):
            p = (len(v) - 1) * share
            want = v[math.floor(p)] + (v[math.ceil(p)] - v[math.floor(p)]) * (p - math.floor(p))
            assert abs(found - want) < 1e-12
    assert [tuple(r) for r in values.quantiles(df.where("k > 99"), ["k"], [0.5], most_values=most).collect()] == [("k", None)]


def test_distinct_counts_exact_and_approximate(spark):
    rows, df = frame(spark)
    want = {c: len({r[n] for r in rows} - {None}) for n, c in enumerate(["x.y", "k", "s"])}
    assert {r["column_name"]: r["n_distinct"] for r in values.distinct_counts(df, df.columns).collect()} == want
    near = {r["column_name"]: r["n_distinct"] for r in values.distinct_counts(df, df.columns, exact=False).collect()}
    assert all(abs(near[c] - n) <= 0.05 * n for c, n in want.items())
    assert abs(values.quantiles(df, ["k"], [0.5], exact=False).first()["q0"] - 20) <= 2
    assert {r["n_distinct"] for r in values.distinct_counts(df.limit(0), df.columns).collect()} == {0}


@pytest.mark.parametrize("most", [10**6, 0])
def test_kolmogorov_smirnov_in_ranges(spark, most):
    r = random.Random(3)
    rows = [("train" if i % 2 else "test", r.gauss(i % 2 / 2, 1) if i % 5 else 0.0) for i in range(600)]
    long = drift.long_form(spark.createDataFrame(rows, "source string, v double"), ["v"])
    a, b = ([v for s, v in rows if s == name] for name in ("train", "test"))
    want = max(abs(sum(x <= t for x in a) / len(a) - sum(x <= t for x in b) / len(b)) for _, t in rows)
    assert abs(drift.ks_table(long, most_values=most).first()["ks"] - want) < 1e-12


def test_left_skew_begins_at_half_the_median(spark):
    df = spark.createDataFrame([(float(i % 5 < 2) * -995 + 1000 + i / 1000, (1.0 if i % 5 < 2 else 1000.0) * (1 + i), i) for i in range(1000)], "between double, left_out double, k int")
    got = {r.column_name: r.distribution_shape for r in explore.log_candidates(df.drop("left_out"), ["between"]).collect()}
    assert got == {"between": "SYMMETRIC"}  # the mean is 0.6 of the median
    low = df.select(F.when(F.col("k") % 5 < 2, F.lit(1.0)).when(F.col("k") % 5 == 2, F.lit(100.0) + F.col("k") / 1000).otherwise(F.lit(110.0)).alias("v"))
    assert explore.log_candidates(low, ["v"]).first().distribution_shape == "SYMMETRIC"
    far = df.select((F.when(F.col("k") % 100 < 45, -400.0).otherwise(100.0) + F.col("k") / 1000).alias("v"))
    row = explore.log_candidates(far, ["v"]).first()
    assert row.distribution_shape == "SKEWED_LEFT" and row.log_transform_decision == "NO: ID (high uniqueness)"
