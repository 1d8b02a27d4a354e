import random
import unicodedata
from collections import Counter

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import profile
from millrace.operators import cluster, prepare, quality
from millrace.operators.prepare import Prepare


# Target encoding


def brute_target(rows, smoothing):
    out = {}
    for i, c, y, f in rows:
        others = [(d, z) for j, d, z, g in rows if g != f and z is not None]
        mean = sum(z for _, z in others) / len(others) if others else None
        mine = [z for d, z in others if d == c and c is not None]
        out[i] = mean if not mine else (sum(mine) + smoothing * mean) / (len(mine) + smoothing)
    return out


@pytest.mark.parametrize("most", [100_000, 0])
def test_target_encoding_out_of_fold_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(prepare, "MAX_VALUES", most)
    r = random.Random(1)
    rows = [(i, r.choice(["a", "b", "c", None]), r.choice([float(r.randint(0, 9)), None]), r.choice([0, 1, 2, None])) for i in range(80)] + [(99, "once", 5.0, 0)]
    df = spark.createDataFrame(rows, "i int, c string, y double, f int")
    got = {x.i: x.c_target for x in prepare.target_encode_folds(df, ["c"], "y", "f", smoothing=3.0).collect()}
    want = brute_target(rows, 3.0)
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)


def test_a_random_target_gives_no_signal_out_of_fold(spark):
    """Two thousand values of few rows: the in-sample encoding knows the target, the other does not."""
    df = spark.range(6000).select("id", (F.col("id") % 2000).cast("string").alias("c"), (F.xxhash64("id", F.lit(3)) % 2).cast("double").alias("y"))
    fold = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(5))
    out = prepare.target_encode_folds(df, ["c"], "y", fold, smoothing=1.0)
    inside = Prepare("target_encode", columns=["c"], target="y", smoothing=1.0).fit(df).transform(df)
    assert inside.agg(F.corr("c_target", "y")).first()[0] > 0.4
    assert abs(out.agg(F.corr("c_target", "y")).first()[0]) < 0.1 or out.agg(F.corr("c_target", "y")).first()[0] < 0


@pytest.mark.parametrize("most", [100_000, 1])
def test_target_encoding_of_new_tables_is_saved(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(prepare, "MAX_VALUES", most)
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1), ("b", None)], "c string, y int")
    model = Pipeline(stages=[Prepare("target_encode", columns=["c"], target="y", smoothing=2.0)]).fit(train)
    model.write().save(str(tmp_path / "m"))
    new = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        got = {x.c: x.c_target for x in m.transform(new).collect()}
        assert got == {"a": pytest.approx((1 + 2 * 0.75) / 4), "b": pytest.approx((1 + 2 * 0.75) / 3), "new": 0.75, None: 0.75}
    none = Prepare("target_encode", columns=["c"], target="y").fit(train.limit(0)).transform(new)
    assert none.where("c_target is not null").isEmpty()


# One-hot


@pytest.mark.parametrize("most", [100_000, 1])
def test_one_hot_slots_unseen_values_and_saving(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(prepare, "MAX_VALUES", most)
    train = spark.createDataFrame([("b", 1), ("a", 2), ("b", None)], "c string, n int")
    model = Pipeline(stages=[Prepare("one_hot_encode", columns=["c", "n"], out="v")]).fit(train)
    model.write().save(str(tmp_path / "m"))
    new = spark.createDataFrame([("a", 1), ("b", 2), ("x", 3), (None, None)], "c string, n int")
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        made = m.transform(new)
        assert made.columns == ["c", "n", "v"]
        got = {x.c: x.v for x in made.select("c", vector_to_array("v").alias("v")).collect()}
        assert got == {"a": [1, 0, 0, 1, 0, 0], "b": [0, 1, 0, 0, 1, 0], "x": [0, 0, 1, 0, 0, 1], None: [0, 0, 1, 0, 0, 1]}


def test_one_hot_vectors_of_many_values_are_sparse(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("c"))
    row = Prepare("one_hot_encode", columns=["c"]).fit(df).transform(df).first()
    assert type(row.one_hot).__name__ == "SparseVector" and row.one_hot.size == 501 and row.one_hot.numNonzeros() == 1
    empty = Prepare("one_hot_encode", columns=["c"]).fit(df.limit(0)).transform(df.limit(1)).first()
    assert empty.one_hot.size == 1


# Text


def test_accents_go_from_composed_and_decomposed_text(spark):
    texts = ["Évênement  Ünïcode ", "éä", "ASCII only\t\n x", "Łódź Ångström ñ", "日本語", "", "  ", None, "́"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "i int, t string, n int")
    strip = lambda s: unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn"))
    got = [x.t for x in prepare.normalise_text(df, ["t", "n", "missing"]).orderBy("i").collect()]
    assert got == [None if t is None else " ".join(strip(t.lower()).split()) for t in texts]
    kept = prepare.normalise_text(df, ["t"], lowercase=False, accents=True, squeeze=False)
    assert [x.t for x in kept.orderBy("i").collect()] == texts


# Steps, masks, warnings, clipping, constants


def test_steps_are_counted_from_one_scan(spark):
    seen = spark.sparkContext.accumulator(0)

    def pass_on(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN NULL ELSE id % 10 END AS x").mapInPandas(pass_on, "id long, x long")
    steps = {"known": lambda d: d.where("x is not null"), "distinct": lambda d: d.dropDuplicates(["x"]), "columns": lambda d: d.withColumn("y", F.col("x") * 2).drop("id"), "none": lambda d: d.where("x > 100")}
    result, summary = prepare.observed_steps(df, steps)
    assert [tuple(r) for r in summary.orderBy("position").collect()] == [(0, "input", 1000, 2, 250, 0, "", ""), (1, "known", 750, 2, 0, 250, "", ""), (2, "distinct", 10, 2, 0, 740, "", ""), (3, "columns", 10, 2, 0, 0, "y", "id"), (4, "none", 0, 2, 0, 10, "", "")]
    assert result.count() == 0 and result.columns == ["x", "y"] and seen.value == 1000


def test_masked_rows_never_change_what_is_fitted(spark):
    rows = [(float(i), "v" if i % 2 else "w", i >= 20) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, c string, excluded boolean")
    wild = df.withColumns({"x": F.when(F.col("excluded"), 1e9).otherwise(F.col("x")), "c": F.when(F.col("excluded"), "zzz").otherwise(F.col("c"))})
    for name, settings in (("standard_scale", {"columns": ["x"]}), ("median_impute", {}), ("mode_impute", {}), ("frequency_encode", {"columns": ["c"]}), ("target_encode", {"columns": ["c"], "target": "x"}), ("one_hot_encode", {"columns": ["c"]}), ("iqr_clip", {"columns": ["x"]}), ("feature_vector", {}), ("drop_constant", {})):
        fits = [Prepare(name, mask="excluded", **settings).fit(d) for d in (df, wild)]
        assert fits[0].learnt == fits[1].learnt, name
        assert fits[0].transform(df).count() == 30
    assert "excluded" not in Prepare("feature_vector", mask="excluded").fit(df).learnt["inputs"]


def test_excluded_rows_with_their_reasons(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, -1), (4, None)], "k int, x int")
    marked, side, counts = prepare.split_excluded(df, {"null": "x is null", "low": F.col("x") < 0, "odd": "k % 2 = 1"}, "k")
    assert marked.count() == 4 and {r.k for r in marked.where("not excluded").collect()} == {2}
    assert {tuple(r) for r in side.collect()} == {(1, "null"), (1, "odd"), (3, "low"), (3, "odd"), (4, "null")}
    assert {r.reason: r.n_rows for r in counts.collect()} == {"null": 2, "low": 1, "odd": 2, "any": 3, "kept": 1}


def test_warnings_before_a_fit(spark):
    df = spark.range(2000).selectExpr("id", "id % 3 AS code", "timestamp_seconds(id * 60) AS t")
    got = {(r.warning, r.subject): (r.value, r.raised) for r in prepare.aggregation_warnings(df, levels=["code"], time="t").collect()}
    assert got[("encoding", "id")] == (2000.0, True) and got[("encoding", "code")] == (3.0, False)
    assert got[("aggregation", "code")] == (pytest.approx(2000 / 3), True) and got[("window", "t")][1]


def test_clipping_by_quartiles_keeps_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 10)] + [(1000.0,), (None,)], "x double")
    got = [r.x for r in Prepare("iqr_clip", columns=["x"]).fit(df).transform(df).collect()]
    assert got[:9] == [float(i) for i in range(1, 10)] and got[9] == pytest.approx(7.75 + 1.5 * 4.5) and got[10] is None


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_constant_columns_against_counting(spark, threshold):
    r = random.Random(0)
    columns = {"one": [1] * 20, "null": [None] * 20, "one_null": [1, None] * 10, "two": [1, 2] * 10, "two_null": [1, 2, None, 1] * 5, "three": [1, 2, 3, 1] * 5, "many": list(range(20)), "text": [r.choice(["a", "b"]) for _ in range(20)]}
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} {'string' if c == 'text' else 'int'}" for c in columns)).withColumn("map", F.create_map(F.lit("k"), F.col("many")))
    found = Prepare("drop_constant", threshold=threshold).fit(df).learnt["drop"]
    assert found == [c for c, v in columns.items() if len(set(v)) <= threshold]


def test_group_features_of_a_large_group_and_of_null_keys(spark, monkeypatch):
    monkeypatch.setattr(prepare, "MAX_VALUES", 0)
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN id END AS k", "id % 7 AS v")
    got = prepare.group_features(df, "k", {"n": "size", "kinds": "v", "absent": "w"})
    assert got.columns == ["k", "v", "n", "kinds"] and got.count() == 9000
    assert got.where("k = 1 and n = 3001 and kinds = 7").count() == 3001 and got.where("k is null and n is null").count() == 3000


@pytest.mark.parametrize("name", ["frequency_encode", "rare_grouping"])
def test_large_fitted_tables_meet_frequent_values_in_parts(spark, monkeypatch, name):
    df = spark.range(3000).selectExpr("CASE WHEN id % 2 = 0 THEN 'often' WHEN id % 5 > 0 THEN concat('v', id) END AS c")
    settings = {"columns": ["c"], **({"min_freq": 0.0001} if name == "rare_grouping" else {})}
    few = Prepare(name, **settings).fit(df).transform(df)
    monkeypatch.setattr(prepare, "MAX_VALUES", 10)
    many = Prepare(name, **settings).fit(df)
    assert "table" in many.learnt
    rows = lambda d: Counter(tuple(r) for r in d.collect())
    assert rows(many.transform(df)) == rows(few)


# Statistics of splits


def test_merged_moments_are_those_of_all_rows(spark):
    df = spark.range(1000).selectExpr("id % 2 = 0 AS even", "CASE WHEN id % 7 > 0 THEN sqrt(id) + 1e6 END AS x", "cast(id as string) AS s", "id % 3 = 0 AS b", "cast(NULL AS int) AS e")
    whole = profile.split_moments(df, F.when(F.col("even"), "train").otherwise("test"))
    parts = [profile.split_moments(df.where(f"x {op} 1000015 or x is null and even = {even}"), F.when(F.col("even"), "train").otherwise("test")) for op, even in (("<", "true"), (">=", "false"))]
    facts = lambda d: {(r.split, r.column_name): (r.n_rows, r.n_known, r.mean, r.m2) for r in d.collect()}
    a, b = facts(whole), facts(profile.merge_moments(*parts))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][:2] == b[k][:2]
        assert a[k][2:] == (pytest.approx(b[k][2]), pytest.approx(b[k][3], rel=1e-6)) if a[k][2] is not None else b[k][2] is None


def test_comparison_works_from_saved_moments(spark, tmp_path):
    train = spark.createDataFrame([(1.0, "a", 1), (3.0, None, 2)], "x double, c string, t int")
    test = spark.createDataFrame([(2.0, "a", "u"), (6.0, "b", "v")], "x double, c string, t string")
    profile.split_moments(train, F.lit("train")).write.parquet(str(tmp_path / "train"))
    profile.split_moments(test.withColumn("more", F.lit(1)), F.lit("test")).write.parquet(str(tmp_path / "test"))
    both = spark.read.parquet(str(tmp_path / "train"), str(tmp_path / "test"))
    got = {r.column_name: r for r in profile.compare_splits(both).collect()}
    assert {c: r.status for c, r in got.items()} == {"x": "BOTH", "c": "BOTH", "t": "TYPE_DIFFERS", "more": "ONLY_TEST"}
    assert (got["x"].mean_diff, got["x"].std_first, got["c"].known_share_diff) == (2.0, pytest.approx(2**0.5), 0.5)


# Weak spots of earlier rounds


def test_crosstabs_beyond_the_limit_leave_out_empty_cells(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "g string, t int")
    assert profile.target_by_category(df, "t", "g").count() == 4
    monkeypatch.setattr(profile, "MOST_CELLS", 3)
    assert {tuple(r) for r in profile.target_by_category(df, "t", "g").collect()} == {("a", 1, 2), ("b", 2, 1)}


def test_davies_bouldin_of_many_clusters_is_the_same(spark, monkeypatch):
    df = spark.range(600).selectExpr("id AS k", "array(cast(id % 7 as double), cast(id % 11 as double) * 3, rand(5)) AS features", "CASE WHEN id % 50 = 0 THEN NULL ELSE id % 9 END AS label")
    few = quality.davies_bouldin(df)
    monkeypatch.setattr(quality, "FEW_CLUSTERS", 1)
    assert quality.davies_bouldin(df) == pytest.approx(few)


# Random search


def test_random_search_against_all_of_a_small_space(spark):
    rows = [(i, [float(i % 3 * 20) + (i % 10) / 10, float(i % 7) / 10]) for i in range(240)]
    df = spark.createDataFrame(rows, "k long, features array<double>")
    space = {"k": [2, 3, 4, 6]}
    got = cluster.random_search(df, "k", "kmeans", space, draws=10, score="davies_bouldin", seed=3)
    every = cluster.grid(df, "k", "kmeans", {"k": space["k"], "seed": [42]}, score="davies_bouldin")
    best = got.where("best").first()
    assert best.parameters == "k=3" and every.where("best").first().parameters.startswith("k=3,")
    assert best.n_points == 240 and best.score == pytest.approx(every.where("best").first().score)
    fits = got.groupBy("rung").agg(F.count("*").alias("n"), F.max("n_points").alias("p")).orderBy("rung").collect()
    assert [(r.n, r.p) for r in fits] == [(4, 60), (2, 120), (1, 240)]
    assert got.agg(F.sum("n_points")).first()[0] < 4 * 240
    again = cluster.random_search(df, "k", "kmeans", space, draws=10, score="davies_bouldin", seed=3)
    assert [tuple(r) for r in got.orderBy("rung", "candidate").collect()] == [tuple(r) for r in again.orderBy("rung", "candidate").collect()]


def test_draws_from_ranges():
    import numpy as np

    rng = np.random.default_rng(0)
    made = [cluster._draw(rng, {"k": (2, 5), "eps": (0.1, 10.0, "log"), "m": [7], "x": (0.0, 1.0), "n": (1, 1000, "log")}) for _ in range(300)]
    assert {m["k"] for m in made} == {2, 3, 4, 5} and all(0.1 <= m["eps"] <= 10 and 0 <= m["x"] <= 1 and m["m"] == 7 and 1 <= m["n"] <= 1000 for m in made)
    assert 100 < sum(m["eps"] < 1 for m in made) < 200
