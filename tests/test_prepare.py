import pytest
from pyspark.ml import Pipeline, PipelineModel

from millrace.operators import prepare
from millrace.operators.prepare import Prepare
from millrace.streaming.score import score_files


def fit(df, name, **settings):
    return Prepare(name, **settings).fit(df)


def test_rare_groups_keep_null_and_send_unseen_to_other(spark):
    train = spark.createDataFrame([("a",)] * 997 + [("b",)] * 2 + [("c",)], "x string")
    model = fit(train, "rare_grouping", columns=["x"], min_freq=0.002)
    got = model.transform(spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "x string"))
    assert [r.x for r in got.collect()] == ["a", "b", "OTHER", "OTHER", None]


@pytest.mark.parametrize("values", [5, 200])
def test_frequencies_by_map_or_join(spark, values):
    train = spark.createDataFrame([(f"v{i}",) for i in range(values)] + [("v0",), (None,)], "x string")
    got = fit(train, "frequency_encode", columns=["x"]).transform(spark.createDataFrame([("v0",), ("new",), (None,)], "x string"))
    assert [r.x_freq for r in got.collect()] == [pytest.approx(2 / (values + 1)), 0.0, 0.0]


@pytest.mark.parametrize("name", ["frequency_encode", "rare_grouping"])
def test_many_values_stay_a_table_that_is_saved_with_the_model(spark, tmp_path, monkeypatch, name):
    train = spark.createDataFrame([(f"v{i % 7}", i % 3) for i in range(50)] + [("once", 9), (None, None)], "x string, n int")
    settings = {"columns": ["x", "n"], **({"min_freq": 0.05} if name == "rare_grouping" else {})}
    few = fit(train, name, **settings)
    monkeypatch.setattr(prepare, "MAX_VALUES", 2)
    many = fit(train, name, **settings)
    assert "table" in many.learnt and "table" not in few.learnt
    PipelineModel([many]).write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.stages[0].learnt["table"].startswith(str(tmp_path))
    rows = lambda df: sorted(df.collect(), key=str)
    assert rows(few.transform(train)) == rows(many.transform(train)) == rows(again.transform(train))


def test_mode_tie_is_the_smallest_and_flags_come_from_fit(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    model = fit(train, "mode_impute")
    full = model.transform(spark.createDataFrame([("z",)], "c string"))
    assert model.learnt["fill"] == {"c": "a"} and full.columns == ["c", "c_is_missing"]
    assert [r.c for r in model.transform(train).collect()][-1] == "a"


def test_median_is_exact_and_only_where_train_has_nulls(spark):
    train = spark.createDataFrame([(1.0, 1), (2.0, 2), (4.0, 3), (10.0, 4), (None, 5)], "a double, b int")
    model = fit(train, "median_impute")
    assert model.learnt["fill"] == {"a": 3.0}


def test_scaling_is_by_population_and_constants_by_one(spark):
    df = spark.createDataFrame([(float(i), 7.0, None) for i in range(4)], "x double, c double, n double")
    model = fit(df, "standard_scale", columns=["x", "c", "n"])
    assert model.learnt["scale"]["x"] == [1.5, pytest.approx(1.118033988749895)]
    assert [r.c for r in model.transform(df).collect()] == [0.0] * 4 and "n" not in model.learnt["scale"]


def test_constant_and_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 1, 1, 5, None), (2, 2, 3, 5, None)], "a int, b int, c int, k int, n int")
    assert fit(df, "drop_duplicate_columns").learnt["drop"] == ["b"]
    assert fit(df, "drop_constant").learnt["drop"] == ["k", "n"]


def test_sentinels_flag_the_same_columns_on_any_table(spark):
    train = spark.createDataFrame([(5, 5), (100, 5), (None, 5)], "a long, b long")
    model = fit(train, "sentinel_nullify", thresholds={"a": 50, "b": 50})
    test = model.transform(spark.createDataFrame([(1, 99)], "a long, b long"))
    assert test.columns == ["a", "b", "a_real", "a_is_missing"]
    assert [(r.a, r.a_is_missing) for r in model.transform(train).collect()] == [(5, 0), (None, 1), (None, 0)]


def test_schema_follows_train(spark):
    train = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    got = fit(train, "align_schema", casts={"b": "float"}).transform(spark.createDataFrame([("y", 3.5, 9)], "c string, b double, extra int"))
    assert got.dtypes == [("a", "int"), ("b", "float"), ("c", "string")] and got.first().a is None


def test_vector_takes_booleans_and_zero_for_null(spark):
    df = spark.createDataFrame([(1, None, True, "x")], "a int, b double, c boolean, d string")
    model = fit(df, "feature_vector")
    assert model.learnt["inputs"] == ["a", "b", "c"] and model.transform(df).first().features == [1.0, 0.0, 1.0]


def test_group_features_of_a_null_key_are_null(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "k int, v int")
    got = {r.v: (r.n, r.d) for r in prepare.group_features(df, "k", {"n": "size", "d": "v", "gone": "nope"}).collect()}
    assert got == {5: (2, 2), 6: (2, 2), 7: (None, None)}
    with pytest.raises(KeyError):
        prepare.group_features(df, "nope", {})


def test_duplicates_by_rule(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "k int, v int")
    by = lambda keep: sorted(r.v for r in prepare.drop_duplicates(df, ["k"], keep, ["v"]).collect())
    assert (by("first"), by("last"), by(False)) == ([1, 3], [2, 3], [3])
    once = prepare.drop_duplicates(df)
    assert prepare.drop_duplicates(once).count() == once.count() == 3


def test_saved_pipeline_scores_alike_and_a_stream_takes_new_files_only(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), "a" if i % 3 else "b") for i in range(10)], "k long, x double, c string")
    model = Pipeline(stages=[Prepare("standard_scale", columns=["x"]), Prepare("frequency_encode", columns=["c"])]).fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.transform(df).orderBy("k").collect() == model.transform(df).orderBy("k").collect()
    run = lambda: score_files(spark, again, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), df.schema)
    df.write.parquet(str(tmp_path / "in"))
    run()
    df.limit(3).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 13


def test_unknown_operation():
    with pytest.raises(ValueError):
        Prepare("nope")
