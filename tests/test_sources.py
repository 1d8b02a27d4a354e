import pytest
from pyspark.sql import functions as F

from millrace.sources import tables


def test_nan_becomes_null_and_csv_markers_too(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k long, v double")
    assert tables.nan_to_null(df).agg(F.count("v")).first()[0] == 1
    (tmp_path / "a.csv").write_text("k,c\n1,x\n2,NA\n3,\n")
    got = tables.read_csv(spark, str(tmp_path / "a.csv"), schema="k int, c string").orderBy("k").collect()
    assert [r.c for r in got] == ["x", None, None]


def test_random_sample_has_the_size_and_is_stable(spark):
    df = spark.range(1000)
    one, two = (tables.sample_random(df, 50, "id", seed=1).orderBy("id").collect() for _ in range(2))
    assert one == two and len(one) == 50
    assert tables.sample_random(df, 50, "id", seed=2).orderBy("id").collect() != one
    assert tables.sample_random(df, 5000, "id").count() == 1000


def test_stratified_sample_keeps_a_row_of_each_stratum_and_drops_nulls(spark):
    df = spark.createDataFrame([(i, "a" if i < 997 else None if i == 999 else "b") for i in range(1000)], "k long, s string")
    got = {r.s: r["count"] for r in tables.sample_stratified(df, 100, "s", "k").groupBy("s").count().collect()}
    assert got == {"a": 100, "b": 1}
    with pytest.raises(KeyError):
        tables.sample_stratified(df, 10, "nope", "k")


def test_combine_aligns_by_name_and_filters_by_source(spark):
    both = tables.combine(spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2, 5)], "a int, usage int"))
    assert set(both.columns) == {"a", "b", "usage", "source"}
    assert tables.of_source(both, "test").first().a == 2
    with pytest.raises(ValueError):
        tables.of_source(both, "other")
    with pytest.raises(KeyError):
        tables.of_source(spark.range(1), "train")
    with pytest.raises(ValueError):
        tables.with_source(spark.range(1), "x")


def test_read_table_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_parquet(spark.range(20), path, compression="gzip")
    assert [r.id for r in tables.read_table(spark, path, mode="sample", method="tail", n=2, order_by="id").collect()] == [19, 18]
    assert "_origin" in tables.with_origin(spark.read.parquet(path)).columns
    for bad in ({"mode": "chunked"}, {"mode": "sample", "method": "head", "n": 2}, {"mode": "sample", "n": 0}, {"mode": "sample", "method": "x", "n": 1}):
        with pytest.raises(ValueError):
            tables.read_table(spark, path, **bad)
    with pytest.raises(ValueError):
        tables.save_parquet(spark.range(0), path)
    with pytest.raises(ValueError):
        tables.save_parquet(spark.range(1), path, compression="lz9")


def test_reports_and_metrics_are_written(spark, tmp_path):
    m = spark.createDataFrame([("a", "ari", 0.5)], "model string, metric string, value double")
    for run in ("r1", "r2"):
        tables.save_metrics(m, str(tmp_path / "m"), run_id=run, step="eval")
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2
    tables.save_report(m, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().metric == "ari"
