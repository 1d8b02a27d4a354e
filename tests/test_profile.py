import pytest

from millrace.functions import drift, explore, profile


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert profile.duplicates_summary(df).first().asDict() == {"n_rows": 3, "n_duplicates": 1, "pct_duplicates": 33.3333}
    assert profile.duplicates_summary(df, ["a"], keep=False).first().n_duplicates == 2
    assert profile.duplicates_summary(df.limit(0)).first().pct_duplicates == 0


def test_multi_values_are_cut_before_empties_go(spark):
    df = spark.createDataFrame([(" a\t,,b",), (",".join("z" * 12),), (None,)], "c string")
    got = {r.value: r.n for r in profile.multi_value_frequency(df, "c").collect()}
    assert got == {"a": 1, "b": 1, "z": 10}


def test_numeric_columns_take_booleans(spark):
    assert profile.numeric_columns(spark.createDataFrame([(1, True, "x")], "a int, b boolean, c string")) == ["a", "b"]


def test_schema_compare_and_compatible(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("x", 1, 2)], "b string, a int, c int")
    table = profile.schema_compare(a, b)
    assert {r.column_name: r.status for r in table.collect()} == {"a": "ORDER_DIFFERS", "b": "ORDER_DIFFERS", "c": "MISSING_IN_TRAIN"}
    assert profile.compatible(table) and not profile.compatible(table, strict=True) and not profile.compatible(table, order=True)


def test_timestamps_that_are_none(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("bad",), ("2024-01-20 12:00:00",)], "t string")
    row = profile.timestamp_range(df, "t", 14).first()
    assert (row.n_days, row.n_invalid, row.valid) == (19, 1, True)
    row = profile.timestamp_range(df.where("t = 'bad'"), "t", 14).first()
    assert (row.valid, row.reason) == (False, "no valid timestamp")


def test_target_distribution_counts_none_texts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("None",), (None,)], "y string")
    row = profile.target_distribution(df, "y").where("value = 'a'").first()
    assert (row.n_none_text, row.imbalance_ratio, row.share) == (1, 2.0, 0.5)


@pytest.mark.parametrize("name", ["psi", "ks"])
def test_no_drift_against_itself(spark, name):
    df = spark.range(100).selectExpr("cast(id as double) x", "'train' source")
    long = drift.long_form(df.union(df.selectExpr("x", "'test' source")), ["x"])
    row = (drift.psi_table if name == "psi" else drift.ks_table)(long).first()
    assert row[name] == pytest.approx(0, abs=1e-12)
    if name == "ks":
        assert row.p_value == 1.0


def test_psi_of_constant_or_one_side_is_zero(spark):
    df = spark.createDataFrame([(1.0, "train"), (1.0, "test")], "x double, source string")
    assert drift.psi(df, "x").first().psi == 0
    assert drift.psi(df.where("source = 'train'"), "x").first().psi == 0


def test_ks_on_disjoint_samples(spark):
    df = spark.createDataFrame([(float(i), "train" if i < 50 else "test") for i in range(100)], "x double, source string")
    row = drift.ks_table(drift.long_form(df, ["x"])).first()
    assert row.ks == 1.0 and row.p_value < 1e-15


def test_chi2_with_and_without_yates(spark):
    cells = {("a", "train"): 10, ("a", "test"): 20, ("b", "train"): 15, ("b", "test"): 5}
    df = spark.createDataFrame([k for k, n in cells.items() for _ in range(n)], "t string, source string")
    # By hand: without correction 8.3333; with Yates sum((|n - x| - 0.5)^2 / x) = 6.75.
    assert drift.chi2_drift(df, "t").first().chi2 == pytest.approx(6.75)
    assert drift.chi2_pvalue(8.333333333333334, 1) == pytest.approx(0.003892, abs=1e-6)
    assert drift.chi2_pvalue(5.991464547107979, 2) == pytest.approx(0.05)


def test_problem_values_test_white_space_first(spark):
    df = spark.createDataFrame([(" A",), ("A",), ("a",), (None,)], "c string")
    assert {r.value: r.issue for r in explore.problem_values(df, "c").collect()} == {" A": "WHITESPACE", "A": "CASE", None: "NULL"}


def test_key_audit_counts_tuples_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 1), (None, 1), (1, 1)], "a int, b int")
    assert explore.key_audit(df, ["a", "b"]).first().n_composite == 3


def test_sentinels_agree_with_their_sql_where_each_is_found(spark, tmp_path):
    import duckdb

    from millrace.plans.queries import ORACLE_SQL, QUERIES

    spark.sql("SELECT id AS event_id, timestamp_ntz'2024-01-01' AS ts, CASE id WHEN 1 THEN 999 ELSE 8 END AS user_id, 'click' AS event_type, 1.0D AS value, '' AS props FROM range(1, 24)").write.parquet(f"{tmp_path}/events.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    db.execute("CREATE TABLE lineitem (l_shipdate TIMESTAMP)")
    want = sorted(db.execute(ORACLE_SQL["sentinel_counts"]).fetchall())
    assert want == [("hashed", "-1", 1), ("hashed", "1000008", 2), ("hashed", "999", 1)]
    assert sorted(map(tuple, QUERIES["sentinel_counts"](spark, str(tmp_path)).collect())) == want
