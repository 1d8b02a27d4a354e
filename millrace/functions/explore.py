"""Grouped queries for a first look at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import values
from .values import quoted


def unpivot_row(row: DataFrame, names: Sequence[str], fields: Sequence[str], label: str = "column") -> DataFrame:
    """One row with columns ``<i>_<field>`` for the i-th name becomes a row per name."""
    parts = F.array(*[F.struct(F.lit(c).alias(label), *[F.col(f"{i}_{f}").alias(f) for f in fields]) for i, c in enumerate(names)])
    return row.select(F.explode(parts).alias("_x")).select("_x.*")


def per_column(df: DataFrame, columns: Sequence[str], facts: dict[str, object], by: Sequence[str] = (), label: str = "column") -> DataFrame:
    """All facts (name -> function of a column name) of all columns in one aggregation."""
    aggs = [fact(quoted(c)).alias(f"{i}_{name}") for i, c in enumerate(columns) for name, fact in facts.items()]
    row = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    parts = F.array(*[F.struct(F.lit(c).alias(label), *[F.col(f"{i}_{f}").alias(f) for f in facts]) for i, c in enumerate(columns)])
    return row.select(*by, F.explode(parts).alias("_x")).select(*by, "_x.*")


def distinct_counts(df: DataFrame, where: Column, columns: Sequence[str]) -> DataFrame:
    return df.where(where).agg(F.count("*").alias("n_rows"), *[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def distinct_rows(df: DataFrame, where: Column, order_by: Sequence[str]) -> DataFrame:
    return df.where(where).dropDuplicates().orderBy(*order_by)


def describe_schema(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)], "position int, column_name string, column_type string")


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys one by one, and distinct key tuples (nulls are values of a tuple)."""
    return df.agg(F.count("*").alias("n_rows"), *[F.countDistinct(k).alias(f"n_{k}") for k in keys], F.countDistinct(F.struct(*keys)).alias("n_composite"))


def label_consistency(df: DataFrame, key: str, label: str) -> DataFrame:
    groups = df.groupBy(key).agg(F.countDistinct(label).alias("n"))
    return groups.agg(F.count("*").alias("n_groups"), F.count_if(F.col("n") > 1).alias("n_inconsistent"))


def fanout_quantiles(df: DataFrame, key: str, q: Sequence[float] = (0.5, 0.9, 0.99), exact: bool = True) -> DataFrame:
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    quantile = (lambda x: F.percentile("n", F.lit(x))) if exact else (lambda x: F.percentile_approx("n", F.lit(x), 10000))
    return counts.agg(*[quantile(x).cast("double").alias(f"p{round(100 * x)}") for x in q], F.max("n").alias("max_n"))


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-null share in percent and null count of every column."""
    columns = list(columns or df.columns)
    return per_column(df, columns, {"n_null": lambda c: F.count_if(F.col(c).isNull()), "pct_complete": lambda c: F.round(F.count(c) * 100.0 / F.count("*"), 4)}, label="column_name")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def distinct_min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias("n_distinct"), F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def topk_frequency(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The ``k`` most frequent values, null included; ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def calendar_rollup(df: DataFrame, ts: str, parts: Sequence[str] = ("year", "month")) -> DataFrame:
    fields = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return df.groupBy(*[fields[p](ts).alias(p) for p in parts]).agg(F.count("*").alias("n")).orderBy(*parts)


def month_trunc(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.date_trunc("month", ts).cast("date").alias("month")).agg(F.count("*").alias("n")).orderBy("month")


def id_likeness(df: DataFrame, columns: Sequence[str], *, exact: bool = True) -> DataFrame:
    """Uniqueness in percent per column: above 90 an identifier, below 10 a category."""
    facts = {"n_total": F.count, "min_value": lambda c: F.min(c).cast("double"), "max_value": lambda c: F.max(c).cast("double")}
    table = per_column(df, columns, facts, label="column_name").join(F.broadcast(values.distinct_counts(df, columns, exact=exact)), "column_name")
    pct = F.round(F.col("n_distinct") * 100.0 / F.col("n_total"), 4)
    return table.select("column_name", "n_distinct", *facts, pct.alias("uniqueness_pct"), F.when(pct > 90, "id").when(pct < 10, "categorical").otherwise("mixed").alias("kind"))


def distribution_shape(df: DataFrame, columns: Sequence[str], *, exact: bool = True) -> DataFrame:
    """Range, quartiles, mean and deviation; a mean of over 1.5 medians is skewed right."""
    facts = {"min_value": lambda c: F.min(c).cast("double"), "max_value": lambda c: F.max(c).cast("double"), "mean": lambda c: F.avg(F.col(c).cast("double")), "std": F.stddev_samp}
    cuts = values.quantiles(df, columns, (0.25, 0.5, 0.75), exact=exact).select("column_name", F.col("q0").alias("q25"), F.col("q1").alias("median"), F.col("q2").alias("q75"))
    table = per_column(df, columns, facts, label="column_name").join(F.broadcast(cuts), "column_name")
    skew = F.when(F.col("mean") > 1.5 * F.col("median"), "SKEWED_RIGHT").otherwise("SYMMETRIC")
    return table.select("column_name", *[F.round(f, 4).alias(f) for f in ("min_value", "q25", "median", "q75", "max_value", "mean", "std")], skew.alias("distribution_shape"))


def distinct_per_source(df: DataFrame, column: str, by: str = "source") -> DataFrame:
    return df.groupBy(by).agg(F.countDistinct(column).alias("n_distinct"), F.count("*").alias("n_rows"))


def category_presence(df: DataFrame, column: str, by: str = "source") -> DataFrame:
    """Rows per category in either split, and whether it is in one of them or both."""
    counts = df.groupBy(F.col(column).alias("category")).agg(F.count_if(F.col(by) == "train").alias("n_train"), F.count_if(F.col(by) == "test").alias("n_test"))
    presence = F.when(F.col("n_test") == 0, "TRAIN_ONLY").when(F.col("n_train") == 0, "TEST_ONLY").otherwise("BOTH")
    return counts.withColumn("presence", presence)


def normalisation_impact(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    forms = {"original": c, "lower": F.lower(c), "trim": F.trim(c), "lower_trim": F.lower(F.trim(c))}
    row = df.agg(*[F.countDistinct(x).alias(f"{i}_n_distinct") for i, x in enumerate(forms.values())])
    return unpivot_row(row, list(forms), ["n_distinct"], label="form")


def problem_values(df: DataFrame, column: str) -> DataFrame:
    """Values that have outer white space, upper case or are null, in that order of tests."""
    v = F.col("value")
    issue = F.when(v != F.trim(v), "WHITESPACE").when(v != F.lower(v), "CASE").when(v.isNull(), "NULL").otherwise("OK")
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).withColumn("issue", issue).where("issue <> 'OK'")


def log_candidates(df: DataFrame, columns: Sequence[str], *, exact: bool = True) -> DataFrame:
    """Which numeric columns gain from a logarithm, from uniqueness, spread and skew: those that
    do first, then by uniqueness."""
    facts = {"n_total": lambda c: F.count("*"), "min_value": lambda c: F.min(c).cast("double"), "max_value": lambda c: F.max(c).cast("double"), "mean": lambda c: F.avg(F.col(c).cast("double"))}
    table = per_column(df, columns, facts, label="column_name").join(F.broadcast(values.distinct_counts(df, columns, exact=exact)), "column_name")
    table = table.join(F.broadcast(values.quantiles(df, columns, (0.5,), exact=exact).withColumnRenamed("q0", "median")), "column_name")
    table = table.withColumn("uniqueness_pct", F.round(F.col("n_distinct") * 100.0 / F.col("n_total"), 2))
    table = table.withColumn("range_ratio", F.round(F.col("max_value") / F.nullif(F.col("min_value"), F.lit(0.0)), 2))
    shape = F.when(F.col("mean") > 1.5 * F.col("median"), "SKEWED_RIGHT").when(F.col("mean") < 0.5 * F.col("median"), "SKEWED_LEFT").otherwise("SYMMETRIC")
    table = table.withColumn("distribution_shape", shape)
    decision = (
        F.when(F.col("uniqueness_pct") > 50, "NO: ID (high uniqueness)")
        .when(F.col("n_distinct") < 100, "NO: CATEGORICAL (low unique count)")
        .when(F.col("distribution_shape") == "SYMMETRIC", "NO: symmetric distribution")
        .when(F.col("range_ratio") < 10, "NO: narrow range")
        .otherwise("YES: log transform candidate")
    )
    table = table.withColumn("log_transform_decision", decision)
    first = F.when(F.col("log_transform_decision").startswith("YES"), 1).otherwise(2)
    return table.orderBy(first, F.desc("uniqueness_pct"), "column_name").select("column_name", "n_distinct", "uniqueness_pct", "range_ratio", "distribution_shape", "log_transform_decision")


def class_share(df: DataFrame, column: str) -> DataFrame:
    """Shares of the non-null values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("value", "n", F.round(F.col("n") / F.col("_total"), 6).alias("share"))


def hour_histogram(df: DataFrame, ts: str) -> DataFrame:
    return df.where(F.col(ts).isNotNull()).groupBy(F.hour(ts).alias("hour")).agg(F.count("*").alias("n")).orderBy("hour")
