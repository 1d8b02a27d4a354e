"""Distinct counts and exact quantiles of many columns at once.

Cells are put in long form and counted per column and value, with a partial count in each
task, so nothing grows but the table of distinct values. Quantiles come from running sums of
these counts; beyond ``MOST_VALUES`` of them the sums are made in two levels, per range of the
values and over the ranges, so no task gets a whole column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.sources.scratch import checkpoint

#: Distinct values of all columns that are summed up with one task per column.
MOST_VALUES = 2_000_000


def quoted(column: str) -> str:
    """A name that may hold dots, for ``F.col``."""
    return "`" + column.replace("`", "``") + "`"


def _long(df: DataFrame, columns: Sequence[str], number: bool) -> DataFrame:
    """``column_name, x, s``: one row per non-null cell, floating ones in x, others as text in s."""
    kinds = {f.name: f.dataType for f in df.schema}

    def cell(c: str) -> Column:
        x, none = F.col(quoted(c)), F.lit(None)
        floating = number or isinstance(kinds[c], (T.DoubleType, T.FloatType))
        return F.struct(F.lit(c).alias("column_name"), (x.cast("double") if floating else none.cast("double")).alias("x"), (none.cast("string") if floating else _text(x, kinds[c])).alias("s"))

    return df.select(F.explode(F.array(*map(cell, columns))).alias("_x")).select("_x.*").where("x is not null or s is not null")


def _text(x: Column, kind: T.DataType) -> Column:
    return F.to_json(x) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else F.base64(x) if isinstance(kind, T.BinaryType) else x.cast("string")


def distinct_counts(df: DataFrame, columns: Sequence[str], *, exact: bool = True) -> DataFrame:
    """``column_name, n_distinct`` of non-null values; approximate counts take one pass and no shuffle of values."""
    columns = list(columns)
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    if not exact:
        row = df.agg(*[F.approx_count_distinct(quoted(c), 0.01).alias(f"_{i}") for i, c in enumerate(columns)])
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("n_distinct")) for i, c in enumerate(columns)]
        return row.select(F.explode(F.array(*cells)).alias("_x")).select("_x.*")
    found = _long(df, columns, False).groupBy("column_name", "x", "s").agg(F.lit(1)).groupBy("column_name").agg(F.count("*").alias("n_distinct"))
    return names.join(F.broadcast(found), "column_name", "left").na.fill(0, ["n_distinct"])  # a row per column


def quantiles(df: DataFrame, columns: Sequence[str], q: Sequence[float], *, exact: bool = True, most_values: int = MOST_VALUES) -> DataFrame:
    """``column_name, q0, q1, ...``: quantiles of the non-null values as doubles, with linear
    interpolation; approximate ones are values of the column (``percentile_approx``)."""
    columns, q = list(columns), list(q)
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    if not exact:
        row = df.agg(*[F.percentile_approx(F.col(quoted(c)).cast("double"), q, 10_000).alias(f"_{i}") for i, c in enumerate(columns)])
        cells = [F.struct(F.lit(c).alias("column_name"), *[F.get(F.col(f"_{i}"), j).alias(f"q{j}") for j in range(len(q))]) for i, c in enumerate(columns)]
        return row.select(F.explode(F.array(*cells)).alias("_x")).select("_x.*")
    counts = checkpoint(_long(df, columns, True).groupBy("column_name", "x").agg(F.count("*").alias("n")))
    size = F.broadcast(counts.groupBy("column_name").agg((F.sum("n") - 1).alias("last")))  # a row per column
    upto = running(counts, "n", counts.count() > most_values).join(size, "column_name")

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("upto") - F.col("n") <= rank, F.col("x")))

    aggs = []
    for j, share in enumerate(q):
        place = F.col("last") * share
        low, high = at(F.floor(place)), at(F.ceil(place))
        aggs.append((low + (high - low) * F.max(place - F.floor(place))).alias(f"q{j}"))
    return names.join(F.broadcast(upto.groupBy("column_name").agg(*aggs)), "column_name", "left")


def running(counts: DataFrame, n: str, in_ranges: bool, by: str = "column_name", value: str = "x") -> DataFrame:
    """``counts`` with ``upto``, the sum of ``n`` over the values of a column up to each."""
    if not in_ranges:
        return counts.withColumn("upto", F.sum(n).over(Window.partitionBy(by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ranged = checkpoint(counts.repartitionByRange(by, value).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy(by, "_range").agg(F.sum(n).alias("_sum"))
    before = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(by, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))  # as many rows as tasks
    within = Window.partitionBy(by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.withColumn("_in", F.sum(n).over(within)).join(F.broadcast(offsets), [by, "_range"]).withColumn("upto", F.col("_before") + F.col("_in")).drop("_range", "_before", "_in")
