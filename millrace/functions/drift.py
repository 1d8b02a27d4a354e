"""Drift between two splits of a table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.sources.scratch import checkpoint

from . import values


def long_form(df: DataFrame, columns: Sequence[str], by: str = "source", first: str = "train") -> DataFrame:
    """``column_name, value, expected``: one row per non-null cell, expected telling the split."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select((F.col(by) == first).alias("expected"), F.explode(cells).alias("_x")).select("expected", "_x.*").where("value is not null and expected is not null")


def psi_table(long: DataFrame, n_bins: int = 10) -> DataFrame:
    """Population stability index per column: equal-width bins over the joint range, the last
    one closed, shares of 1e-6 at least; 0 for an empty side or a constant column."""
    ends = long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count_if("expected").alias("n_e"), F.count_if(~F.col("expected")).alias("n_a"))
    width = (F.col("hi") - F.col("lo")) / n_bins
    edge = lambda i: F.col("lo") + i * width
    # Bin = number of inner edges at or below the value.
    inner = [(F.col("value") >= edge(i)).cast("int") for i in range(1, n_bins)]
    placed = long.join(F.broadcast(ends), "column_name").withColumn("bin", sum(inner[1:], inner[0]))
    counts = placed.groupBy("column_name", "bin").agg(F.count_if("expected").alias("e"), F.count_if(~F.col("expected")).alias("a"))
    grid = ends.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    filled = grid.join(counts, ["column_name", "bin"], "left")
    share = lambda n, total: F.greatest(F.coalesce(F.col(n), F.lit(0)) / F.col(total), F.lit(1e-6))
    term = (share("a", "n_a") - share("e", "n_e")) * F.ln(share("a", "n_a") / share("e", "n_e"))
    defined = (F.col("n_e") > 0) & (F.col("n_a") > 0) & (F.col("hi") > F.col("lo"))
    return filled.groupBy("column_name").agg(F.coalesce(F.sum(F.when(defined, term)), F.lit(0.0)).alias("psi"))


def ks_table(long: DataFrame, most_values: int = values.MOST_VALUES) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per column and its asymptotic p-value.

    Counts are added up per distinct value first. Beyond ``most_values`` of them the running sums
    are made in two levels, in as many ranges as there are shuffle partitions, so that no
    task gets a whole column.
    """
    counts = checkpoint(long.groupBy("column_name", "value").agg(F.count_if("expected").alias("e"), F.count_if(~F.col("expected")).alias("a")))
    sums = F.broadcast(counts.groupBy("column_name").agg(F.sum("e").alias("n_e"), F.sum("a").alias("n_a")))  # a row per column
    many = counts.count() > most_values
    both = [values.running(counts, c, many, value="value").select("column_name", "value", F.col("upto").alias(f"c{c}")) for c in ("e", "a")] if many else None
    if both:
        summed = both[0].join(both[1], ["column_name", "value"])
    else:
        upto = Window.partitionBy("column_name").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = counts.select("column_name", F.sum("e").over(upto).alias("ce"), F.sum("a").over(upto).alias("ca"))
    gap = F.abs(F.col("ce") / F.col("n_e") - F.col("ca") / F.col("n_a"))
    table = summed.join(sums, "column_name").groupBy("column_name").agg(F.max(F.when((F.col("n_e") > 0) & (F.col("n_a") > 0), gap)).alias("ks"), F.first("n_e").alias("n_e"), F.first("n_a").alias("n_a"))
    return table.select("column_name", "ks", ks_pvalue(F.col("ks"), F.col("n_e"), F.col("n_a")).alias("p_value"))


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Kolmogorov series 2 sum (-1)^(k-1) exp(-2 k^2 t^2) with t = d sqrt(nm / (n + m))."""
    t2 = d * d * n * m / (n + m)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * t2))
    return F.when(t2 < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def psi(df: DataFrame, column: str, by: str = "source", n_bins: int = 10) -> DataFrame:
    return psi_table(long_form(df, [column], by), n_bins)


def chi2_drift(df: DataFrame, target: str, by: str = "source") -> DataFrame:
    """Chi-square of target against split, degrees of freedom and p-value; Yates' correction
    in the 2 x 2 case. Nulls are left out."""
    counts = df.where(F.col(target).isNotNull() & F.col(by).isNotNull()).groupBy(F.col(target).alias("t"), F.col(by).alias("s")).agg(F.count("*").alias("n"))
    counts = checkpoint(counts)
    rows, cols = counts.groupBy("t").agg(F.sum("n").alias("nt")), counts.groupBy("s").agg(F.sum("n").alias("ns"))
    total, r, c = counts.agg(F.sum("n"), F.countDistinct("t"), F.countDistinct("s")).first()
    expected = F.col("nt") * F.col("ns") / F.lit(total)
    if r == c == 2:
        cells = rows.crossJoin(cols).join(counts, ["t", "s"], "left").na.fill(0, ["n"]).withColumn("x", expected)
        gap = F.greatest(F.abs(F.col("n") - F.col("x")) - 0.5, F.lit(0.0))
        row = cells.agg(F.sum(gap * gap / F.col("x")).alias("chi2"), F.lit(1).cast("long").alias("dof")).first()
    else:
        # A cell that is not there adds its expected count, and all expected counts are the total.
        cells = counts.join(rows, "t").join(cols, "s").withColumn("x", expected)
        there = F.sum((F.col("n") - F.col("x")) ** 2 / F.col("x")) + F.lit(total) - F.sum("x")
        row = cells.agg(F.greatest(there, F.lit(0.0)).alias("chi2"), F.lit((r - 1) * (c - 1)).cast("long").alias("dof")).first()
    stat, dof = row["chi2"], row["dof"]
    p = chi2_pvalue(stat, dof) if stat is not None and dof else None
    return df.sparkSession.createDataFrame([(target, stat, dof, p)], "target string, chi2 double, dof long, p_value double")


def chi2_pvalue(x: float, dof: int) -> float:
    """Upper tail of the chi-square law by the regularised incomplete gamma function."""
    a, h = dof / 2, x / 2
    if h <= 0:
        return 1.0
    front = math.exp(a * math.log(h) - h - math.lgamma(a))
    if h < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > 1e-16 * abs(total):
            n += 1
            term *= h / n
            total += term
        return max(0.0, 1 - front * total)
    b = h + 1 - a
    c, d = 1e300, 1 / b
    out = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * out


def drift_report(df: DataFrame, columns: Sequence[str], *, by: str = "source", first: str = "train", psi_drift: float = 0.2, alpha: float = 0.05, n_bins: int = 10) -> DataFrame:
    """PSI, KS, its p-value and a flag per column, the largest PSI first."""
    long = long_form(df, columns, by, first)
    table = psi_table(long, n_bins).join(ks_table(long), "column_name", "left")
    flag = (F.col("psi") >= psi_drift) | (F.coalesce("p_value", F.lit(1.0)) < alpha)
    return table.select("column_name", F.round("psi", 4).alias("psi"), F.round("ks", 4).alias("ks"), F.round("p_value", 4).alias("p_value"), flag.alias("drift")).orderBy(F.desc("psi"), "column_name")


def time_halves(df: DataFrame, ts: str) -> DataFrame:
    """``df`` with ``source``: train up to the median time, test after it. Rows on the median
    are train, null times have no half."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    middle = values.quantiles(df.select(at.alias("at")), ["at"], [0.5]).select(F.col("q0").alias("_middle"))  # one row
    half = F.when(at > F.col("_middle"), "test").when(at.isNotNull(), "train")
    return df.crossJoin(F.broadcast(middle)).withColumn("source", half).drop("_middle")
