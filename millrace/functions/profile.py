"""Profiles and quality reports. Every report is a tidy DataFrame, and reports that make
sense per split take ``by`` and read all splits in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.sources.scratch import checkpoint

from . import values
from .explore import per_column

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric and boolean columns."""
    return [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def _pct(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(F.when(whole == 0, 0.0).otherwise(100.0 * part / whole), digits)


def schema_table(df: DataFrame, *, exact: bool = True) -> DataFrame:
    facts = {"n_null": lambda c: F.count_if(F.col(c).isNull()), "pct_null": lambda c: _pct(F.count_if(F.col(c).isNull()), F.count("*"))}
    types = F.create_map(*[x for f in df.schema for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    table = per_column(df, df.columns, facts, label="column_name").join(F.broadcast(values.distinct_counts(df, df.columns, exact=exact)), "column_name")
    return table.withColumn("dtype", types[F.col("column_name")]).orderBy(F.desc("pct_null"), F.desc("n_distinct"), "column_name")


def describe_numeric(df: DataFrame, columns: Sequence[str], percentiles: Sequence[float] = (0.25, 0.5, 0.75), *, exact: bool = True) -> DataFrame:
    facts: dict[str, object] = {"count": F.count, "mean": lambda c: F.avg(F.col(c).cast("double")), "std": F.stddev_samp, "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double")}
    names = [f"p{round(100 * x)}" for x in percentiles]
    cuts = values.quantiles(df, columns, percentiles, exact=exact).toDF("column_name", *names)
    table = per_column(df, columns, facts, label="column_name").join(F.broadcast(cuts), "column_name")
    return table.select("column_name", "count", *[F.round(f, 4).alias(f) for f in ("mean", "std", "min", *names, "max")])


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, the most frequent value (the smallest on a tie) and its count."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("_x")).select("_x.*")
    counts = long.where("value is not null").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    first = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    top = counts.withColumn("_r", F.row_number().over(first)).where("_r = 1").select("column_name", F.col("value").alias("top"), F.col("n").alias("freq"))
    return counts.groupBy("column_name").agg(F.sum("n").alias("count"), F.count("*").alias("n_distinct")).join(F.broadcast(top), "column_name")


STATISTICS = {
    "count": lambda x: F.count(x),
    "min": lambda x: F.min(x),
    "max": lambda x: F.max(x),
    "mean": lambda x: F.round(F.avg(x), 4),
    "std": lambda x: F.round(F.stddev_samp(x), 4),
}


def basic_stats(df: DataFrame, columns: Sequence[str] | None = None, *, metrics: Sequence[str] = ("count", "min", "max", "mean", "std"), max_distinct: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Chosen statistics per column, as doubles; text that is no number counts as null.
    With ``max_distinct`` columns of more distinct values are left out."""
    columns = list(columns or numeric_columns(df))
    if max_distinct is not None and columns:
        counts = {r["column_name"]: r["n_distinct"] for r in values.distinct_counts(df, columns).collect()}  # a row per column
        columns = [c for c in columns if counts[c] <= max_distinct]
    number = lambda c: F.col(c).try_cast("double")
    return per_column(df, columns, {m: (lambda c, m=m: STATISTICS[m](number(c))) for m in metrics}, by=by, label="column_name")


def duplicates_summary(df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first") -> DataFrame:
    """Rows, duplicate rows and their share. keep "first" or "last" spares one row of each
    group, False spares none. Nulls are equal to each other."""
    groups = df.groupBy(*(subset or df.columns)).agg(F.count("*").alias("n"))
    doubled = F.sum(F.col("n") - 1) if keep else F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    row = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(doubled, F.lit(0)).alias("n_duplicates"))
    return row.withColumn("pct_duplicates", _pct(F.col("n_duplicates"), F.col("n_rows")))


def hierarchy_profile(df: DataFrame, levels: Mapping[str, str | Sequence[str]], expected: Mapping[tuple[str, str], float] | None = None) -> DataFrame:
    """Distinct keys per level, and children per parent for each pair of neighbouring levels
    (from the finest to the coarsest), with the deviation from an expected ratio."""
    names = list(levels)
    key = lambda k: F.col(k) if isinstance(k, str) else F.struct(*k)
    row = df.agg(*[F.countDistinct(key(levels[n])).alias(n) for n in names])
    facts = [F.struct(F.lit(f"n_{n}").alias("fact"), F.col(n).cast("double").alias("value"), F.lit(None).cast("double").alias("deviation")) for n in names]
    for child, parent in zip(names, names[1:]):
        ratio = F.round(F.col(child) / F.col(parent), 2)
        want = (expected or {}).get((child, parent))
        facts.append(F.struct(F.lit(f"{child}_per_{parent}").alias("fact"), ratio.alias("value"), (F.round(ratio - want, 2) if want is not None else F.lit(None).cast("double")).alias("deviation")))
    return row.select(F.explode(F.array(*facts)).alias("_x")).select("_x.*")


def column_metadata(df: DataFrame, *, threshold: int = 1000, exact: bool = True) -> DataFrame:
    """Distinct values, a low / medium / high class, and integers that are in truth categories."""
    kinds = {f.name: f.dataType for f in df.schema}
    table = values.distinct_counts(df, df.columns, exact=exact)
    n, whole = F.col("n_distinct"), F.col("column_name").isin([c for c, k in kinds.items() if isinstance(k, INTEGERS)])
    return table.select("column_name", "n_distinct", F.when(n <= 20, "low").when(n <= threshold, "medium").otherwise("high").alias("cardinality"), (whole & (n > threshold)).alias("pseudo_categorical"))


def schema_compare(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row per column of either table: both types and what differs."""
    spark = train.sparkSession
    side = lambda df, s: spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)], f"{s}_position int, column_name string, {s}_type string")
    both = side(train, "train").join(side(test, "test"), "column_name", "full_outer")
    status = F.when(F.col("test_type").isNull(), "MISSING_IN_TEST").when(F.col("train_type").isNull(), "MISSING_IN_TRAIN").when(F.col("train_type") != F.col("test_type"), "TYPE_DIFFERS").when(F.col("train_position") != F.col("test_position"), "ORDER_DIFFERS").otherwise("OK")
    return both.select("column_name", "train_type", "test_type", status.alias("status"))


def compatible(comparison: DataFrame, *, strict: bool = False, order: bool = False) -> bool:
    bad = ["MISSING_IN_TEST", "TYPE_DIFFERS"] + ["MISSING_IN_TRAIN"] * strict + ["ORDER_DIFFERS"] * order
    return comparison.where(F.col("status").isin(bad)).isEmpty()


def multi_value_frequency(df: DataFrame, column: str, *, delimiter: str = ",", max_values: int = 10, min_share: float = 0.001, top: int = 20) -> DataFrame:
    """Frequency of the values in delimited cells: cut to ``max_values`` per cell, trimmed of any
    white space, empty ones dropped; the share is of all values."""
    quoted = r"\Q" + delimiter.replace(r"\E", r"\E\\E\Q") + r"\E"
    values = df.select(F.explode(F.slice(F.split(column, quoted), 1, max_values)).alias("value"))
    values = values.select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("value")).where("value <> ''")
    counts = values.groupBy("value").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))  # one row
    shares = counts.crossJoin(F.broadcast(total)).select("value", "n", (F.col("n") / F.col("_total")).alias("share"))
    return shares.where(F.col("share") >= min_share).orderBy(F.desc("n"), "value").limit(top).withColumn("share", F.round("share", 6))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("_x")).select("_x.*").groupBy("column_name", "value").agg(F.count("*").alias("n"))


def top_values(df: DataFrame, columns: Sequence[str], top: int = 20, *, nulls: bool = False) -> DataFrame:
    """The most frequent values per column; ties by value."""
    counts = value_counts(df, columns)
    if not nulls:
        counts = counts.where("value is not null")
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def cardinality_profile(df: DataFrame, columns: Sequence[str], *, top: int = 20, flag_above: int = 10_000) -> DataFrame:
    """The most frequent values of each column with its distinct count, from one table of counts."""
    counts = value_counts(df, columns).where("value is not null")
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    sizes = counts.groupBy("column_name").agg(F.count("*").alias("n_distinct"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(sizes.withColumn("over_threshold", F.col("n_distinct") > flag_above)), "column_name")


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Counts per class, null being one, with the share, the number of texts that say "none" and
    the ratio of the largest to the smallest class."""
    counts = df.groupBy(F.col(target).cast("string").alias("value")).agg(F.count("*").alias("n"))
    none = F.sum(F.when(F.lower("value") == "none", F.col("n")).otherwise(0)).alias("n_none_text")
    whole = counts.agg(F.sum("n").alias("_total"), none, F.round(F.max("n") / F.min("n"), 4).alias("imbalance_ratio"))  # one row
    return counts.crossJoin(F.broadcast(whole)).select("value", "n", F.round(F.col("n") / F.col("_total"), 6).alias("share"), "n_none_text", "imbalance_ratio")


def id_columns(df: DataFrame, patterns: Sequence[str], min_uniqueness: float = 0.95, *, exact: bool = True) -> DataFrame:
    """Columns whose name ends as a pattern says, and those with nearly unique values."""
    ends = tuple(p.lstrip("*") for p in patterns)
    named = [c for c in df.columns if c.endswith(ends)]
    table = values.distinct_counts(df, df.columns, exact=exact).crossJoin(df.agg(F.count("*").alias("n_rows")))  # one row
    table = table.withColumn("uniqueness", F.round(F.col("n_distinct") / F.col("n_rows"), 4))
    by_name, unique = F.col("column_name").isin(named), F.col("uniqueness") >= min_uniqueness
    return table.select("column_name", "uniqueness", by_name.alias("by_name"), unique.alias("by_uniqueness")).where("by_name or by_uniqueness")


def conditional_sparsity(df: DataFrame, entity: str, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Null share in percent of the columns that each entity type should fill."""
    every = sorted({c for cs in columns.values() for c in cs})
    facts = {"pct_null": lambda c: F.round(100.0 * F.avg(F.col(c).isNull().cast("int")), 2)}
    table = per_column(df.where(F.col(entity).isNotNull()), every, facts, by=[entity], label="column_name")
    spec = df.sparkSession.createDataFrame([(e, c) for e, cs in columns.items() for c in cs], f"{entity} string, column_name string")
    return table.join(F.broadcast(spec), [entity, "column_name"])


def completeness_report(df: DataFrame, *, include: Sequence[str] = ("*",), top: int = 50) -> DataFrame:
    """Null counts of the columns with most nulls, and of all cells (column_name null)."""
    columns = [c for c in df.columns if any(fnmatchcase(c, p) for p in include)]
    table = per_column(df, columns, {"n_null": lambda c: F.count_if(F.col(c).isNull()), "n_rows": lambda c: F.count("*")}, label="column_name")
    table = table.withColumn("pct_null", _pct(F.col("n_null"), F.col("n_rows")))
    total = table.agg(F.lit(None).cast("string").alias("column_name"), F.sum("n_null").alias("n_null"), F.sum("n_rows").alias("n_rows")).withColumn("pct_null", _pct(F.col("n_null"), F.col("n_rows")))
    return table.orderBy(F.desc("n_null"), "column_name").limit(top).unionByName(total)


def missingness_top(df: DataFrame, top: int) -> DataFrame:
    return completeness_report(df, top=top).where("column_name is not null").orderBy(F.desc("n_null"), "column_name")


def sentinel_counts(df: DataFrame, columns: Sequence[str], sentinels: Sequence[object]) -> DataFrame:
    pairs = [(c, s) for c in columns for s in sentinels]
    row = df.agg(*[F.count_if(F.col(c) == F.lit(s)).alias(f"_{i}") for i, (c, s) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(str(s)).alias("sentinel"), F.col(f"_{i}").alias("n")) for i, (c, s) in enumerate(pairs)])
    return row.select(F.explode(cells).alias("_x")).select("_x.*").where("n > 0")


def leakage_crosstab(df: DataFrame, target: str, suspects: Sequence[str], *, normalize: str = "index", threshold: float = 0.95) -> DataFrame:
    """The largest conditional share of the target per suspect column, and the rows behind it."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), F.col(target).cast("string").alias("target")) for c in suspects])
    counts = df.select(F.explode(cells).alias("_x")).select("_x.*").where("value is not null and target is not null").groupBy("column_name", "value", "target").agg(F.count("*").alias("n"))
    over = {"index": ["column_name", "value"], "columns": ["column_name", "target"], "all": ["column_name"]}[normalize]
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*over)))
    order = Window.partitionBy("column_name").orderBy(F.desc("share"), F.desc("n"), "value", "target")
    best = shares.withColumn("_r", F.row_number().over(order)).where("_r = 1")
    return best.select("column_name", "value", "target", F.round("share", 6).alias("max_share"), F.col("n").alias("support"), (F.col("share") >= threshold).alias("leak"))


def post_event_columns(df: DataFrame, suspects: Sequence[str], min_missing: float = 0.9) -> DataFrame:
    share = lambda c: F.avg(F.col(c).isNull().cast("int"))
    return per_column(df, suspects, {"missing_share": share}, label="column_name").where(F.col("missing_share") >= min_missing).withColumn("missing_share", F.round("missing_share", 6))


def timestamp_range(df: DataFrame, ts: str, min_days: int) -> DataFrame:
    """First, last and whole days of elapsed time; values that are no time count as invalid."""
    at = F.col(ts) if not isinstance(df.schema[ts].dataType, T.StringType) else F.try_to_timestamp(ts)
    row = df.select(at.cast("timestamp").alias("t"), F.col(ts).alias("raw")).agg(F.min("t").alias("a"), F.max("t").alias("z"), F.count_if(F.col("t").isNull() & F.col("raw").isNotNull()).alias("n_invalid"))
    days = F.floor((F.unix_micros("z") - F.unix_micros("a")) / 86_400_000_000)
    reason = F.when(F.col("a").isNull(), "no valid timestamp").when(days < min_days, "range too short")
    return row.select(F.col("a").cast("timestamp_ntz").alias("first_ts"), F.col("z").cast("timestamp_ntz").alias("last_ts"), days.cast("long").alias("n_days"), "n_invalid", F.coalesce(days >= min_days, F.lit(False)).alias("valid"), reason.alias("reason"))


def column_catalog(df: DataFrame, roles: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per column and role; columns without a role have role ``uncategorized``. A pattern may end in *."""
    rows = [(c, r) for c in df.columns for r in ([r for r, ps in roles.items() if any(fnmatchcase(c, p) for p in ps)] or ["uncategorized"])]
    return df.sparkSession.createDataFrame(rows, "column_name string, role string")


def numeric_histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the range, each closed on the left, the last on both sides; empty
    bins are listed."""
    x = F.col(column).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).where("lo is not null")
    width = (F.col("hi") - F.col("lo")) / bins
    grid = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.col("lo"), width.alias("width"))
    edges = grid.select("bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"), (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("right_edge"))
    ratio = F.when(F.col("hi") == F.col("lo"), F.lit(0.0)).otherwise((F.col("x") - F.col("lo")) / F.when(width == 0, 1.0).otherwise(width))
    guess = F.least(F.lit(bins - 1), F.floor(ratio))
    # The floor can be off by one at an edge; what counts is the comparison with the edges.
    exact = F.when((guess > 0) & (F.col("x") < F.col("lo") + guess * width), guess - 1).when((guess < bins - 1) & (F.col("x") >= F.col("lo") + (guess + 1) * width), guess + 1).otherwise(guess)
    counts = df.where(x.isNotNull()).select(x.alias("x")).crossJoin(F.broadcast(ends)).groupBy(exact.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return edges.join(counts, "bin", "left").select("bin", F.round("left_edge", 4).alias("left_edge"), F.round("right_edge", 4).alias("right_edge"), F.coalesce("n", F.lit(0)).alias("n"))


def time_counts(df: DataFrame, ts: str, rule: str = "day") -> DataFrame:
    """Rows per time bucket between the first and the last, empty buckets included."""
    counts = df.where(F.col(ts).isNotNull()).groupBy(F.date_trunc(rule, ts).cast("timestamp_ntz").alias("bucket")).agg(F.count("*").alias("n"))
    grid = counts.agg(F.min("bucket").alias("a"), F.max("bucket").alias("z")).where("a is not null").select(F.explode(F.expr(f"sequence(a, z, interval 1 {rule})")).alias("bucket"))
    return grid.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


#: Cells of a crosstab up to which empty ones are listed.
MOST_CELLS = 1_000_000


def full_grid(counts: DataFrame, a: str, b: str, most: int | None = None) -> DataFrame:
    """``counts`` (``a, b, n``) with a row of 0 for each pair that is missing. Over ``most`` pairs
    (``MOST_CELLS``) the missing ones are left out: nobody reads such a table, and joins take them as 0."""
    counts = checkpoint(counts)
    rows, cols = counts.select(a).distinct(), counts.select(b).distinct()
    if rows.count() * cols.count() > (MOST_CELLS if most is None else most):
        return counts
    same = [F.col(c).eqNullSafe(F.col(f"_mr_{c}")) for c in (a, b)]
    there = counts.withColumnsRenamed({a: f"_mr_{a}", b: f"_mr_{b}"})
    return rows.crossJoin(F.broadcast(cols)).join(there, same[0] & same[1], "left").drop(f"_mr_{a}", f"_mr_{b}").na.fill(0, ["n"])


def target_by_category(df: DataFrame, target: str, group: str) -> DataFrame:
    """Crosstab in long form, rows with a null left out, empty cells zero (``full_grid``)."""
    counts = df.where(F.col(target).isNotNull() & F.col(group).isNotNull()).groupBy(group, target).agg(F.count("*").alias("n"))
    return full_grid(counts, group, target)


def hour_stats(df: DataFrame, ts: str) -> DataFrame:
    h = F.hour(ts)
    return df.agg(F.count("*").alias("n_rows"), F.round(F.avg(h), 6).alias("mean_hour"), F.round(F.stddev_samp(h), 6).alias("std_hour"), F.min(h).alias("min_hour"), F.max(h).alias("max_hour"))


def residuals(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.withColumn("residual", F.col(truth) - F.col(predicted))


def over_null_threshold(report: DataFrame, pct: float) -> DataFrame:
    return report.where((F.col("pct_null") > pct) & F.col("column_name").isNotNull())


def top_cardinality(df: DataFrame, top: int = 15) -> DataFrame:
    return column_metadata(df).orderBy(F.desc("n_distinct"), "column_name").limit(top)


# Statistics of splits --------------------------------------------------------------------------


MOMENTS = "split string, column_name string, position int, dtype string, n_rows long, n_known long, mean double, m2 double, least string, largest string"


def split_moments(df: DataFrame, split: str | Column) -> DataFrame:
    """One row per split and column: rows, known values, and of numeric (and boolean) columns the mean
    and the sum of squared deviations, with the least and the largest value as text where values have an
    order. One pass over all columns. Such tables are small, can be saved and merged, and compared later
    without the data. ``split`` is a column, which is then no column of the report, or an expression."""
    by = F.col(split) if isinstance(split, str) else split
    fields = [f for f in df.schema if not (isinstance(split, str) and f.name == split)]
    if not fields:
        raise ValueError("no columns")
    aggs = []
    for i, f in enumerate(fields):
        c = F.col(values.quoted(f.name))
        number = c.cast("int") if isinstance(f.dataType, T.BooleanType) else c
        numeric = isinstance(f.dataType, (T.NumericType, T.BooleanType))
        ordered = isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, (T.BinaryType, T.VariantType))
        aggs += [F.count(c).alias(f"k{i}"), (F.avg(number.cast("double")) if numeric else F.first(F.lit(None).cast("double"))).alias(f"m{i}")]
        aggs.append((F.var_pop(number.cast("double")) * F.count(c) if numeric else F.first(F.lit(None).cast("double"))).alias(f"v{i}"))
        aggs += [(g(c).cast("string") if ordered else F.first(F.lit(None).cast("string"))).alias(f"{n}{i}") for n, g in (("l", F.min), ("h", F.max))]
    wide = df.groupBy(by.cast("string").alias("split")).agg(F.count("*").alias("n_rows"), *aggs)
    cells = [F.struct(F.lit(f.name).alias("column_name"), F.lit(i).alias("position"), F.lit(f.dataType.simpleString()).alias("dtype"), "n_rows", F.col(f"k{i}").alias("n_known"), F.col(f"m{i}").alias("mean"), F.col(f"v{i}").alias("m2"), F.col(f"l{i}").alias("least"), F.col(f"h{i}").alias("largest")) for i, f in enumerate(fields)]
    return wide.select("split", F.explode(F.array(*cells)).alias("_x")).select("split", "_x.*")


def merge_moments(*tables: DataFrame) -> DataFrame:
    """The moments of the rows of all ``tables`` (of ``split_moments``) together, as if made in one pass; least and
    largest values are dropped, as text has another order than numbers."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    n, mean = F.col("n_known"), F.col("mean")
    total = F.sum(n)
    center = F.sum(n * mean) / F.nullif(F.sum(F.when(mean.isNotNull(), n)), F.lit(0))
    # Deviations from the common mean: those within each part, and those of its mean.
    sums = every.groupBy("split", "column_name").agg(F.min("position").alias("position"), F.min("dtype").alias("dtype"), F.sum("n_rows").alias("n_rows"), total.alias("n_known"), center.alias("mean"), F.collect_list(F.when(mean.isNotNull(), F.struct("n_known", "mean", "m2"))).alias("_parts"))
    m2 = F.aggregate("_parts", F.lit(0.0), lambda s, p: s + p["m2"] + p["n_known"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")))
    return sums.select("split", "column_name", "position", "dtype", "n_rows", "n_known", "mean", F.when(F.col("mean").isNotNull(), m2).alias("m2"), F.lit(None).cast("string").alias("least"), F.lit(None).cast("string").alias("largest"))


def compare_splits(moments: DataFrame, first: str = "train", second: str = "test") -> DataFrame:
    """The columns of two splits side by side: ``column_name, status`` (BOTH, TYPE_DIFFERS, ONLY_<split>), and for
    each split ``n_rows, n_known, mean, std`` (of a sample), then ``mean_diff, std_diff, known_share_diff`` (second
    less first) and ``standardised_diff``, the difference of the means by the root of the mean variance.
    Works on saved tables of ``split_moments``; the data are not read."""
    n, dev = F.col("n_known"), F.sqrt(F.col("m2") / F.nullif(F.col("n_known") - 1, F.lit(0)))
    side = lambda name, tag: moments.where(F.col("split") == name).select("column_name", F.col("dtype").alias(f"t_{tag}"), F.col("n_rows").alias(f"n_rows_{tag}"), n.alias(f"n_known_{tag}"), F.col("mean").alias(f"mean_{tag}"), dev.alias(f"std_{tag}"))
    both = side(first, "first").join(side(second, "second"), "column_name", "full")
    a, b = F.col("t_first"), F.col("t_second")
    status = F.when(b.isNull(), f"ONLY_{first.upper()}").when(a.isNull(), f"ONLY_{second.upper()}").when(a != b, "TYPE_DIFFERS").otherwise("BOTH")
    gap = F.col("mean_second") - F.col("mean_first")
    spread = F.sqrt((F.col("std_first") ** 2 + F.col("std_second") ** 2) / 2)
    share = F.col("n_known_second") / F.nullif("n_rows_second", F.lit(0)) - F.col("n_known_first") / F.nullif("n_rows_first", F.lit(0))
    facts = [f"{x}_{tag}" for tag in ("first", "second") for x in ("n_rows", "n_known", "mean", "std")]
    return both.select("column_name", status.alias("status"), *facts, gap.alias("mean_diff"), (F.col("std_second") - F.col("std_first")).alias("std_diff"), share.alias("known_share_diff"), (gap / F.nullif(spread, F.lit(0.0))).alias("standardised_diff"))
