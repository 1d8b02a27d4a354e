"""Feature preparation: fit on one table, apply unchanged to others.

``Prepare(operation, **settings)`` is an Estimator. ``fit`` runs one or two aggregations and
keeps what it learnt in a ``Prepared`` model, whose ``transform`` is column expressions or a
join. Both are saved and loaded as stages of an ordinary ml Pipeline. With ``mask``, a boolean
column, rows where it is true are left out of the fit and transformed like all others. What depends
on data (which columns to flag, drop or fill) is decided in ``fit``, so every table that a
model transforms gets the same columns.
"""

from __future__ import annotations

import json
import unicodedata
import uuid
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions import values
from millrace.functions.values import quoted
from millrace.sources.scratch import checkpoint, hot_keys, scratch, spread_join

#: A fitted lookup table of more values than this stays a table, which is saved with the model.
MAX_VALUES = 100_000
#: Lookup tables of up to this many values are expressions, larger ones broadcast joins.
MAP_VALUES = 100


class _Saved(Params):
    operation = Param(Params._dummy(), "operation", "name of the preparation", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "its settings, as JSON", TypeConverters.toString)


class _Writer(DefaultParamsWriter):
    """Parameters, and the fitted table if there is one."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if "table" in self.instance.learnt:
            self.sparkSession.read.parquet(self.instance.learnt["table"]).write.parquet(f"{path}/table")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> Prepared:
        made = super().load(path)
        return made._set(state=json.dumps(made.learnt | {"table": f"{path}/table"})) if "table" in made.learnt else made


class Prepared(_Saved, Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "what was learnt, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, operation: str = None, settings: str = None, state: str = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    @property
    def learnt(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def _transform(self, df: DataFrame) -> DataFrame:
        _, apply = OPERATIONS[self.getOrDefault(self.operation)]
        return apply(df, self.learnt, **json.loads(self.getOrDefault(self.settings)))


class Prepare(_Saved, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, operation: str = "", **settings):
        super().__init__()
        if operation:
            if operation not in OPERATIONS:
                raise ValueError(f"operation: {operation}")
            self._set(operation=operation, settings=json.dumps(settings))

    def _fit(self, df: DataFrame) -> Prepared:
        name, given = self.getOrDefault(self.operation), json.loads(self.getOrDefault(self.settings))
        mask = given.pop("mask", None)
        learn, _ = OPERATIONS[name]
        # Rows with a true mask teach nothing; the mask itself is no feature.
        some = df if mask is None else df.where(~F.coalesce(F.col(quoted(mask)), F.lit(False))).drop(mask)
        return Prepared(operation=name, settings=json.dumps(given), state=json.dumps(learn(some, **given)))


def _shares(df: DataFrame, columns: Sequence[str], *, nulls_count: bool, least: float = 0.0) -> dict:
    """``{"values": {column: {value: share}}}`` of the values with a share of ``least`` or more; if
    they are many, ``{"table": folder}`` of ``c, v, share`` in the shared folder."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    counts = checkpoint(df.select(F.explode(cells).alias("x")).select("x.*").groupBy("c", "v").agg(F.count("*").alias("n")))
    totals = counts.where(F.lit(nulls_count) | F.col("v").isNotNull()).groupBy("c").agg(F.sum("n").alias("total"))  # a row per column
    shares = counts.where("v is not null").join(F.broadcast(totals), "c").select("c", "v", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= least)
    path = scratch(df.sparkSession, "fitted")
    shares.write.parquet(path)
    kept = df.sparkSession.read.schema(shares.schema).parquet(path)
    if kept.count() > MAX_VALUES:
        return {"table": path}
    made: dict[str, dict[str, float]] = {c: {} for c in columns}
    for r in sorted(kept.collect()):
        made[r["c"]][r["v"]] = r["share"]
    return {"values": made}


def _fitted(df: DataFrame, state: Mapping, column: str) -> Mapping[str, float] | DataFrame:
    """What ``_shares`` has kept for a column, in either form."""
    if "table" not in state:
        return state["values"][column]
    return df.sparkSession.read.parquet(state["table"]).where(F.col("c") == column).select(F.col("v").alias("_key"), F.col("share").alias("_value"), F.col("share").alias("_share"))


def _lookup(df: DataFrame, column: str, table: Mapping[str, object] | DataFrame, kind: str, out: str, then: Callable[[Column], Column]) -> DataFrame:
    """``out`` = then(value found for ``column`` in the table, or null)."""
    if not isinstance(table, DataFrame) and len(table) <= MAP_VALUES:
        pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v).cast(kind))]
        found = F.create_map(*pairs)[F.col(column).cast("string")] if pairs else F.lit(None).cast(kind)
        return df.withColumn(out, then(found))
    keyed = df.withColumn("_key", F.col(column).cast("string"))
    if isinstance(table, DataFrame):
        joined = spread_join(keyed, table.select("_key", "_value"), ["_key"], _frequent(table))
    else:
        joined = keyed.join(F.broadcast(df.sparkSession.createDataFrame(list(table.items()), f"_key string, _value {kind}")), "_key", "left")
    return joined.withColumn(out, then(F.col("_value"))).drop("_key", "_value")


def _frequent(table: DataFrame, most: int = 1000) -> DataFrame | None:
    """Of a fitted table with the share of each value, the values with over one in ``most`` rows."""
    if "_share" not in table.columns:
        return None
    hot = checkpoint(table.where(F.col("_share") > 1 / most).select("_key", F.ceil(F.col("_share") * most).cast("int").alias("parts")))
    return None if hot.isEmpty() else hot


# Sentinels above a threshold


def _learn_sentinels(df, thresholds, keep_original=True):
    use = {c: t for c, t in thresholds.items() if c in df.columns and not c.endswith("_real")}
    row = df.agg(*[F.coalesce(F.max(F.col(c) > t), F.lit(False)).alias(c) for c, t in use.items()]).first() if use else {}
    return {"found": [c for c in use if row[c]]}


def _apply_sentinels(df, state, thresholds, keep_original=True):
    for c in state["found"]:
        above = F.coalesce(F.col(c) > thresholds[c], F.lit(False))
        if keep_original:
            df = df.withColumn(f"{c}_real", F.col(c).cast("long"))
        df = df.withColumn(f"{c}_is_missing", above.cast("int")).withColumn(c, F.when(~above, F.col(c)))
    return df


# Columns that say nothing


def _learn_constant(df, threshold=1):
    """Least and greatest value and the nulls tell columns of one value, and of two. Only columns that may
    still have ``threshold`` values or fewer are counted, and those by value only if an estimate
    does not rule them out."""
    kinds, columns = {f.name: f.dataType for f in df.schema}, df.columns
    ordered = [c for c in columns if not _has_map(kinds[c])]
    facts = df.agg(
        *[F.coalesce(F.max(F.col(quoted(c)).isNull().cast("int")), F.lit(0)).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.coalesce(F.min(quoted(c)).eqNullSafe(F.max(quoted(c))), F.lit(True)).alias(f"s{i}") for i, c in enumerate(columns) if c in ordered],
        *[F.count(quoted(c)).alias(f"k{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(quoted(c), 0.05).alias(f"a{i}") for i, c in enumerate(columns) if threshold > 1 and c in ordered],
    ).first()
    drop, open_ = [], []
    for i, c in enumerate(columns):
        null = facts[f"n{i}"]
        if c in ordered and (not facts[f"k{i}"] or facts[f"s{i}"]):
            n = null + (1 if facts[f"k{i}"] else 0)
            drop += [c] * (n <= threshold)
        elif c not in ordered or threshold >= 2 + null and facts[f"a{i}"] <= 2 * threshold + 10:
            open_.append((c, null))
    if open_:
        some = {r["column_name"]: r["n_distinct"] for r in values.distinct_counts(df, [c for c, _ in open_]).collect()}  # a row per column
        drop += [c for c, null in open_ if some[c] + null <= threshold]
    return {"drop": sorted(drop, key=columns.index)}


def _has_map(kind: T.DataType) -> bool:
    """Values of such types have no order."""
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return _has_map_in(kind) if isinstance(kind, T.StructType) else isinstance(kind, (T.MapType, T.VariantType))


def _has_map_in(kind: T.StructType) -> bool:
    return any(_has_map(f.dataType) for f in kind.fields)


def _learn_duplicates(df):
    """Candidates agree in type, count, distinct count, least and greatest value; then all rows are compared."""
    prints = df.agg(*[F.concat_ws("|", F.count(c), F.approx_count_distinct(c, 0.01), F.coalesce(F.min(c).cast("string"), F.lit("")), F.coalesce(F.max(c).cast("string"), F.lit(""))).alias(c) for c in df.columns]).first()
    kinds = dict(df.dtypes)
    pairs = [(a, b) for i, b in enumerate(df.columns) for a in df.columns[:i] if prints[a] == prints[b] and kinds[a] == kinds[b]]
    if not pairs:
        return {"drop": []}
    same = df.agg(*[F.coalesce(F.bool_and(F.col(a).eqNullSafe(F.col(b))), F.lit(True)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]).first()
    return {"drop": sorted({b for i, (_, b) in enumerate(pairs) if same[f"_{i}"]}, key=df.columns.index)}


def _apply_drop(df, state, **_):
    return df.drop(*state["drop"])


# Imputation


def _learn_median(df, columns=None, exclude=()):
    kinds = {f.name: f.dataType for f in df.schema}
    use = [c for c in (columns or [c for c, k in kinds.items() if isinstance(k, T.NumericType)]) if c in kinds and c not in exclude]
    if not use:
        return {"fill": {}}
    row = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(f"_{i}") for i, c in enumerate(use)]).first()
    some = [c for i, c in enumerate(use) if row[f"_{i}"]]
    medians = {r["column_name"]: r["q0"] for r in values.quantiles(df, some, [0.5]).collect()} if some else {}  # a row per column
    return {"fill": {c: m for c, m in medians.items() if m is not None}}


def _apply_fill(df, state, **_):
    for c in state.get("flags", []):
        df = df.withColumn(f"{c}_is_missing", F.col(c).isNull().cast("int"))
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in state["fill"].items()}) if state["fill"] else df


def _learn_mode(df, columns=None, exclude=(), flag=True, always_flag=()):
    kinds = {f.name: f.dataType for f in df.schema}
    use = [c for c in (columns or [c for c, k in kinds.items() if isinstance(k, T.StringType)]) if c in kinds and c not in exclude]
    if not use:
        return {"fill": {}, "flags": []}
    row = df.agg(*[F.mode(c, True).alias(c) for c in use], *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in use]).first()
    with_nulls = [c for c in use if row[f"_n_{c}"]]
    return {"fill": {c: row[c] for c in with_nulls if row[c] is not None}, "flags": [c for c in use if c in always_flag or flag and c in with_nulls]}


# Categories


def _learn_rare(df, columns, min_freq=0.002, other="OTHER"):
    return _shares(df, columns, nulls_count=True, least=min_freq)


def _apply_rare(df, state, columns, min_freq=0.002, other="OTHER"):
    for c in columns:
        own = F.col(c).cast("string") if isinstance(other, str) else F.col(c)
        df = _lookup(df, c, _fitted(df, state, c), "double", c, lambda known, own=own: F.when(known.isNotNull(), own).when(own.isNotNull(), other))
    return df


def _learn_frequency(df, columns, fill=0.0, cast="double", suffix="_freq"):
    return _shares(df, columns, nulls_count=False)


def _apply_frequency(df, state, columns, fill=0.0, cast="double", suffix="_freq"):
    for c in columns:
        df = _lookup(df, c, _fitted(df, state, c), "double", c + suffix, lambda s: F.coalesce(s, F.lit(fill)).cast(cast))
    return df


def _apply_ordinal(df, state, orders, suffix="_ord"):
    for c, order in orders.items():
        if c in df.columns:
            df = _lookup(df, c, {v: i for i, v in enumerate(order)}, "int", c + suffix, lambda i: F.coalesce(i, F.lit(-1)))
    return df


def _slots(df, columns, min_freq):
    """``{"values": {column: {value: slot}}}``, slots in the order of the values; or a table of ``c, v, slot``."""
    state = _shares(df, columns, nulls_count=False, least=min_freq)
    if "values" in state:
        return {"values": {c: {v: i for i, v in enumerate(sorted(found))} for c, found in state["values"].items()}, "sizes": {c: len(found) for c, found in state["values"].items()}}
    shares = df.sparkSession.read.parquet(state["table"])
    ranged = checkpoint(shares.repartitionByRange("c", "v").withColumn("_p", F.spark_partition_id()))
    counts = sorted((r["c"], r["_p"], r["n"]) for r in ranged.groupBy("c", "_p").agg(F.count("*").alias("n")).collect())  # a row a task and column
    starts = [(c, p, sum(n for d, q, n in counts if d == c and q < p)) for c, p, _ in counts]
    starts = df.sparkSession.createDataFrame(starts, "c string, _p int, _start long")
    at = F.row_number().over(Window.partitionBy("c", "_p").orderBy("v")) - 1 + F.col("_start")
    path = scratch(df.sparkSession, "fitted")
    ranged.join(F.broadcast(starts), ["c", "_p"]).select("c", "v", at.cast("int").alias("slot"), "share").write.parquet(path)
    sizes = {c: sum(n for d, _, n in counts if d == c) for c in columns}
    return {"table": path, "sizes": sizes}


def _learn_one_hot(df, columns, out="one_hot", min_freq=0.0):
    return _slots(df, columns, min_freq)


def _apply_one_hot(df, state, columns, out="one_hot", min_freq=0.0):
    """One vector, sparse where that is smaller: for each column a slot per fitted value, then one for
    all other values, null among them."""
    slots = []
    for i, c in enumerate(columns):
        if "table" in state:
            fitted = df.sparkSession.read.parquet(state["table"]).where(F.col("c") == c).select(F.col("v").alias("_key"), F.col("slot").alias("_value"), F.col("share").alias("_share"))
        else:
            fitted = state["values"][c]
        size = state["sizes"][c]
        df = _lookup(df, c, fitted, "int", f"_mr_slot{i}", lambda s, size=size: F.coalesce(s, F.lit(size)).cast("double"))
        # With the number of slots in its metadata a column is encoded without a look at the data.
        df = df.withMetadata(f"_mr_slot{i}", {"ml_attr": {"type": "nominal", "name": f"_mr_slot{i}", "num_vals": size + 1}})
        slots.append(f"_mr_slot{i}")
    hot = [f"_mr_hot{i}" for i in range(len(columns))]
    made = OneHotEncoder(inputCols=slots, outputCols=hot, dropLast=False).fit(df).transform(df)
    return VectorAssembler(inputCols=hot, outputCol=out).transform(made).drop(*slots, *hot)


def _target_sums(df, columns, target, fold):
    """``c, v, fold, s, n`` of the rows with a target; null values are left out of ``v`` and count for ``total``."""
    y = F.col(quoted(target)).cast("double")
    cells = F.array(F.struct(F.lit(None).cast("string").alias("c"), F.lit(None).cast("string").alias("v")), *[F.struct(F.lit(c).alias("c"), F.col(quoted(c)).cast("string").alias("v")) for c in columns])
    rows = df.where(y.isNotNull()).select(fold.alias("fold"), y.alias("y"), F.explode(cells).alias("_x")).select("fold", "y", "_x.*")
    return rows.where("c is null or v is not null").groupBy("c", "v", "fold").agg(F.sum("y").alias("s"), F.count("*").alias("n"))


def _learn_target(df, columns, target, smoothing=20.0, suffix="_target"):
    sums = checkpoint(_target_sums(df, columns, target, F.lit(0)), release=True)
    s, n = sums.where("c is null").agg(F.sum("s"), F.sum("n")).first()
    if not n:
        return {"values": {c: {} for c in columns}, "prior": None}
    prior = s / n
    value = (F.col("s") + smoothing * prior) / (F.col("n") + smoothing)
    known = sums.where("c is not null")
    if known.count() <= MAX_VALUES:
        made = {c: {} for c in columns}
        for r in known.select("c", "v", value.alias("x")).collect():
            made[r["c"]][r["v"]] = r["x"]
        return {"values": made, "prior": prior}
    path = scratch(df.sparkSession, "fitted")
    known.select("c", "v", value.alias("x"), (F.col("n") / n).alias("share")).write.parquet(path)
    return {"table": path, "prior": prior}


def _apply_target(df, state, columns, target, smoothing=20.0, suffix="_target"):
    """The smoothed mean of the target by value, of the whole fitted table; new and null values get its mean."""
    for c in columns:
        if "table" in state:
            fitted = df.sparkSession.read.parquet(state["table"]).where(F.col("c") == c).select(F.col("v").alias("_key"), F.col("x").alias("_value"), F.col("share").alias("_share"))
        else:
            fitted = state["values"][c]
        df = _lookup(df, c, fitted, "double", c + suffix, lambda x: F.coalesce(x, F.lit(state["prior"]).cast("double")))
    return df


def target_encode_folds(df: DataFrame, columns: Sequence[str], target: str, fold: str | Column, *, smoothing: float = 20.0, suffix: str = "_target") -> DataFrame:
    """The table that a target encoding is fitted on, encoded out of fold: each row gets the smoothed mean
    of its value over the rows of the other folds, so its own target has no part in it. ``fold``
    is a column or a deterministic expression, such as ``pmod(xxhash64(key), 5)``. New tables are encoded by
    ``Prepare("target_encode", ...)``.

    The value v of a row in fold f becomes (S + m * mean) / (N + m), with S and N the sum and number of
    targets of v outside f, mean that of all rows outside f and m the ``smoothing``. Null values, and
    values found in one fold only, get that mean; null targets teach nothing; with a single fold
    everything is null. A column of very many values is joined in parts.
    """
    fold = F.coalesce((F.col(fold) if isinstance(fold, str) else fold).cast("string"), F.lit(""))
    sums = checkpoint(_target_sums(df, columns, target, fold), release=True)
    folds = sums.where("c is null").select("fold", F.col("s").alias("fs"), F.col("n").alias("fn"))
    whole = folds.agg(F.sum("fs"), F.sum("fn")).first()
    if not whole[1]:
        return df.withColumns({c + suffix: F.lit(None).cast("double") for c in columns})
    outside = folds.select(F.col("fold").alias("_mr_fold"), F.lit(True).alias("_mr_known"), ((F.lit(whole[0]) - F.col("fs")) / F.nullif(F.lit(whole[1]) - F.col("fn"), F.lit(0))).alias("_mr_prior"))
    out = df.withColumn("_mr_fold", fold).join(F.broadcast(outside), "_mr_fold", "left")  # a row per fold
    # A fold without targets has all others outside.
    out = out.withColumn("_mr_prior", F.when(F.col("_mr_known"), F.col("_mr_prior")).otherwise(whole[0] / whole[1])).drop("_mr_known")
    own = sums.where("c is not null")
    whole = own.groupBy("c", "v").agg(F.sum("s").alias("vs"), F.sum("n").alias("vn"))
    for c in columns:
        mine = own.where(F.col("c") == c)
        sides = checkpoint(whole.where(F.col("c") == c).select(F.col("v").alias("_key"), "vs", "vn"), release=True)
        n = sides.count()
        hot = None if n <= MAX_VALUES else hot_keys(sides.withColumnRenamed("vn", "n"), ["_key"])
        keyed = out.withColumn("_key", F.col(quoted(c)).cast("string"))
        keyed = spread_join(keyed, sides, ["_key"], hot, broadcast=n <= MAX_VALUES)
        parts = checkpoint(mine.select(F.col("v").alias("_key"), F.col("fold").alias("_mr_fold"), "s", "n"), release=True)
        few = parts.count() <= MAX_VALUES
        keyed = spread_join(keyed, parts, ["_key", "_mr_fold"], None if few else hot_keys(parts, ["_key", "_mr_fold"]), broadcast=few)
        s, m = F.col("vs") - F.coalesce("s", F.lit(0.0)), F.col("vn") - F.coalesce("n", F.lit(0))
        made = F.when(F.coalesce(m, F.lit(0)) > 0, (s + smoothing * F.col("_mr_prior")) / (m + smoothing)).otherwise(F.col("_mr_prior"))
        out = keyed.withColumn(c + suffix, made).drop("_key", "vs", "vn", "s", "n")
    return out.drop("_mr_fold", "_mr_prior")


# Numbers


def _learn_scale(df, columns):
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {"scale": {c: [row[f"m{i}"], row[f"s{i}"] or 1.0] for i, c in enumerate(columns) if row[f"m{i}"] is not None}}


def _apply_scale(df, state, columns):
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in state["scale"].items()})


def _learn_iqr(df, columns, k=1.5):
    found = {r["column_name"]: (r["q0"], r["q1"]) for r in values.quantiles(df, columns, [0.25, 0.75]).collect()}  # a row per column
    return {"bounds": {c: [q1 - k * (q3 - q1), q3 + k * (q3 - q1)] for c, (q1, q3) in found.items() if q1 is not None}}


def _apply_iqr(df, state, columns, k=1.5):
    """Values beyond k interquartile ranges from the quartiles become the bound; nulls stay."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(F.col(quoted(c)).isNotNull(), F.greatest(F.least(F.col(quoted(c)).cast("double"), F.lit(hi)), F.lit(lo))).cast("double" if kinds[c] != "float" else "float") for c, (lo, hi) in state["bounds"].items()})


def _learn_schema(df, casts=None, drop=()):
    return {"columns": [[f.name, (casts or {}).get(f.name, f.dataType.simpleString())] for f in df.schema if f.name not in drop]}


def _apply_schema(df, state, casts=None, drop=()):
    """Columns of the fitted table in its order and types: missing ones null, others left out."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in state["columns"]])


def _learn_vector(df, exclude=(), columns=None, out="features"):
    kinds = {f.name: f.dataType for f in df.schema}
    return {"inputs": [c for c in (columns or kinds) if c not in exclude and isinstance(kinds[c], (T.NumericType, T.BooleanType))]}


def _apply_vector(df, state, exclude=(), columns=None, out="features"):
    """One array of floats in the order of the inputs; nulls are 0, booleans 0 or 1."""
    kinds = dict(df.dtypes)
    number = lambda c: F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)
    return df.withColumn(out, F.array(*[F.coalesce(number(c).cast("float"), F.lit(0.0).cast("float")) for c in state["inputs"]]))


def _nothing(df, **_):
    return {}


OPERATIONS: dict[str, tuple[Callable, Callable]] = {
    "sentinel_nullify": (_learn_sentinels, _apply_sentinels),
    "drop_constant": (_learn_constant, _apply_drop),
    "drop_duplicate_columns": (_learn_duplicates, _apply_drop),
    "median_impute": (_learn_median, _apply_fill),
    "mode_impute": (_learn_mode, _apply_fill),
    "rare_grouping": (_learn_rare, _apply_rare),
    "frequency_encode": (_learn_frequency, _apply_frequency),
    "ordinal_encode": (_nothing, _apply_ordinal),
    "one_hot_encode": (_learn_one_hot, _apply_one_hot),
    "target_encode": (_learn_target, _apply_target),
    "iqr_clip": (_learn_iqr, _apply_iqr),
    "standard_scale": (_learn_scale, _apply_scale),
    "align_schema": (_learn_schema, _apply_schema),
    "feature_vector": (_learn_vector, _apply_vector),
}


# Preparations that learn nothing


def include_exclude(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Only ``include`` (all if empty), less ``exclude``; what ``keep`` names stays. Unknown names are ignored."""
    wanted = set(include) & set(df.columns) or set(df.columns)
    return df.select(*[c for c in df.columns if c in keep or c in wanted and c not in exclude])


def sentinel_replace(df: DataFrame, replacements: Mapping[str, tuple[object, object]]) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c)) for c, (old, new) in replacements.items()})


def sentinel_replace_report(df: DataFrame, replacements: Mapping[str, tuple[object, object]]) -> DataFrame:
    """``column_name, sentinel, replacement, n_replaced`` of what ``sentinel_replace`` does; null
    counts where the column is missing."""
    there = [c for c in replacements if c in df.columns]
    row = df.agg(*[F.count_if(F.col(quoted(c)) == F.lit(replacements[c][0])).alias(f"_{i}") for i, c in enumerate(there)], F.count("*").alias("_n"))
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(str(old)).alias("sentinel"), F.lit(str(new)).alias("replacement"), (F.col(f"_{there.index(c)}") if c in there else F.lit(None).cast("long")).alias("n_replaced")) for c, (old, new) in replacements.items()]
    return row.select(F.explode(F.array(*cells)).alias("_x")).select("_x.*")


def drop_report(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    """``column_name, found``: which of the columns to drop are there."""
    return df.sparkSession.createDataFrame([(c, c in df.columns) for c in drop], "column_name string, found boolean")


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first", order_by: Sequence[str] = ()) -> DataFrame:
    """Whole-row duplicates, or by ``subset``: the first or last row by ``order_by`` stays, or none."""
    if not subset:
        return df.dropDuplicates() if keep else df.groupBy(*df.columns).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")
    if keep is False:
        return df.withColumn("_n", F.count("*").over(Window.partitionBy(*subset))).where("_n = 1").drop("_n")
    # The other columns break ties, as far as they can be ordered.
    rest = [c for c, kind in df.dtypes if c not in order_by and kind.split("<")[0] not in ("map", "variant")]
    order = [F.asc(c) if keep == "first" else F.desc(c) for c in [*order_by, *rest]]
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*subset).orderBy(*order))).where("_r = 1").drop("_r")


def group_features(df: DataFrame, key: str, features: Mapping[str, str]) -> DataFrame:
    """Group sizes ("size") and distinct counts (a column name) joined back; a null key gets
    null, a missing key raises KeyError, features of missing columns are left out. Rows of large groups
    are joined in parts, rows without a key are not joined at all."""
    if key not in df.columns:
        raise KeyError(key)
    aggs = [(F.count("*") if c == "size" else F.countDistinct(c)).alias(n) for n, c in features.items() if c == "size" or c in df.columns]
    groups = checkpoint(df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs, F.count("*").alias("_mr_n")), release=True)
    few = groups.count() <= MAX_VALUES
    return spread_join(df, groups.drop("_mr_n"), [key], None if few else hot_keys(groups, [key], "_mr_n"), broadcast=few)


PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "dow": F.dayofweek, "hour": F.hour}


def datetime_parts(df: DataFrame, column: str, parts: Sequence[str] = ("hour",), drop: bool = True) -> DataFrame:
    at = F.try_to_timestamp(column) if isinstance(df.schema[column].dataType, T.StringType) else F.col(column)
    made = df.withColumns({f"{column}_{p}": PARTS[p](at) for p in parts})
    return made.drop(column) if drop else made


def flag_stats(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).cast("string").alias("value")) for c in flags])
    return df.select(F.explode(cells).alias("x")).select("x.*").groupBy("flag", "value").agg(F.count("*").alias("n"))


def shuffle(df: DataFrame, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys)


def label_encode(df: DataFrame, key: str | Sequence[str], target: str, codes: Mapping[str, int]) -> DataFrame:
    """Key and integer label; -1 where the target has no code."""
    keys = [key] if isinstance(key, str) else list(key)
    return _lookup(df.select(*keys, target), target, dict(codes), "int", "label", lambda i: F.coalesce(i, F.lit(-1))).select(*keys, "label")


def final_schema(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString(), len(df.columns)) for i, f in enumerate(df.schema)], "position int, feature string, dtype string, n_features int")


def observed_steps(df: DataFrame, steps: Mapping[str, Callable[[DataFrame], DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """The table after all steps, written, and a summary: ``position, step, n_rows, n_columns, n_nulls,
    rows_removed, columns_added, columns_removed`` with the input as step 0.

    Each step is a function of a table. What goes in and what each step gives is counted by listeners on the
    one job that writes the result, so the input is read once and no step runs twice. A step that
    reads its own input twice (a join with itself) does so here too.
    """
    seen: list[tuple[str, list[str], Observation]] = []

    def watched(now: DataFrame, name: str) -> DataFrame:
        seen.append((name, now.columns, Observation(f"{name}-{uuid.uuid4().hex}")))
        nulls = sum((F.col(quoted(c)).isNull().cast("long") for c in now.columns), F.lit(0).cast("long"))
        return now.observe(seen[-1][2], F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("n_nulls"))

    now = watched(df, "input")
    for name, step in steps.items():
        now = watched(step(now), name)
    result = checkpoint(now)
    rows, before = [], None
    for i, (name, columns, facts) in enumerate(seen):
        n = facts.get["n_rows"]
        more, less = (sorted(set(a) - set(b)) for a, b in ((columns, before or columns), (before or columns, columns)))
        rows.append((i, name, n, len(columns), facts.get["n_nulls"], 0 if before is None else rows[-1][2] - n, ", ".join(more), ", ".join(less)))
        before = columns
    return result, df.sparkSession.createDataFrame(rows, "position int, step string, n_rows long, n_columns int, n_nulls long, rows_removed long, columns_added string, columns_removed string")


# Text


@F.pandas_udf(T.StringType())
def _without_marks(texts: pd.Series) -> pd.Series:
    """Canonical decomposition without nonspacing marks, composed again."""
    strip = lambda s: unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn"))
    return texts.map(lambda s: s if s is None else strip(s))


def remove_accents(text: Column) -> Column:
    """Letters without their accents, for composed and decomposed text alike. Only text beyond ASCII leaves the JVM."""
    beyond = text.rlike(r"[^\x00-\x7F]")
    return F.when(beyond, _without_marks(F.when(beyond, text))).otherwise(text)


def normalise_text(df: DataFrame, columns: Sequence[str], *, lowercase: bool = True, accents: bool = False, squeeze: bool = True) -> DataFrame:
    """Text columns in lower case, without accents (unless ``accents`` are kept) and with single blanks for
    ASCII white space, none at the ends; nulls stay, text of blanks becomes empty. Columns that are missing or no text are
    left as they are."""
    kinds = dict(df.dtypes)
    made = {}
    for c in columns:
        if kinds.get(c) == "string":
            x = F.col(quoted(c))
            x = F.lower(x) if lowercase else x
            x = x if accents else remove_accents(x)
            made[c] = F.trim(F.regexp_replace(x, r"[\x20\x09-\x0D]+", " ")) if squeeze else x
    return df.withColumns(made)


# Exclusion


def exclusion_mask(df: DataFrame, rules: Mapping[str, str | Column], *, mask: str = "excluded", reasons: str = "reasons") -> DataFrame:
    """All rows, with ``reasons``, the names of the rules that are true of a row (a null is not true), and
    ``mask``, whether there are any. Rules are conditions or their SQL. A fit with this mask (``Prepare(...,
    mask="excluded")``) leaves the rows out, a transform keeps them."""
    hits = [F.when(F.coalesce(F.expr(r) if isinstance(r, str) else r, F.lit(False)), F.lit(name)) for name, r in rules.items()]
    return df.withColumn(reasons, F.filter(F.array(*hits), lambda x: x.isNotNull())).withColumn(mask, F.size(reasons) > 0)


def split_excluded(df: DataFrame, rules: Mapping[str, str | Column], key: str | Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The table with its mask, written; a side table ``key, reason`` of the excluded rows, a row for each
    reason; and the counts ``reason, n_rows`` (``any``: rows with a reason, ``kept``: the others). One pass."""
    keys, names = [key] if isinstance(key, str) else list(key), list(rules)
    counts = Observation(f"excluded-{uuid.uuid4().hex}")
    marked = exclusion_mask(df, rules)
    per = [F.count_if(F.array_contains("reasons", n)).alias(f"_{i}") for i, n in enumerate(names)]
    marked = checkpoint(marked.observe(counts, *per, F.count_if("excluded").alias("any"), F.count_if(~F.col("excluded")).alias("kept")))
    side = marked.where("excluded").select(*keys, F.explode("reasons").alias("reason"))
    rows = [(n, counts.get[f"_{i}"]) for i, n in enumerate(names)] + [(n, counts.get[n]) for n in ("any", "kept")]
    return marked, side, df.sparkSession.createDataFrame(rows, "reason string, n_rows long")


def aggregation_warnings(df: DataFrame, *, levels: Sequence[str] = (), time: str | None = None, max_values: int = 1000, min_days: int = 30) -> DataFrame:
    """``warning, subject, value, limit, raised``: what to mind before a model is fitted.

    ``encoding``: an integer column with over ``max_values`` different values is a code, not a quantity;
    ``aggregation``: rows per value of each of the ``levels`` over 1, so rows of one group would leak into
    each other; ``window``: fewer days of ``time`` than ``min_days``. Distinct counts are exact."""
    whole = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    subjects = list(dict.fromkeys([*whole, *levels]))
    row = df.agg(F.count("*").alias("n"), *([F.min(time).alias("lo"), F.max(time).alias("hi")] if time else [])).first()
    known = {r["column_name"]: r["n_distinct"] for r in values.distinct_counts(df, subjects).collect()} if subjects else {}  # a row per column
    rows = [("encoding", c, float(known[c]), float(max_values), known[c] > max_values) for c in whole]
    rows += [("aggregation", c, row["n"] / known[c] if known[c] else 0.0, 1.0, bool(known[c]) and row["n"] > known[c]) for c in levels]
    if time:
        days = (row["hi"] - row["lo"]).total_seconds() / 86400 if row["lo"] is not None else 0.0
        rows.append(("window", time, days, float(min_days), days < min_days))
    return df.sparkSession.createDataFrame(rows, "warning string, subject string, value double, limit double, raised boolean")
