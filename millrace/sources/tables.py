"""Reading, sampling, combining and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SOURCES = ("train", "test")
CODECS = ("snappy", "gzip", "brotli", "zstd", "none")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes null, so that counts and means skip it."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path: str, *, schema: T.StructType | str | None = None, sep: str = ",", encoding: str = "UTF-8", null_values: Sequence[str] = ("", "NA", "None", "NaN", "nan", "NULL", "null")) -> DataFrame:
    """CSV with a header row; types are inferred only where no schema is given."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)
    texts = {f.name: F.when(~F.col(f.name).isin(*null_values), F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return nan_to_null(df.withColumns(texts) if texts else df)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return nan_to_null(df.select(*columns) if columns else df)


def head(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """The first ``n`` rows in the order of a column; rows have no order of their own."""
    return df.orderBy(order_by).limit(n)


def tail(df: DataFrame, n: int, order_by: str) -> DataFrame:
    return df.orderBy(F.desc(order_by)).limit(n)


def _draw(key: str | Sequence[str], seed: int) -> list[Column]:
    keys = [key] if isinstance(key, str) else list(key)
    return [F.xxhash64(*keys, F.lit(seed)), *map(F.col, keys)]


def sample_random(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """A uniform sample of exactly ``n`` rows (all of them if there are fewer), seeded."""
    return df.orderBy(*_draw(key, seed)).limit(n)


def sample_stratified(df: DataFrame, n: int, stratum: str, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Proportional allocation over the whole table with one row per stratum at least.
    Rows with a null stratum are left out; a missing column raises KeyError."""
    if stratum not in df.columns:
        raise KeyError(stratum)
    known = df.where(F.col(stratum).isNotNull())
    counts = known.groupBy(F.col(stratum).alias("_s")).count()
    total = F.sum("count").over(Window.partitionBy())
    wanted = counts.select("_s", F.greatest(F.lit(1), F.round(n * F.col("count") / total)).alias("_n"))
    order = Window.partitionBy(stratum).orderBy(*_draw(key, seed))
    ranked = known.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n)
    return ranked.join(wanted, F.col(stratum) == F.col("_s")).where(F.col("_r") <= F.col("_n")).select(*df.columns)


def read_table(spark: SparkSession, path: str, *, format: str = "parquet", mode: str = "full", method: str = "random", n: int | None = None, key: str | Sequence[str] | None = None, stratum: str | None = None, order_by: str | None = None, seed: int = 42, **options) -> DataFrame:
    """Read a table whole (``mode="full"``) or a sample of it (``mode="sample"`` with method
    random, stratified, head or tail). Adds nothing; see ``with_origin`` for the file."""
    df = read_csv(spark, path, **options) if format == "csv" else read_parquet(spark, path, **options)
    if mode == "full":
        return df
    if mode != "sample":
        raise ValueError(f"mode: {mode}; chunked reading is a streaming job, see millrace.streaming")
    if n is None or n < 1:
        raise ValueError("n: a positive number of rows")
    if method == "random":
        return sample_random(df, n, key or df.columns, seed)
    if method == "stratified":
        return sample_stratified(df, n, stratum or "", key or df.columns, seed)
    if method in ("head", "tail"):
        if not order_by:
            raise ValueError("order_by: rows have no order of their own")
        return (head if method == "head" else tail)(df, n, order_by)
    raise ValueError(f"method: {method}")


def with_origin(df: DataFrame) -> DataFrame:
    return df.withColumn("_origin", F.col("_metadata.file_path"))


def with_source(df: DataFrame, source: str) -> DataFrame:
    if source not in SOURCES:
        raise ValueError(f"source: {source}")
    return df.withColumn("source", F.lit(source))


def of_source(df: DataFrame, source: str) -> DataFrame:
    if "source" not in df.columns:
        raise KeyError("source")
    if source not in SOURCES:
        raise ValueError(f"source: {source}")
    return df.where(F.col("source") == source)


def combine(train: DataFrame, test: DataFrame, *, n: int | None = None, key: str | Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Both tables under one schema with a ``source`` column, by name; then ``n`` rows of it if asked."""
    both = with_source(train, "train").unionByName(with_source(test, "test"), allowMissingColumns=True)
    return both if n is None else sample_random(both, n, key or both.columns, seed)


def save_parquet(df: DataFrame, path: str, *, compression: str = "snappy", partition_by: Sequence[str] = ()) -> None:
    if compression not in CODECS:
        raise ValueError(f"compression: {compression}")
    if df.isEmpty():
        raise ValueError("the table is empty")
    df.write.mode("overwrite").option("compression", compression).partitionBy(*partition_by).parquet(path)


def save_report(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """A report is a small tidy table; it is written as JSON lines."""
    df.write.mode(mode).json(path)


def save_metrics(metrics: DataFrame, path: str, *, run_id: str, step: str) -> None:
    """Append ``model, metric, value`` rows to the metric table of all runs."""
    metrics.select(F.lit(run_id).alias("run_id"), F.lit(step).alias("step"), "model", "metric", F.col("value").cast("double")).write.mode("append").partitionBy("run_id").parquet(path)


def split_shapes(df: DataFrame, by: str = "source") -> DataFrame:
    """Rows and columns per split."""
    return df.groupBy(by).agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns) - 1).cast("long"))
