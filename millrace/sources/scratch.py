"""Intermediate results in the folder that driver and executors share, and joins on hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``. Where the session names
    none, a local master gets a new folder of its own and a cluster gets a RuntimeError."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="millrace-checkpoint-")
        sc.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{_FOLDER.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Tells Spark to delete shuffle files when the query that made them has ended.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(df: DataFrame, *, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder now and go on from those files, which outlive executors,
    are read column by column and have a size that the planner knows. With ``release`` the shuffle
    files behind it go at once, and not when the driver happens to collect its garbage; ``df``
    itself is then not to be used again."""
    spark, path = df.sparkSession, scratch(df.sparkSession, "table")
    before = spark.conf.get(RELEASE, "false")
    if release:
        spark.conf.set(RELEASE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if release:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark can write."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """What ``checkpoint`` and ``scratch`` write inside is deleted at the end. Frames are lazy, so
    write a result out, elsewhere, before leaving."""
    folder = scratch(spark, "work")
    token = _FOLDER.set(folder)
    try:
        yield folder
    finally:
        _FOLDER.reset(token)
        delete(spark, folder)


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n", least: int = 1000, most: int = 1000) -> DataFrame | None:
    """``keys, parts``: the keys of ``counts`` that hold over ``least`` rows and over one in ``most``
    of them all, so there are fewer than ``most``, and how many parts of such size each makes;
    None if there are none."""
    total, largest = counts.agg(F.sum(n), F.max(n)).first()
    limit = max(least, (total or 0) // most)
    parts = F.ceil(F.col(n) / limit).cast("int").alias("parts")
    return checkpoint(counts.where(F.col(n) > limit).select(*keys, parts)) if (largest or 0) > limit else None


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)``, with the rows of ``left`` under the ``hot`` keys (of
    ``hot_keys``) dealt to parts by a hash of the row, and the rows of ``right`` under them, a
    few a key, copied to each part. ``how`` is inner, left, left_semi or left_anti."""
    if hot is None:
        return left.join(right, keys, how)
    parts = F.broadcast(hot.withColumnRenamed("parts", "_mr_parts"))
    hashed = [c for c, kind in left.dtypes if kind.split("<")[0] not in ("map", "variant")]
    of_row = F.coalesce(F.pmod(F.xxhash64(*hashed), F.col("_mr_parts")).cast("int"), F.lit(0))
    dealt = left.join(parts, keys, "left").withColumn("_mr_part", of_row).drop("_mr_parts")
    copied = right.join(parts, keys, "left").withColumn("_mr_part", F.explode(F.sequence(F.lit(0), F.coalesce("_mr_parts", F.lit(1)) - 1))).drop("_mr_parts")
    return dealt.join(copied, [*keys, "_mr_part"], how).drop("_mr_part")


#: Parts that rows without a key are dealt to.
NULL_PARTS = 997


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame | None, how: str = "left", *, broadcast: bool = False) -> DataFrame:
    """``hot_join`` for data whose keys may be null: null keys meet nothing and do not meet in
    one task. ``broadcast`` says that ``right`` has been counted to be small."""
    if broadcast:
        return left.join(F.broadcast(right), keys, how)
    hashed = [c for c, kind in left.dtypes if kind.split("<")[0] not in ("map", "variant")]
    lost = F.lit(False)
    for k in keys:
        lost = lost | F.col(k).isNull()
    dealt = left.withColumn("_mr_lost", F.when(lost, F.pmod(F.xxhash64(*hashed), F.lit(NULL_PARTS)) + 1).otherwise(0))
    return hot_join(dealt, right.withColumn("_mr_lost", F.lit(0).cast("long")), [*keys, "_mr_lost"], hot and hot.withColumn("_mr_lost", F.lit(0).cast("long")), how).drop("_mr_lost")
