"""Helpers shared by the corpus operators: written intermediate tables, words, letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.scratch import checkpoint, delete, hot_join, hot_keys, scratch, shared_dir, workspace

__all__ = ["SPACES", "checkpoint", "delete", "few", "has_letters", "hot_join", "hot_keys", "letters", "modest_batches", "row_ids", "scratch", "shared_dir", "table", "words", "workspace"]

#: Java regex for runs of ASCII white space; words are what lies between.
SPACES = r"[\x20\x09-\x0D]+"


def few(keys: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """``keys`` (a written table) marked for broadcast if they are counted to be few."""
    return F.broadcast(keys) if keys.count() <= max_rows else keys


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: hand Python workers ``rows`` of them at once, as a default for the session.
    Every corpus operator asks for the same; an application that has set a size keeps its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(rows))


def words(text: Column) -> Column:
    """Array of the maximal runs of anything but ASCII white space; null gives no word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def letters(text: Column) -> Column:
    """Lower-cased runs of letters and their marks, a space between and around them. What is
    not a letter (digits and other numbers, signs) is a gap; null gives no run."""
    runs = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " ")
    return F.concat(F.lit(" "), F.trim(runs), F.lit(" "))


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def row_ids(*columns: Column) -> tuple[Column, Column]:
    """128 bits, as two longs, that tell rows of different content apart."""
    parts = [x for c in columns for x in (c.isNull(), c)]
    return F.xxhash64(*parts), F.xxhash64(F.lit("row"), *reversed(parts))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
