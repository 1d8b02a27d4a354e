"""From raw documents to a mixed training corpus, in stages that are written and read again.

In every stage texts of any length are read whole, repeated rows are rows of their own until
near-duplicates go, columns beside those of ``documents`` pass through, and an empty table
gives an empty result. ``doc_id`` may be null or repeat; what else holds is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, langid, line_dedup, mixing, simhash
from millrace.llm.common import checkpoint, delete, scratch, table, workspace


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with ``lang`` set to the predicted one. The model
    learns from the labelled documents of this stage's input. Null text and text without a
    letter go; so does everything if no document has a label, an id and letters."""
    made = langid.identify(docs, langid.fit(docs))
    return made.where(F.col("lang_pred") != langid.UNKNOWN).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents go. Of the documents that would lose over half of their characters,
    as copies and near copies of a text do to each other, the first to hold a line (by doc_id, nulls last) keeps
    it; those that have nothing left go, as null and blank texts do. ``n_chars`` is counted anew."""
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    made = line_dedup.drop_frequent_lines(docs.withColumn("_mr_whole", F.col("text")), min_docs=10)
    whole = (F.col("n_dropped") == 0) | words & (2 * F.length("text") >= F.length("_mr_whole"))
    rank = F.coalesce(F.col("doc_id").try_cast("long"), F.monotonically_increasing_id() + (1 << 62))
    emptied = checkpoint(made.where(~whole).withColumns({"text": F.col("_mr_whole"), "_mr_rank": rank}).select(*docs.columns, "_mr_rank"))
    once = line_dedup.drop_frequent_lines(emptied, key="_mr_rank", min_docs=2, keep="first").where(words)
    left = made.where(whole).select(*docs.columns).unionByName(once.select(*docs.columns))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest doc_id (nulls last).
    Documents of one id with different texts are different documents."""
    return simhash.drop_near_copies(docs, shingle=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, judged by their own text; null texts stay."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture; a null source is a source."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

#: Suffix automata, SimHash and the Pfair schedule are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. What a stage wrote meanwhile is deleted with its end, and
    its result when the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, name)
        with workspace(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
