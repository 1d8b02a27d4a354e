"""Scoring of files as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T


def score_files(spark: SparkSession, model: PipelineModel, source: str, sink: str, checkpoint: str, schema: T.StructType, *, format: str = "parquet", max_files: int = 100, **options):
    """Transform all files in ``source`` that were not scored before and append to ``sink``.

    Reads what is there in steps of ``max_files`` files and ends; the checkpoint remembers
    it, so the next call takes new files only. Fitted stages keep no state across rows, so
    no watermark is needed. Returns the finished query.
    """
    rows = spark.readStream.schema(schema).options(maxFilesPerTrigger=max_files, **options).format(format).load(source)
    query = model.transform(rows).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
