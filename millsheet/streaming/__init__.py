"""Arrivals as a stream: extraction of documents as they come, and summaries of what came.

Extraction is stateless, so the batch operator runs unchanged in append mode; the summary is a watermarked window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsheet.operators.extract import extract

ARRIVALS = "doc long, text string, arrived_at timestamp"


def arrivals(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Documents (doc, text, arrived_at) from a folder that Parquet files arrive in."""
    return spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def extracted(stream: DataFrame) -> DataFrame:
    """Fields and notes of every arriving document."""
    return extract(stream.select("doc", "text"))


def summary(stream: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Documents and letters that arrived in each window; documents later than ``late`` don't count."""
    w = stream.withWatermark("arrived_at", late).groupBy(F.window("arrived_at", window).alias("w"))
    return w.agg(F.count("*").alias("documents"), F.sum(F.length("text")).alias("letters")).select(F.col("w.start").alias("start"), "documents", "letters")
