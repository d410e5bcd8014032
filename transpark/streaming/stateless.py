"""Structured Streaming over the operators that keep no state between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transpark.operators.hits import good_hits
from transpark.sources.readers import HITS


def hit_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Tabular hits from files as they arrive in a folder."""
    return spark.readStream.schema(HITS).option("sep", "\t").option("maxFilesPerTrigger", files_per_batch).csv(path)


def scored_hits(hits: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Hits of enough identity with their score, above the threshold."""
    return good_hits(hits).withColumn("score", F.col("length") / F.col("slen") * F.col("pident")).where(F.col("score") > threshold)


def best_scores(hits: DataFrame, arrived: str, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """The best score of each query per window of arrival, for streams with an event time."""
    return scored_hits(hits.withWatermark(arrived, late)).groupBy(F.window(arrived, window), "qseqid").agg(F.max("score").alias("score"))
