"""Incremental ingest and windowed counts with Structured Streaming; the batch forms share the code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.functions.text import fingerprint


def hourly(events: DataFrame) -> DataFrame:
    """(hora, event_type, n, usuarios, total) of a batch of events."""
    return events.groupBy(F.date_trunc("hour", "ts").alias("hora"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("usuarios"), F.round(F.sum("value"), 4).alias("total"))


def hourly_stream(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """(hora, event_type, n, total) of a stream; events later than ``late`` are left out of windows that are closed."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("hora"), "event_type", "n", "total")


def new_documents(spark: SparkSession, folder: str, schema: str, late: str = "30 days") -> DataFrame:
    """A stream of document files (Parquet) as they arrive, each content once within ``late`` of its first arrival."""
    docs = spark.readStream.schema(schema).parquet(folder)
    keyed = docs.withColumn("content_sha1", F.coalesce(fingerprint(F.col("text")), F.concat(F.lit("empty:"), F.col("doc_id").cast("string"))))
    return keyed.withColumn("at", F.col("ingerido").cast("timestamp")).withWatermark("at", late).dropDuplicatesWithinWatermark(["content_sha1"])


def ingest_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Write what is there and stop; a later call goes on from the checkpoint, after a failure as well."""
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
