"""Document streams: the same stateless transforms, with duplicates dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medloom.functions.extract import typed_mentions


def document_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Documents (doc_id, text, received_at) that arrive as parquet files in a folder."""
    return spark.readStream.schema("doc_id bigint, text string, received_at timestamp").option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def deduplicated(docs: DataFrame, lateness: str = "7 days") -> DataFrame:
    """Each document once; state is kept only as long as the watermark allows."""
    return docs.withWatermark("received_at", lateness).dropDuplicatesWithinWatermark(["doc_id"])


def mention_counts(docs: DataFrame, window: str = "1 day", lateness: str = "7 days") -> DataFrame:
    """Typed mentions per kind and tumbling window; late documents count until the watermark has passed."""
    marked = docs.withWatermark("received_at", lateness).withColumn("w", F.window("received_at", window))
    return typed_mentions(marked.select(F.struct("w").alias("k"), "text"), "k", "text").groupBy(F.col("k.w").alias("window"), "kind").agg(F.count("*").alias("n"))


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there, then stop; a later start goes on after it."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
