"""Score text lines as they arrive (the crawler -> classifier hand-off as a stream).

The reference's crawlers write one record per line to a text file that the
classifier later reads.  Here new files landing in a folder are read with
Structured Streaming's file source; each micro-batch is scored with the
same batch plan as :func:`insight.plans.text.score_posts` against a fitted
model whose tables were written to the checkpoint folder.

Delivery: the stream's checkpoint records which files each batch consumed,
and every batch writes its own output folder ``batch_id=<n>`` with
``overwrite``, so a batch replayed after a failure replaces its earlier
partial output -- exactly-once results without a transactional sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from insight.plans import text as TP
from insight.sources.checkpoint import materialize


def text_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new text files: ``(file, text)``; blank lines kept."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir).select(F.col("_metadata.file_path").alias("file"),
                                         F.col("value").alias("text"))


def score_batch(model: TP.TrainedModel, batch: DataFrame, batch_id: int, sink_dir: str) -> None:
    # the batch is stored once, so that its row numbers are the same for every reader
    posts = materialize(batch.select(F.lit(batch_id).cast("long").alias("batch_id"),
                                     F.monotonically_increasing_id().alias("post_id"), "file", "text"), "batch")
    scored = TP.score_posts(model, posts, ["batch_id", "post_id"])
    out = scored.join(posts.select("batch_id", "post_id", "file"), ["batch_id", "post_id"])
    out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")


def start_scoring(spark: SparkSession, model: TP.TrainedModel, source_dir: str, sink_dir: str,
                  checkpoint_location: str, available_now: bool = False,
                  processing_time: str | None = None) -> StreamingQuery:
    """Start the scoring stream; ``available_now`` processes what is there and stops.

    ``checkpoint_location`` is the stream's own folder and must outlive the
    driver: a restarted stream goes on from the offsets kept there.
    """
    writer = (text_stream(spark, source_dir).writeStream
              .foreachBatch(lambda df, bid: score_batch(model, df, bid, sink_dir))
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
