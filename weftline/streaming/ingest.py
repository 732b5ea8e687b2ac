"""Continuous ingest: new feed files are validated, enriched and written as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.enrich import enrich_documents
from weftline.sources.feeds import envelopes


def stream_envelopes(spark: SparkSession, path: str, kind: str = "person", files_per_batch: int = 64) -> DataFrame:
    """A stream of validated lines of new files in a folder; lines have no number, as a stream has no end to count from."""
    raw = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_batch).text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.lit(None).cast("long").alias("line"), (F.octet_length("value") + 1).cast("long").alias("bytes"), F.col("value").alias("text"))
    return envelopes(lines, kind)


def start_ingest(spark: SparkSession, persons: str, organizations: DataFrame, out: str, checkpoint: str, *, once: bool = False):
    """Starts a query that enriches new persons against a static table of organizations (id, body).

    Each micro-batch writes documents and rejects to folders of its own number, replacing what an earlier attempt at the
    same batch left, so a restart neither loses nor repeats any.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            good = batch.where("reason is null").select("id", "body")
            enrich_documents(good, organizations).withColumn("doc", F.to_json("doc")).write.mode("overwrite").parquet(f"{out}/documents/batch={number}")
            batch.where("reason is not null").select("file", "reason").write.mode("overwrite").parquet(f"{out}/rejects/batch={number}")
        finally:
            batch.unpersist()

    writer = stream_envelopes(spark, persons).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def upserts_per_window(events: DataFrame, key: str, at: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(window, key, n) of a stream: rows of each key and time window, with rows later than the watermark left out."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n"))
