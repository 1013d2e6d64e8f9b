"""The listing inbox as a stream: messages to a keyed table, what cannot be read to a second one, counts per call."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import KeyedTable
from ..sources.listings import normalise, parse_listing_text, reject_reason, split_rejects


def message_stream(spark: SparkSession, path: str, whole_files: bool = True, **options) -> DataFrame:
    """Landed messages as ``file, body``: a file each, or a line each of JSON-lines files (``whole_files=False``),
    which Spark can split."""
    rows = spark.readStream.format("text").options(wholetext=whole_files, **options).load(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))


class Inbox:
    """Postings keyed by (source, job_id), last one wins; rejected items with their reason; a row of counts per call.

    A micro-batch is one call. It is parsed once and kept while both sinks are written; its counts are observed
    while the postings are written. Every sink takes the batch number, so a replayed batch overwrites itself.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jobs = KeyedTable(spark, f"{self.path}/jobs", ["source", "job_id"])

    def store(self, messages: DataFrame, batch: int) -> None:
        # Ordinals follow arrival: files and lines of a partition, then items of a message.
        items = parse_listing_text(messages).withColumn("ord", F.monotonically_increasing_id())
        rows = normalise(items).persist()
        try:
            seen, bad = Observation(), reject_reason(F.col("_corrupt_record")).isNotNull()
            good, _ = split_rejects(rows.observe(seen, F.count("*").alias("received"), F.count_if(bad).alias("rejected")))
            _, rejects = split_rejects(rows)
            self.jobs.write_batch(good, batch)
            kept = ["file", "pos", "reject_reason", "_corrupt_record", "job_id", "source", "title"]
            rejects.select(*kept).write.mode("overwrite").parquet(f"{self.path}/rejects/batch={batch}")
            self._count(seen.get, batch)
        finally:
            rows.unpersist()

    def _count(self, seen: dict, batch: int) -> None:
        keys = self.jobs.batches().select("batch", *self.jobs.keys)
        added, total = keys.where(F.col("batch") == batch).drop("batch").distinct(), 0
        if batch:
            added = added.join(keys.where(F.col("batch") < batch).drop("batch").distinct(), self.jobs.keys, "left_anti")
            total = self.calls().where(F.col("batch") == batch - 1).first()["total"]
        row = [(seen["received"], seen["received"] - seen["rejected"], seen["rejected"], total + added.count())]
        self.spark.createDataFrame(row, "received long, stored long, rejected long, total long").write.mode("overwrite").parquet(
            f"{self.path}/calls/batch={batch}"
        )

    def drain(self, messages: DataFrame, checkpoint: str) -> None:
        """Store all that has landed."""
        query = (
            messages.writeStream.foreachBatch(self.store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def rejects(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rejects")

    def calls(self) -> DataFrame:
        """``batch, received, stored, rejected, total``: total counts distinct postings stored up to that call."""
        return self.spark.read.parquet(f"{self.path}/calls")
