"""Keyed tables on plain files: last write per key wins.

Every batch is its own directory, written under the batch number and overwritten when the same
batch is sent again, so a retry never duplicates. Reading takes the last row per key over all
batches. A write costs its batch and not the whole table; ``compact`` folds old batches into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rows of ``target`` replaced by ``updates`` on equal keys, new keys added.

    Within ``updates`` the highest ``order`` wins. Columns known to one side only are kept (null
    on the other), which is also how a table gains columns.
    """
    seq = F.col(order) if order else F.lit(0)
    both = target.withColumn("_batch", F.lit(0)).withColumn("_seq", F.lit(None).cast("bigint")).unionByName(
        updates.withColumn("_batch", F.lit(1)).withColumn("_seq", seq.cast("bigint")),
        allowMissingColumns=True,
    )
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("_batch"), F.desc("_seq")))
    return both.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", "_batch", "_seq")


class KeyedTable:
    """A folder of numbered batches read as one keyed table.

    The newest batch wins; with ``by_order`` the row's own ordinal decides, whatever batch it
    arrived in.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], order: str = "ord", by_order: bool = False
    ):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), keys, order
        self.by_order = by_order

    def write_batch(self, rows: DataFrame, batch: int) -> None:
        """Store one batch; sending the same number again replaces it."""
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def batches(self) -> DataFrame:
        """All stored rows with their ``batch``; later batches may have more columns."""
        return self.spark.read.option("mergeSchema", "true").option("basePath", self.path).parquet(
            f"{self.path}/batch=*"
        )

    def current(self) -> DataFrame:
        newest = ["batch", self.order]
        newest = newest[::-1] if self.by_order else newest
        rank = F.row_number().over(W.partitionBy(*self.keys).orderBy(*[F.desc(c) for c in newest]))
        rows = self.batches().withColumn("_rank", rank)
        return rows.where(F.col("_rank") == 1).drop("_rank", "batch")

    def new_keys(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """Rows whose key is not stored yet, in the batches ``before`` a number or in any."""
        stored = self.batches() if before is None else self.batches().where(F.col("batch") < before)
        return rows.join(stored.select(*self.keys).distinct(), self.keys, "left_anti")

    def compact(self, path: str) -> KeyedTable:
        """Write the current rows as batch 0 of a new folder and return that table."""
        self.current().write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch=0")
        return KeyedTable(self.spark, path, self.keys, self.order, self.by_order)
