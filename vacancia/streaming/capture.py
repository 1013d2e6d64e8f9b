"""Continuous capture: file streams into keyed tables, running counts, bursts, repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import KeyedTable
from ..schema import filled, has_items


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def run_to_table(
    stream: DataFrame, table: KeyedTable, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda d: d
) -> DataFrame:
    """Drain a stream into a keyed table and return the current rows.

    The batch id numbers the stored batch, so a batch replayed after a failure overwrites itself
    and re-sent rows replace, never duplicate. Rows without a key are dropped.
    """
    def store(rows: DataFrame, batch: int) -> None:
        keyed = prepare(rows)
        for key in table.keys:
            keyed = keyed.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
        table.write_batch(keyed, batch)

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.current()


def run_counts(stream: DataFrame, keys: list[str], table_path: str, checkpoint: str) -> DataFrame:
    """Running counts per key, kept as stream state; returns the latest count of every key."""
    table = KeyedTable(stream.sparkSession, table_path, keys, order="n")
    query = (
        stream.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .writeStream.outputMode("update")
        .foreachBatch(lambda rows, batch: table.write_batch(rows, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.current()


def skip_seen(stream_batch: DataFrame, seen: DataFrame, on: str = "hash") -> DataFrame:
    """Incremental run: rows of a micro-batch that were not stored before."""
    return stream_batch.join(seen.select(on), on, "left_anti")


def merge_captures(
    captures: DataFrame, keys: list[str], order: Column, longest: str = "description"
) -> DataFrame:
    """Field-level merge of repeated captures of one posting.

    Later non-empty values overwrite, the longest text is kept (first of equals), empty lists are
    ignored. Each field is an ordered extremum, so the merge combines map-side, does not depend
    on arrival order, and merging merged rows again changes nothing.
    """
    def present(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType):
            return has_items(f.name)
        if isinstance(f.dataType, T.StringType):
            return filled(f.name)
        return F.col(f.name).isNotNull()

    aggs = []
    for f in captures.schema.fields:
        if f.name in keys:
            continue
        if f.name == longest:
            size = F.struct(F.length(f.name).alias("n"), (-order).alias("o"))
            aggs.append(F.max_by(f.name, F.when(filled(f.name), size)).alias(f.name))
        else:
            aggs.append(F.max_by(f.name, F.when(present(f), order)).alias(f.name))
    usable = captures.where(F.col(keys[-1]).isNotNull() & (F.col(keys[-1]).cast("string") != ""))
    return usable.groupBy(*keys).agg(*aggs)


def drop_repeats(batches: DataFrame, stream_key: str, order: str, change_key: str) -> DataFrame:
    """Drop a batch whose change key equals that of the batch before it in the same stream."""
    before = F.lag(change_key).over(W.partitionBy(stream_key).orderBy(order))
    same = F.col("_before").eqNullSafe(F.col(change_key)) & F.col("_before").isNotNull()
    return batches.withColumn("_before", before).where(~same).drop("_before")


def bursts(captures: DataFrame, keys: list[str], ts: str = "ts", gap: str = "800 milliseconds", lateness: str | None = None) -> DataFrame:
    """One row per burst: captures of a key closer than ``gap`` collapse to the latest one.

    Works on batch frames and, with ``lateness`` as watermark, on streams.
    """
    rows = captures.withWatermark(ts, lateness) if lateness else captures
    rest = [c for c in captures.columns if c not in keys and c != ts]
    out = rows.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(
        F.count("*").alias("n"), F.max_by(F.struct(ts, *rest), F.col(ts)).alias("last")
    )
    return out.select(*keys, F.col("w.start").alias("burst_start"), "n", "last.*")
