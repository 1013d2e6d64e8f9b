"""Shards by jump consistent hashing, in SQL expressions alone.

The shard of a row depends on its key and the number of shards only. With one more shard a row
stays or moves into the new one, so just the necessary fraction moves, and no ring table exists.

A null key counts as 0; rows with equal keys share a shard; a null text has no bytes and the
checksum of the empty text. Slots number the rows of a shard without gaps, by key, checksum, size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import whole_text

# Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
#: Steps that nearly every key needs at most, whatever the number of shards; the rest take a longer walk.
USUAL_STEPS = 64


def _walk(start: str, shards: int, steps: int) -> str:
    """Jumps from candidate to candidate until one lies beyond the last shard."""
    wide = f"pmod(CAST(s.k AS DECIMAL(20,0)) * {MULTIPLIER}BD + 1BD, 18446744073709551616BD)"
    signed = f"CAST({wide} - CASE WHEN {wide} >= 9223372036854775808BD THEN 18446744073709551616BD ELSE 0BD END AS BIGINT)"
    jump = "CAST(floor((s.j + 1) * (2147483648D / CAST(shiftrightunsigned(t.k, 33) + 1 AS DOUBLE))) AS BIGINT)"
    step = f"transform(array(named_struct('k', {signed})), t -> named_struct('b', s.j, 'j', {jump}, 'k', t.k))[0]"
    return f"aggregate(sequence(1, {steps}), {start}, (s, i) -> CASE WHEN s.j < {shards} THEN {step} ELSE s END)"


def jump_shard(key: str, shards: int) -> Column:
    """Shard 0 .. ``shards`` - 1 of a long key, given as SQL text."""
    start = f"named_struct('b', -1L, 'j', 0L, 'k', coalesce(CAST({key} AS BIGINT), 0L))"
    walked = _walk(start, shards, min(shards, USUAL_STEPS))
    if shards > USUAL_STEPS:
        longer = _walk("w", shards, shards)
        walked = f"transform(array({walked}), w -> CASE WHEN w.j < {shards} THEN {longer} ELSE w END)[0]"
    return F.expr(f"CAST({walked}.b AS INT)")


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row per input row.

    Rows are range-partitioned by shard and key, so a shard of any size is numbered by many tasks:
    a row's slot is its position in its partition plus what the partitions before hold.
    """
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
    ).select(
        "*", jump_shard("doc_id", shards).alias("shard"), jump_shard("doc_id", shards + 1).alias("grown_shard")
    )
    order = ["shard", "doc_id", "text_crc32", "size"]
    fixed = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = fixed.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.expr("shiftright(at, 33)"))
    counts = placed.groupBy("part", "shard").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("part", "shard", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.join(starts, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("before") + F.col("at") - F.col("first")).alias("slot"), "grown_shard",
    )
