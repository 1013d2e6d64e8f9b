"""Exact de-duplication by a distributed content sort.

Texts are equal when they agree after all characters of ``WHITE`` are deleted. Whole normalised
texts are range-partitioned by sampled splitters, sorted externally, and equal neighbours are
merged by full comparison: the longest original text stays, then the smallest identifier. Only
slim rows (identifier, length, digest) are shuffled besides, to tell every row its group.

A text that holds more than one row in ``HOT_GROUPS`` would land in one task. Such texts are few by
definition (at most ``HOT_GROUPS``), so their digests are broadcast, and their rows get a salt as
second sort key: splitters then also fall inside the group. What the salts leave is merged by digest.

Nulls count as empty text; a null identifier loses to any other; rows repeated with identifier and
text are one row each in the result, and one of them is kept. No Python runs on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import row_key, spare, whole_text

# Fixed value: the characters that do not count.
WHITE = r"[\x20\x09-\x0D]+"
HOT_GROUPS = 20_000
#: Characters of the text that splitters are made of.
HEAD = 32
_COPIES = 4096


def normal_text(text: str | Column) -> Column:
    return F.regexp_replace(whole_text(text), WHITE, "")


def content_groups(docs: DataFrame, hot: DataFrame, least: int) -> DataFrame:
    """One row per distinct text: sha, best (code points, ~id), n.

    ``docs`` has id and text; ``hot`` has (sha, n) of the texts to be spread.
    """
    rows = docs.select("id", F.length("text").cast("long").alias("chars"), normal_text("text").alias("norm"))
    salts = F.broadcast(hot.select(F.col("sha").alias("hot"), F.ceil(F.col("n") / least).alias("salts")))
    salted = rows.join(salts, F.sha2("norm", 256) == F.col("hot"), "left")
    salt = F.coalesce(F.pmod(F.xxhash64("id", F.rand(7)), F.col("salts")), F.lit(0))
    # Splitters are sampled from the text's first bytes, with a hash to tell long common heads apart,
    # so that no whole text goes to the driver.
    head = ["head", "tie", "salt"]
    order = salted.select(
        F.substring("norm", 1, HEAD).alias("head"), F.xxhash64("norm").alias("tie"), salt.alias("salt"), "norm", "chars", "id"
    ).repartitionByRange(*head)
    # Range partitioning and external sort serve the grouping: neighbours are compared in full.
    runs = order.groupBy(*head, "norm").agg(
        F.max(F.struct("chars", F.bitwise_not("id").alias("rev"))).alias("best"), F.count("*").alias("n")
    )
    return runs.groupBy(F.sha2("norm", 256).alias("sha")).agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_groups: int = HOT_GROUPS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    slim = cut_lineage(
        docs.select(
            "id", F.length("text").cast("long").alias("chars"), F.sha2(normal_text("text"), 256).alias("sha")
        ).groupBy("id", "chars", "sha").agg(F.count("*").alias("copies"))
    )
    total = slim.agg(F.sum("copies")).first()[0] or 0
    least = max(1000, total // hot_groups)
    hot = slim.groupBy("sha").agg(F.sum("copies").alias("n")).where(F.col("n") > least)
    groups = content_groups(docs, hot, least)
    joined = slim.join(groups, "sha").select(
        "id", "chars", "sha", "copies", F.bitwise_not("best.rev").alias("keep"), F.col("best.chars").alias("most"), "n"
    )
    # Every copy of a repeated row comes back, in blocks so that no array grows with the copies.
    blocks = joined.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / _COPIES))))
    ends = F.least(F.col("copies"), (F.col("block") + 1) * _COPIES) - 1
    each = blocks.withColumn("copy", F.explode(F.sequence(F.col("block") * _COPIES, ends)))
    stays = F.col("id").eqNullSafe(F.col("keep")) & (F.col("chars") == F.col("most")) & (F.col("copy") == 0)
    return each.select(
        F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"),
        stays.alias("kept"), F.col("sha").alias("text_sha256"),
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows without its exact copies; columns of any name stay as they are."""
    mine, other = spare(docs, "__key"), spare(docs, "__kept")
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(row_key("doc_id", "text_sha256").alias(other))
    key = row_key(F.col(id_col).cast("long"), F.sha2(normal_text(text_col), 256))
    rows = docs.withColumn(mine, key).join(kept, F.col(mine) == F.col(other), "left_semi")
    # Rows repeated with identifier and text share a key.
    return rows.dropDuplicates([mine]).drop(mine)
