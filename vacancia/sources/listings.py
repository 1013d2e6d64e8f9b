"""Landed listing files: ``{"jobs": [...]}`` envelopes or bare arrays, normalised to postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..schema import FILE_BITS, ITEM_BITS, POSTINGS, conform, filled, first_filled, packed
from ..session import cut_lineage

_TEXT = [
    "job_id", "source", "title", "company", "company_url", "location", "location_city",
    "location_postcode", "salary_text", "salary_min", "salary_max", "salary_period", "job_type",
    "description", "requirements", "benefits", "posted_at", "expires_at", "apply_url", "sources",
    "hash", "scraped_at",
]
# Everything is read as text, so one odd value never rejects a row; the normaliser casts.
RAW = T.StructType([T.StructField(name, T.StringType()) for name in _TEXT])
_BAD = T.StructField("_corrupt_record", T.StringType())
_ITEM = T.StructType([*RAW.fields, _BAD])
_ENVELOPE = T.StructType([T.StructField("jobs", T.ArrayType(T.StringType())), _BAD])


def _file_ranks(files: DataFrame) -> DataFrame:
    """``file, rank``: positions of distinct names in their order, counted from 0 without one task for all."""
    placed = cut_lineage(
        files.distinct().repartitionByRange("file").sortWithinPartitions("file").select(
            "file", F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("i"),
        )
    )
    # One row per partition of the sort.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    return placed.join(starts, "part").select("file", (F.col("start") + F.col("i")).alias("rank"))


def read_listing_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows of every file below ``path`` with ``ord`` = (file position, position in file).

    Items come as in ``parse_listing_text``, with their ``file`` and ``pos``. The names are ranked
    from a listing that reads no contents. A file of no bytes gives no rows, as in Spark's readers.
    """
    name = F.col("_metadata.file_path").alias("file")
    ranks = _file_ranks(spark.read.format("binaryFile").load(path).select(name))
    rows = parse_listing_text(spark.read.text(path, wholetext=True).select(name, F.col("value").alias("body")))
    return rows.join(ranks, "file").withColumn(
        "ord", packed(F.col("rank"), F.col("pos"), ITEM_BITS, FILE_BITS)
    ).drop("rank")


def parse_listing_text(messages: DataFrame, body: str = "body") -> DataFrame:
    """Both shapes held in a text column (one landed message per row), one raw row per item.

    Every item is parsed alone: one that is no object has its text in ``_corrupt_record``, and the
    others of its message stay. An unreadable message gives one such row; an object without
    ``jobs`` and a null message give none.
    """
    text = F.col(body)
    keep = [c for c in messages.columns if c != body]
    array = F.startswith(F.ltrim(text), F.lit("["))
    read = messages.select(
        *keep, text.alias("_body"), F.from_json(F.when(array, text), "array<string>").alias("_bare"),
        F.from_json(F.when(~array, text), _ENVELOPE).alias("_envelope"), array.alias("_array"),
    )
    lost = F.when(F.col("_array"), F.col("_bare").isNull()).otherwise(
        F.col("_envelope").isNull() | F.col("_envelope._corrupt_record").isNotNull()
    )
    whole = F.when(F.col("_body").isNotNull() & lost, F.col("_body"))
    items = F.when(whole.isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(
        F.coalesce("_bare", "_envelope.jobs")
    )
    rows = read.select(*keep, whole.alias("_whole"), F.posexplode(items).alias("pos", "_item"))
    rows = rows.withColumn("r", F.from_json("_item", _ITEM))
    is_object = F.coalesce(F.startswith(F.ltrim("_item"), F.lit("{")), F.lit(False))
    bad = F.when(~is_object | F.col("r._corrupt_record").isNotNull(), F.coalesce("_item", F.lit("null")))
    return rows.select(
        *keep, "pos", F.coalesce("_whole", bad).alias("_corrupt_record"), *[f"r.{name}" for name in _TEXT]
    )


def _list_or_null(c: Column) -> Column:
    return F.when(F.startswith(F.ltrim(c), F.lit("[")), F.from_json(c, "array<string>"))


def normalise(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Schema-on-read: known fields only, ids and titles trimmed, numbers cast, defaults set."""
    have = {f.name: f.dataType for f in raw.schema.fields}
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if now is None else now

    def lists(name: str) -> Column:
        if name not in have:
            return F.lit(None).cast("array<string>")
        if isinstance(have[name], T.ArrayType):
            return F.col(name).cast("array<string>")
        return _list_or_null(F.col(name))

    def text(name: str) -> Column:
        return F.col(name).cast("string") if name in have else F.lit(None).cast("string")

    def number(name: str) -> Column:
        return strip(text(name)).try_cast("double")

    none = F.array().cast("array<string>")
    values = {
        "job_id": strip(F.coalesce(text("job_id"), F.lit(""))),
        "source": strip(first_filled(text("source"), F.lit("extension"))),
        "title": strip(F.coalesce(text("title"), F.lit(""))),
        "salary_min": number("salary_min"),
        "salary_max": number("salary_max"),
        "requirements": F.coalesce(lists("requirements"), none),
        "benefits": F.coalesce(lists("benefits"), none),
        "sources": F.coalesce(lists("sources"), none),
        "scraped_at": first_filled(text("scraped_at"), now),
    }
    keep = [c for c in ("_corrupt_record", "file", "pos") if c in have]
    names = [f.name for f in POSTINGS.fields if f.name not in ("ord", "field_sources")]
    out = raw.select(
        F.col("ord"), *keep, *[values.get(n, text(n)).alias(n) for n in names]
    )
    return out.withColumn("field_sources", F.lit(None).cast("map<string,array<string>>"))


def reject_reason(corrupt: Column | None = None) -> Column:
    """Why a normalised row is refused, null for a good row."""
    missing = F.when(~filled("title"), "missing_title").when(~filled("job_id"), "missing_job_id")
    return missing if corrupt is None else F.when(corrupt.isNotNull(), "unreadable").otherwise(missing)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good postings, rejected rows with ``reject_reason``)."""
    corrupt = F.col("_corrupt_record") if "_corrupt_record" in df.columns else None
    marked = df.withColumn("reject_reason", reject_reason(corrupt))
    good = conform(marked.where(F.col("reject_reason").isNull()), POSTINGS)
    return good, marked.where(F.col("reject_reason").isNotNull())


def load_listings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return split_rejects(normalise(read_listing_files(spark, path)))
