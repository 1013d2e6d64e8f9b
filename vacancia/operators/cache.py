"""Cross-run contact cache: freshness split, change tracking, cached merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fresh_until
from ..functions.text import minus_ignore_case
from ..schema import filled, has_items
from .contacts import as_parts, merge_contacts
from .waterfall import union_parts


def is_fresh(days: int, as_of: Column) -> Column:
    """Holds data, and a readable ``enriched_at`` no older than ``days``."""
    holds = has_items("phone_numbers") | has_items("emails") | filled("address")
    return holds & fresh_until(F.col("enriched_at"), days, as_of)


def split_cache(cached: DataFrame, days: int, as_of: Column) -> tuple[DataFrame, DataFrame]:
    marked = cached.withColumn("_fresh", is_fresh(days, as_of))
    return marked.where("_fresh").drop("_fresh"), marked.where("NOT _fresh").drop("_fresh")


def cache_changes(cached: DataFrame, seeds: DataFrame) -> DataFrame:
    """company, changes: fields where the seed brings values the cache lacks (old and new lists)."""
    none = F.array().cast("array<string>")
    s = seeds.select(
        "company", F.col("phone_numbers").alias("_new_phones"), F.col("emails").alias("_new_emails")
    )
    j = cached.select("company", "phone_numbers", "emails").join(s, "company", "left")

    def diff(old: str, new: str) -> Column:
        n, o = F.coalesce(new, none), F.coalesce(old, none)
        return F.when(
            F.size(minus_ignore_case(n, o)) > 0, F.struct(o.alias("old"), n.alias("new"))
        )

    pairs = F.array(
        F.struct(F.lit("phone_numbers").alias("key"), diff("phone_numbers", "_new_phones").alias("value")),
        F.struct(F.lit("emails").alias("key"), diff("emails", "_new_emails").alias("value")),
    )
    changes = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return j.select("company", changes.alias("changes"))


def cached_contacts(fresh: DataFrame, seeds: DataFrame) -> DataFrame:
    """Fresh cache entries merged with this run's seeds; no lookup is made for them.

    The score is the merge's own, taken before "cache" joins the sources.
    """
    mine = seeds.join(fresh.select("company"), "company", "left_semi").where(
        has_items("phone_numbers") | has_items("emails")
    )
    merged = merge_contacts(
        union_parts(as_parts(fresh.drop("changes"), 0), as_parts(mine, 1))
    ).drop("changes")
    out = merged.join(cache_changes(fresh, seeds), "company", "left")
    return out.withColumn(
        "enrichment_sources", F.array_union("enrichment_sources", F.array(F.lit("cache")))
    )
