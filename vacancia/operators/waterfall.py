"""Waterfall enrichment: a lookup is consulted only while phone and e-mail are not both known."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CONTACTS, conform, has_items
from ..session import landed
from .contacts import as_parts, merge_contacts

# Order in which lookups are consulted.
PRIORITY = {
    "seed": 0, "website": 1, "companies_house": 2, "charities": 3, "cqc": 4, "duckduckgo": 5,
    "serpapi": 6, "model": 7,
}
Enricher = Callable[[DataFrame], DataFrame]


def gate_parts(parts: DataFrame) -> DataFrame:
    """Drop parts behind the point where a company has both a phone and an e-mail.

    Phones and e-mails only accumulate, so the point is the later of the first part with a phone
    and the first with an e-mail: two minima that combine map-side, and an equi join.
    """
    o = F.struct("priority", "part_ord")
    gate = parts.groupBy("company").agg(
        F.min(F.when(has_items("phone_numbers"), o)).alias("phone_at"),
        F.min(F.when(has_items("emails"), o)).alias("email_at"),
    )
    full = F.col("phone_at").isNotNull() & F.col("email_at").isNotNull()
    keep = ~full | (F.struct("priority", "part_ord") <= F.greatest("phone_at", "email_at"))
    return parts.join(gate, "company").where(keep).select(*parts.columns)


def seed_parts(seeds: DataFrame, enriched_at: Column | None = None) -> DataFrame:
    """Seeds count as a part only when they carry a value."""
    return as_parts(seeds, PRIORITY["seed"], enriched_at).where(has_items("phone_numbers") | has_items("emails"))


def run_waterfall(
    companies: DataFrame, seeds: DataFrame, enrichers: list[tuple[int, Enricher]], enriched_at: Column | None = None,
) -> DataFrame:
    """Consult each enricher with the companies still lacking data; returns all parts.

    ``enrichers`` are (priority, function of companies giving contact fields). Each stage's parts
    are checkpointed: they decide who enters the next stage. ``enriched_at`` stamps what has no time of its own.
    """
    parts = landed(seed_parts(seeds, enriched_at))
    for priority, enrich in sorted(enrichers, key=lambda e: e[0]):
        done = parts.groupBy("company").agg(
            F.max(has_items("phone_numbers")).alias("p"), F.max(has_items("emails")).alias("e")
        ).where("p AND e").select("company")
        pending = companies.join(done, "company", "left_anti")
        found = landed(as_parts(enrich(pending), priority, enriched_at))
        parts = parts.unionByName(found)
    return parts


def contacts_for(companies: DataFrame, parts: DataFrame) -> DataFrame:
    """Merged contact per company; a company without any part keeps an empty record."""
    merged = merge_contacts(parts)
    out = companies.select("company").distinct().join(merged, "company", "left")
    none = F.array().cast("array<string>")
    defaults = {c: F.coalesce(c, none) for c in ("phone_numbers", "emails", "enrichment_sources")}
    defaults |= {
        "ai_used": F.coalesce("ai_used", F.lit(False)),
        "confidence_score": F.coalesce("confidence_score", F.lit(0)),
        "field_sources": F.coalesce("field_sources", F.create_map().cast("map<string,array<string>>")),
    }
    return conform(out.withColumns(defaults), CONTACTS)


def enriched_count(contacts: DataFrame) -> DataFrame:
    found = has_items("phone_numbers") | has_items("emails") | F.coalesce(F.col("address") != "", F.lit(False))
    return contacts.agg(F.count("*").alias("companies"), F.count_if(found).alias("enriched"))


def union_parts(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
