"""Contacts mined from company pages and from search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.phones import extract_phones
from ..functions.text import (
    address_near_postcode, contact_person, extract_emails, html_to_text, page_candidates,
)
from ..schema import filled, has_items
from ..sources.web_pages import ld_address
from .contacts import ordered_values
from .registry import top_links


def page_facts(pages: DataFrame) -> DataFrame:
    """Per page: phones, e-mails, first person, address (JSON-LD before postcode context)."""
    t = pages.withColumn("_text", html_to_text(F.col("html")))
    return t.select(
        *[c for c in pages.columns if c != "html"],
        extract_phones(F.col("_text")).alias("phones"),
        extract_emails(F.col("_text")).alias("emails"),
        contact_person(F.col("_text")).alias("person"),
        F.coalesce(ld_address(F.col("html")), address_near_postcode(F.col("_text"))).alias("address"),
    )


def candidate_pages(companies: DataFrame) -> DataFrame:
    """company(company_url) to the pages to look at, in visiting order."""
    return companies.where(filled("company_url")).select(
        "company", F.col("company_url").alias("base_url"),
        F.posexplode(page_candidates(F.col("company_url"))).alias("page_ord", "url"),
    )


def website_contacts(facts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Page facts (``company, page_ord, url``) to contact fields per company.

    Pages count in visiting order up to the first one with both a phone and an e-mail. The stop
    page and the scalar fields are ordered minima; values are distinct before collection.
    """
    by = by or ["company"]
    stop = facts.groupBy(*by).agg(
        F.min(F.when(has_items("phones") & has_items("emails"), F.col("page_ord"))).alias("_stop"),
        F.min_by("url", "page_ord").alias("company_website"),
    )
    seen = facts.join(stop, by).where(F.col("_stop").isNull() | (F.col("page_ord") <= F.col("_stop")))

    def first(name: str) -> Column:
        return F.min_by(name, F.when(filled(name), F.col("page_ord"))).alias(name)

    scalars = seen.groupBy(*by).agg(
        F.first("company_website").alias("company_website"), first("person"), first("address")
    )
    lists = value_lists(seen, by, "page_ord")
    none = F.array().cast("array<string>")
    out = scalars.join(lists, by, "left").select(
        *by,
        F.coalesce("phone_numbers", none).alias("phone_numbers"),
        F.coalesce("emails", none).alias("emails"),
        F.col("person").alias("contact_person"),
        "address", "company_website",
        F.array(F.lit("website")).alias("enrichment_sources"),
    )
    return out.where(has_items("phone_numbers") | has_items("emails") | filled("address"))


def value_lists(facts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Arrays ``phones`` and ``emails`` of many rows to one distinct ordered array each."""
    kinds = F.map_from_arrays(F.array(F.lit("phone"), F.lit("email")), F.array("phones", "emails"))
    long = facts.select(*by, F.col(order).alias("_ord"), F.explode(kinds).alias("kind", "vals")).select(
        *by, "_ord", "kind", F.posexplode("vals").alias("pos", "value")
    )
    lists = ordered_values(long, [*by, "kind"], "value", F.struct("_ord", "pos"))
    return lists.groupBy(*by).agg(
        F.first(F.when(F.col("kind") == "phone", F.col("values")), True).alias("phone_numbers"),
        F.first(F.when(F.col("kind") == "email", F.col("values")), True).alias("emails"),
    )


def enrich_from_pages(companies: DataFrame, pages: DataFrame) -> DataFrame:
    """Waterfall stage: the candidate pages of each company that were landed (``pages(url, html)``)."""
    wanted = candidate_pages(companies).join(pages.select("url", "html"), "url")
    facts = page_facts(wanted.select("company", "base_url", "page_ord", "url", "html"))
    return website_contacts(facts.withColumn("url", F.col("base_url")))


def search_contacts(hits: DataFrame, snippets: DataFrame, facts: DataFrame, label: str = "duckduckgo") -> DataFrame:
    """Search stage: snippet contacts first, then those of the pages behind the first two links.

    ``hits(company, rank, link)``, ``snippets(company, rank, snippet)``, ``facts(url, phones,
    emails)``. The website is the first linked page that yielded data.
    """
    from_text = snippets.where(filled("snippet")).select(
        "company", F.struct(F.lit(0).alias("stage"), F.col("rank").alias("n")).alias("at"),
        extract_phones(F.col("snippet")).alias("phones"), extract_emails(F.col("snippet")).alias("emails"),
        F.lit(None).cast("string").alias("site"),
    )
    linked = top_links(hits).join(facts, F.col("link") == F.col("url"))
    useful = has_items("phones") | has_items("emails") | filled("address")
    from_page = linked.where(useful).select(
        "company", F.struct(F.lit(1).alias("stage"), F.col("link_ord").alias("n")).alias("at"),
        "phones", "emails", F.col("link").alias("site"),
    )
    both = from_text.unionByName(from_page)
    lists = value_lists(both, ["company"], "at")
    sites = both.groupBy("company").agg(
        F.min_by("site", F.when(F.col("site").isNotNull(), F.col("at"))).alias("company_website")
    )
    none = F.array().cast("array<string>")
    out = lists.join(sites, "company", "left").select(
        "company",
        F.coalesce("phone_numbers", none).alias("phone_numbers"),
        F.coalesce("emails", none).alias("emails"),
        "company_website",
        F.array(F.lit(label)).alias("enrichment_sources"),
    )
    return out.where(has_items("phone_numbers") | has_items("emails"))
