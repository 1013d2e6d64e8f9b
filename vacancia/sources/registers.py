"""Other landed inputs: search sweeps, search results, registers, and stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.phones import clean_phone, extract_phones
from ..functions.text import clean_email, content_key, extract_emails, html_to_text, is_json, join_parts
from ..schema import CONTACTS, blank_to_null, conform, filled, first_filled

Source = Callable[[SparkSession, str], DataFrame]
_SOURCES: dict[str, Source] = {}


def register_source(name: str, reader: Source) -> None:
    """Plug in a source: ``reader(spark, path)`` returns postings."""
    _SOURCES[name] = reader


def read_source(spark: SparkSession, name: str, path: str) -> DataFrame:
    return _SOURCES[name](spark, path)


def source_names() -> list[str]:
    return sorted(_SOURCES)


def source_filter(source: Column, wanted: list[str]) -> Column:
    """Source name match that ignores underscores."""
    return F.replace(source, F.lit("_"), F.lit("")).isin([w.replace("_", "") for w in wanted])


def search_sweep(keywords: DataFrame, locations: DataFrame, landed: DataFrame) -> DataFrame:
    """Every keyword x location search with its landed rows; a search without rows stays, empty.

    Both lists are a run's settings. The locations travel as one array value, so listing the
    searches is an explode and not a product join; landed rows meet them in an equi join.
    """
    places = locations.agg(F.array_sort(F.collect_set("location"))).scalar()
    searches = keywords.select("keyword").distinct().select("keyword", F.explode(places).alias("location"))
    return searches.join(landed, ["keyword", "location"], "left")


def search_hits(results: DataFrame, own_host: str = "duckduckgo.com") -> DataFrame:
    """Outside http links of a result list, in rank order."""
    link = F.col("link")
    return results.where(F.startswith(link, F.lit("http")) & ~F.contains(link, F.lit(own_host)))


def _present(df: DataFrame, *names: str) -> Column:
    """The first spelling of a field that a row has."""
    cols = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*cols) if cols else F.lit(None).cast("string")


def charity_text_parts(pages: DataFrame, items: int = 3) -> DataFrame:
    """Charity result pages read as text (``company, html``): the first phones and e-mails, if there are any."""
    text = pages.select("company", html_to_text(F.col("html")).alias("t"))
    out = text.select(
        "company", F.slice(extract_phones(F.col("t")), 1, items).alias("phone_numbers"),
        F.slice(extract_emails(F.col("t")), 1, items).alias("emails"), F.lit("charity").alias("company_type"),
        F.array(F.lit("charities")).alias("enrichment_sources"),
    )
    return out.where((F.size("phone_numbers") > 0) | (F.size("emails") > 0))


def charity_parts(matches: DataFrame) -> DataFrame:
    """Matched charity-register rows to contact fields; first present spelling of a field counts."""
    def present(*names: str) -> Column:
        return _present(matches, *names)

    phone = clean_phone(blank_to_null(present("charity_contact_phone", "phone")))
    email = clean_email(blank_to_null(present("charity_contact_email", "email")))
    address = join_parts(
        *[present(f"charity_contact_{p}") for p in ("address1", "address2", "address3", "postcode")]
    )
    out = matches.select(
        "company",
        F.array_compact(F.array(phone)).alias("phone_numbers"),
        F.array_compact(F.array(email)).alias("emails"),
        address.alias("address"),
        blank_to_null(present("charity_contact_web", "website")).alias("company_website"),
        F.lit("charity").alias("company_type"),
        F.array(F.lit("charities")).alias("enrichment_sources"),
    )
    return out.where((F.size("phone_numbers") > 0) | (F.size("emails") > 0) | F.col("address").isNotNull())


def care_parts(matches: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Matched care-register rows to contact fields.

    The detail table is consulted only where phone or address is missing; it fills a missing
    phone and names the first contact.
    """
    m = matches.withColumn("_phone", clean_phone(blank_to_null(_present(matches, "phone", "telephone")))).withColumn(
        "_address",
        join_parts(
            *[F.col(c) for c in ("postalAddressLine1", "postalAddressLine2", "postalAddressTownCity", "postalCode")]
        ),
    )
    phone, person = F.col("_phone"), F.lit(None).cast("string")
    if details is not None:
        first = F.get("contacts", F.lit(0))
        name = F.trim(
            F.concat_ws(
                " ", *[F.coalesce(first[k], F.lit("")) for k in ("personTitle", "personGivenName", "personFamilyName")]
            )
        )
        d = details.select(
            "providerId",
            clean_phone(blank_to_null(_present(details, "phone", "telephone"))).alias("_detail_phone"),
            blank_to_null(name).alias("_detail_person"),
        )
        m = m.join(d, "providerId", "left")
        lacking = F.col("_phone").isNull() | F.col("_address").isNull()
        phone = F.coalesce(F.col("_phone"), F.when(lacking, F.col("_detail_phone")))
        person = F.when(lacking, F.col("_detail_person"))
    out = m.select(
        "company",
        F.array_compact(F.array(phone)).alias("phone_numbers"),
        F.array().cast("array<string>").alias("emails"),
        person.alias("contact_person"),
        F.col("_address").alias("address"),
        blank_to_null("website").alias("company_website"),
        F.coalesce("type", F.lit("care_provider")).alias("company_type"),
        F.array(F.lit("cqc")).alias("enrichment_sources"),
    )
    return out.where((F.size("phone_numbers") > 0) | F.col("address").isNotNull())


def read_cached_contacts(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Stored contacts to the contact schema: JSON text columns decoded, older layouts widened."""
    json_types = {
        "phone_numbers": "array<string>", "emails": "array<string>",
        "enrichment_sources": "array<string>", "field_sources": "map<string,array<string>>",
    }
    out = df
    if "website" in df.columns and "company_website" not in df.columns:
        out = out.withColumnRenamed("website", "company_website")
    for name, kind in json_types.items():
        if name not in out.columns:
            continue
        if dict(out.dtypes)[name] == "string":
            out = out.withColumn(name, F.from_json(name, kind))
        if kind.startswith("array"):
            out = out.withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return conform(out, CONTACTS).withColumn("confidence_score", F.coalesce("confidence_score", F.lit(0)))


def seen_hashes(postings: DataFrame) -> DataFrame:
    return postings.select("hash").where(F.col("hash").isNotNull()).distinct()


def _content_key() -> Column:
    return content_key(F.col("title"), F.col("company"), F.col("location"), F.col("job_id"))


def seen_keys(postings: DataFrame) -> DataFrame:
    """``content_key`` of stored postings, whole: two contents may share the digits of a ``hash``."""
    return postings.select(_content_key().alias("content_key")).distinct()


def resume(postings: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop postings whose content was stored by an earlier run; ``seen`` are its postings or their keys."""
    keys = (seen if "content_key" in seen.columns else seen_keys(seen)).select(F.col("content_key").alias("_seen"))
    return postings.join(keys, _content_key() == F.col("_seen"), "left_anti")


def parse_response(raw: Column, fields: str) -> Column:
    """JSON object out of a free-text reply: fences stripped, else the outermost braces.

    ``fields`` is a DDL field list. Null when neither reading parses.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^\s*```(?:json)?\s*", ""), r"\s*```\s*$", "")
    braces = blank_to_null(F.regexp_extract(bare, r"(?s)\{.*\}", 0))
    text = F.when(is_json(bare), bare).when(is_json(braces), braces)
    return F.from_json(text, fields)


def literal_guard(description: Column, phone: Column, email: Column) -> tuple[Column, Column]:
    """Proposed phone and e-mail, kept only when they are printed in the text itself."""
    phone_ok = F.contains(description, phone) | F.contains(
        description, F.replace(phone, F.lit(" "), F.lit(""))
    )
    email_ok = F.contains(F.lower(description), email)
    return F.when(phone_ok, phone), F.when(email_ok, email)


def trusted_value(clean: Column, raw: Column, confidence: Column) -> Column:
    """Cleaned value; else the raw one unless confidence is low; the text 'null' is no value."""
    known = filled(raw) & (raw != "null")
    sure = F.coalesce(confidence, F.lit("low")) != "low"
    return F.when(known, F.coalesce(clean, F.when(sure, raw)))


def model_parts(replies: DataFrame) -> DataFrame:
    """Replies of an outside model (``company, provider, raw_response``) to contact fields."""
    r = replies.select(
        "company",
        first_filled("provider", F.lit("ai")).alias("provider"),
        parse_response(
            F.col("raw_response"),
            "phone string, email string, contact_person string, address string, website string, "
            "confidence string",
        ).alias("r"),
    ).select("company", "provider", "r.*")

    def text(name: str) -> Column:
        return F.when(filled(name) & (F.col(name) != "null"), F.col(name))

    phone = trusted_value(clean_phone(F.col("phone")), F.col("phone"), F.col("confidence"))
    email = trusted_value(clean_email(F.col("email")), F.col("email"), F.col("confidence"))
    out = r.select(
        "company",
        F.array_compact(F.array(phone)).alias("phone_numbers"),
        F.array_compact(F.array(email)).alias("emails"),
        text("contact_person").alias("contact_person"),
        text("address").alias("address"),
        text("website").alias("company_website"),
        F.array("provider").alias("enrichment_sources"),
        F.lit(True).alias("ai_used"),
    )
    return out.where((F.size("phone_numbers") > 0) | (F.size("emails") > 0) | F.col("address").isNotNull())


def parse_candidates(postings: DataFrame, seeds: DataFrame) -> DataFrame:
    """Postings worth a costly parse: text present, and structure or the company's contact missing."""
    s = seeds.select(F.col("company").alias("_c"), F.lit(True).alias("_seeded"))
    j = postings.join(s, F.col("company") == F.col("_c"), "left")
    needs = (F.coalesce(F.size("requirements"), F.lit(0)) <= 0) | (
        F.coalesce(F.size("benefits"), F.lit(0)) <= 0
    )
    seeded = filled("company") & F.coalesce("_seeded", F.lit(False))
    want = filled("description") & ~(seeded & ~needs) & (needs | filled("company"))
    return j.where(want).drop("_c", "_seeded")
