"""Contact records: mining from postings, priority merge of parts, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.phones import extract_phones
from ..functions.text import emails_by_priority, extract_emails
from ..schema import CONTACT_PARTS, blank_to_null, conform, filled, has_items

# Which origin is believed first, per field.
PERSON_PRIORITY = [
    "job_description", "website", "companies_house", "charities", "cqc", "duckduckgo",
    "serpapi", "gemini", "ollama", "anthropic", "ai",
]
ADDRESS_PRIORITY = [
    "companies_house", "cqc", "charities", "website", "job_description", "duckduckgo",
    "serpapi", "gemini", "ollama", "anthropic", "ai",
]


def ordered_values(long: DataFrame, keys: list[str], value: str, order: Column, match: Column | None = None) -> DataFrame:
    """Distinct values per key in order of first appearance, as an array ``values``.

    ``match`` compares values (lower case, say) while the first spelling is kept. Duplicates are
    combined map-side before anything is collected, so an array holds the distinct values only.
    """
    m = F.col(value) if match is None else match
    first = long.groupBy(*keys, m.alias("_m")).agg(
        F.min_by(F.col(value), order).alias("_v"), F.min(order).alias("_o")
    )
    return first.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_o", "_v"))), lambda x: x["_v"]).alias("values")
    )


def first_company_rep(postings: DataFrame) -> DataFrame:
    """Each company once, with link and place of its first posting (nulls of that row kept)."""
    rep = F.min_by(F.struct("company_url", "location"), F.col("ord")).alias("rep")
    return postings.where(filled("company")).groupBy("company").agg(rep).select("company", "rep.*")


def two_lists(long: DataFrame) -> DataFrame:
    """(company, kind, value, o) to one row per company with phone and e-mail arrays."""
    lists = ordered_values(long, ["company", "kind"], "value", F.col("o"))
    none = F.array().cast("array<string>")

    def of(kind: str) -> Column:
        return F.coalesce(F.first(F.when(F.col("kind") == kind, F.col("values")), True), none)

    return lists.groupBy("company").agg(of("phone").alias("phone_numbers"), of("email").alias("emails"))


def mine_contacts(postings: DataFrame, text: str = "description") -> DataFrame:
    """Long form of phones and e-mails printed in the texts: company, kind, value, o=(ord, pos)."""
    found = postings.where(filled(text) & filled("company")).select(
        "company", "ord",
        F.map_from_arrays(
            F.array(F.lit("phone"), F.lit("email")),
            F.array(extract_phones(F.col(text)), extract_emails(F.col(text))),
        ).alias("found"),
    )
    kinds = found.select("company", "ord", F.explode("found").alias("kind", "vals"))
    return kinds.select("company", "kind", "ord", F.posexplode("vals").alias("pos", "value")).select(
        "company", "kind", "value", F.struct("ord", "pos").alias("o")
    )


def seed_contacts(postings: DataFrame) -> DataFrame:
    """Contact part per company from its own postings, values in order of first appearance."""
    found = two_lists(mine_contacts(postings))
    return found.withColumn("enrichment_sources", F.array(F.lit("job_description")))


def as_parts(df: DataFrame, priority: int, enriched_at: Column | None = None) -> DataFrame:
    """Contact fields of one lookup to the long-form part schema."""
    out = df.withColumn("priority", F.lit(priority))
    if "part_ord" not in df.columns:
        out = out.withColumn("part_ord", F.lit(0).cast("bigint"))
    if "ai_used" not in df.columns:
        out = out.withColumn("ai_used", F.lit(False))
    if "enriched_at" not in df.columns:
        out = out.withColumn("enriched_at", F.lit(None).cast("string") if enriched_at is None else enriched_at)
    out = conform(out, CONTACT_PARTS)
    none = F.array().cast("array<string>")
    return out.withColumns(
        {c: F.coalesce(c, none) for c in ("phone_numbers", "emails", "enrichment_sources")}
    )


def confidence(
    phones: Column, emails: Column, number: Column, person: Column, website: Column,
    ai_used: Column, sources: Column,
) -> Column:
    """0-100 from the fields present, less for a lone model answer, more for the advert's own text."""
    def points(cond: Column, n: int) -> Column:
        return F.when(cond, n).otherwise(0)

    total = (
        points(has_items(phones), 30) + points(has_items(emails), 30) + points(filled(number), 20)
        + points(filled(person), 10) + points(filled(website), 10)
        - points(ai_used & (F.size(sources) == 1), 20)
        + points(F.array_contains(sources, "job_description"), 10)
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), total))


def confidence_band(score: Column) -> Column:
    return F.when(score >= 70, "green").when(score >= 40, "amber").otherwise("red")


def merge_contacts(parts: DataFrame) -> DataFrame:
    """All parts of a company to one contact, with the origin of every field.

    Scalar fields are ordered minima that combine map-side; phones, e-mails and sources are
    reduced to distinct values before they are collected. Both halves are grouped by company, so
    joining them needs no further shuffle of the parts.
    """
    o = F.struct("priority", "part_ord")
    label = F.coalesce(F.get("enrichment_sources", F.lit(0)), F.lit("unknown"))
    p = parts.withColumn("o", o).withColumn("label", label)

    def first_of(name: str, ok: Column) -> Column:
        pair = F.struct(F.col(name).alias("v"), F.col("label").alias("src"))
        return F.min_by(F.when(ok, pair), F.when(ok, F.col("o")))

    # Only the last part under a label can speak for that label.
    labels = {
        f"_l_{name}": F.max_by(
            F.when(F.col("label") == name, F.struct("contact_person", "address")),
            F.when(F.col("label") == name, F.col("o")),
        )
        for name in PERSON_PRIORITY
    }

    def change(key: str) -> Column:
        c = F.col("changes")[key]
        return F.max_by(F.when(c.isNotNull(), c), F.when(c.isNotNull(), F.col("o")))

    scalars = p.groupBy("company").agg(
        *[c.alias(n) for n, c in labels.items()],
        F.coalesce(
            first_of("company_website", F.startswith("company_website", F.lit("https"))),
            first_of("company_website", filled("company_website")),
        ).alias("_website"),
        first_of("company_number", filled("company_number")).alias("_number"),
        first_of("company_type", filled("company_type")).alias("_type"),
        F.max(F.coalesce("ai_used", F.lit(False))).alias("ai_used"),
        F.max(blank_to_null("enriched_at")).alias("enriched_at"),
        change("phone_numbers").alias("_ch_phones"),
        change("emails").alias("_ch_emails"),
    )

    kinds = F.map_from_arrays(
        F.array(F.lit("phone"), F.lit("email"), F.lit("source")),
        F.array("phone_numbers", "emails", "enrichment_sources"),
    )
    long = (
        p.select("company", "o", "label", F.explode(kinds).alias("kind", "vals"))
        .select("company", "o", "label", "kind", F.posexplode("vals").alias("pos", "value"))
        .where(filled("value"))
        .withColumn("m", F.when(F.col("kind") == "email", F.lower("value")).otherwise(F.col("value")))
        .withColumn("at", F.struct("o", "pos"))
    )
    firsts = long.groupBy("company", "kind", "m").agg(
        F.min_by(F.struct("value", "label"), F.col("at")).alias("first"), F.min("at").alias("at")
    )

    def collected(kind: str) -> Column:
        item = F.struct("at", "first.value", "first.label")
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, item)))

    lists = firsts.groupBy("company").agg(
        collected("phone").alias("_phones"), collected("email").alias("_emails"),
        collected("source").alias("_sources"),
    )
    m = scalars.join(lists, "company", "left")

    def values(c: str) -> Column:
        return F.coalesce(F.transform(c, lambda x: x["value"]), F.array().cast("array<string>"))

    def origins(c: str) -> Column:
        found = F.array_distinct(F.transform(c, lambda x: x["label"]))
        return F.when(F.size(found) > 0, found)

    def by_label(field: str, order: list[str]) -> tuple[Column, Column]:
        vals = [blank_to_null(f"_l_{s}.{field}") for s in order]
        srcs = [F.when(v.isNotNull(), F.lit(s)) for v, s in zip(vals, order)]
        return F.coalesce(*vals), F.coalesce(*srcs)

    person, person_src = by_label("contact_person", PERSON_PRIORITY)
    address, address_src = by_label("address", ADDRESS_PRIORITY)

    def one(src: Column) -> Column:
        return F.when(src.isNotNull(), F.array(src))

    origin = {
        "phone_numbers": origins("_phones"), "emails": origins("_emails"),
        "contact_person": one(person_src), "address": one(address_src),
        "company_website": one(F.col("_website.src")), "company_number": one(F.col("_number.src")),
        "company_type": one(F.col("_type.src")),
    }
    m = m.select(
        "company",
        values("_phones").alias("phone_numbers"),
        emails_by_priority(values("_emails")).alias("emails"),
        person.alias("contact_person"),
        address.alias("address"),
        F.col("_website.v").alias("company_website"),
        F.col("_number.v").alias("company_number"),
        F.col("_type.v").alias("company_type"),
        values("_sources").alias("enrichment_sources"),
        "ai_used", "enriched_at",
        _entries(origin).alias("field_sources"),
        _entries({"phone_numbers": F.col("_ch_phones"), "emails": F.col("_ch_emails")}).alias("changes"),
    )
    return m.withColumn("confidence_score", score_of()).select(
        *[f for f in m.columns[:11]], "confidence_score", "field_sources", "changes"
    )


def score_of() -> Column:
    return confidence(
        F.col("phone_numbers"), F.col("emails"), F.col("company_number"), F.col("contact_person"),
        F.col("company_website"), F.col("ai_used"), F.col("enrichment_sources"),
    )


def _entries(values: dict[str, Column]) -> Column:
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def enough(phones: Column | str = "phone_numbers", emails: Column | str = "emails") -> Column:
    return has_items(phones) & has_items(emails)
