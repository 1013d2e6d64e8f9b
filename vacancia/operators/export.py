"""Export shapes and writers. Every writer is a distributed write of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import filled, has_items
from .quality import export_totals, with_contact_flags

# CSV column order of both exports.
JOB_CSV = [
    "job_id", "sources", "title", "company", "location", "location_city", "location_postcode",
    "salary_text", "salary_min", "salary_max", "salary_period", "job_type", "posted_at",
    "expires_at", "apply_url", "scraped_at",
]
CONTACT_CSV = [
    "company", "phone_numbers", "emails", "contact_person", "address", "company_website",
    "company_number", "company_type", "confidence_score", "ai_used", "enrichment_sources",
]
_CONTACT_BLOCK = [
    "phone_numbers", "emails", "contact_person", "address", "website", "company_number",
    "company_type", "confidence_score", "ai_used", "enrichment_sources", "field_sources", "changes",
]
_OBJECT = [
    "job_id", "sources", "title", "company", "company_url", "location", "location_city",
    "location_postcode", "salary_text", "salary_min", "salary_max", "salary_period", "job_type",
    "description", "requirements", "benefits", "posted_at", "expires_at", "apply_url", "contact",
    "field_sources", "hash", "scraped_at",
]


def nested_objects(postings: DataFrame, contacts: DataFrame) -> DataFrame:
    """Posting rows with their company's contact as a struct, null where there is none."""
    block = contacts.withColumnRenamed("company_website", "website").select(
        F.col("company").alias("_company"), F.struct(*_CONTACT_BLOCK).alias("contact")
    )
    own = F.when(has_items("sources"), F.col("sources")).otherwise(F.array("source"))
    j = postings.join(block, filled("company") & (F.col("company") == F.col("_company")), "left")
    return j.withColumn("sources", own).select("ord", *_OBJECT)


def jobs_csv(postings: DataFrame) -> DataFrame:
    own = F.when(has_items("sources"), F.col("sources")).otherwise(F.array("source"))
    return postings.withColumn("sources", F.array_join(own, "|")).select(*JOB_CSV)


def contacts_csv(contacts: DataFrame) -> DataFrame:
    lists = ("phone_numbers", "emails", "enrichment_sources")
    return contacts.withColumns({c: F.array_join(c, "|") for c in lists}).select(*CONTACT_CSV)


def preview(objects: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` objects in order, as JSON, without writing anything."""
    names = [c for c in objects.columns if c != "ord"]
    return objects.orderBy("ord").limit(n).select("ord", F.to_json(F.struct(*names)).alias("json"))


def page(df: DataFrame, skip: int, take: int) -> DataFrame:
    return df.orderBy("ord").offset(skip).limit(take)


Writer = Callable[[DataFrame, DataFrame, str], None]


def write_json(postings: DataFrame, contacts: DataFrame, path: str) -> None:
    """One JSON object per posting, and the totals in a side folder."""
    nested_objects(postings, contacts).drop("ord").write.mode("overwrite").json(f"{path}/jobs_json")
    export_totals(with_contact_flags(postings, contacts)).write.mode("overwrite").json(f"{path}/totals_json")


def write_csv(postings: DataFrame, contacts: DataFrame, path: str) -> None:
    jobs_csv(postings).write.mode("overwrite").csv(f"{path}/jobs_csv", header=True)
    contacts_csv(contacts).write.mode("overwrite").csv(f"{path}/contacts_csv", header=True)


def write_parquet(postings: DataFrame, contacts: DataFrame, path: str) -> None:
    postings.write.mode("overwrite").parquet(f"{path}/jobs")
    contacts.write.mode("overwrite").parquet(f"{path}/contacts")


WRITERS: dict[str, Writer] = {"json": write_json, "csv": write_csv, "parquet": write_parquet}


def register_writer(name: str, writer: Writer) -> None:
    WRITERS[name] = writer


def export_all(postings: DataFrame, contacts: DataFrame, path: str, formats: list[str]) -> dict[str, str]:
    """Write several formats from one cached result; a failing format does not stop the others."""
    status: dict[str, str] = {}
    jobs, people = postings.persist(), contacts.persist()
    try:
        for name in formats:
            try:
                WRITERS[name](jobs, people, path)
                status[name] = "ok"
            except Exception as error:  # one sink's failure is reported, not raised
                status[name] = f"failed: {type(error).__name__}: {error}"
    finally:
        jobs.unpersist()
        people.unpersist()
    return status
