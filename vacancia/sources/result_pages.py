"""Landed result pages of a listing API: ``results[]`` unnested and projected to postings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import dmy_to_iso, time_stamp
from ..functions.money import render_salary
from ..functions.text import cut, html_to_text
from ..schema import POSTINGS, blank_to_null, conform, packed

ITEM = (
    "jobId bigint, jobTitle string, employerName string, locationName string, "
    "minimumSalary double, maximumSalary double, jobDescription string, date string, "
    "expirationDate string, jobUrl string"
)
DETAIL = (
    "jobId bigint, jobDescription string, contractType string, fullTime boolean, "
    "partTime boolean, salaryType string, externalUrl string"
)

# Fixed value: below this an amount is read as an hourly rate.
HOURLY_BELOW = 1000
# Stored description length of this source: whole texts, unless a caller asks for a cut.
DESCRIPTION_CHARS = None


def parse_pages(pages: DataFrame) -> DataFrame:
    """Page JSON text (column ``body``) to typed pages; unreadable pages give no rows."""
    shape = f"totalResults bigint, results array<struct<{_colon(ITEM)}>>"
    return pages.withColumn("page", F.from_json("body", shape)).select(
        *[c for c in pages.columns if c != "body"], "page.*"
    )


def _colon(fields: str) -> str:
    return ", ".join(":".join(f.strip().split(" ")) for f in fields.split(","))


def explode_results(pages: DataFrame) -> DataFrame:
    """One row per item; ``ord`` orders items by (search, page, position).

    ``search_ord`` numbers the searches; without it ``page_ord`` has to be unique over all of them.
    """
    search = F.col("search_ord") if "search_ord" in pages.columns else F.lit(0)
    return pages.select(
        "keyword", F.col("location").alias("search_location"), "page_ord", search.alias("search_ord"),
        F.posexplode("results").alias("pos", "item"),
    ).select(
        "keyword", "search_location",
        packed(F.col("search_ord"), packed(F.col("page_ord"), F.col("pos"), 16, 20), 36, 26).alias("ord"),
        "item.*",
    )


def project_items(
    items: DataFrame, source: str = "reed", description_chars: int | None = DESCRIPTION_CHARS, now: Column | None = None,
) -> DataFrame:
    """API item to posting; the pay period is guessed from the size of the amount."""
    low, high = F.col("minimumSalary"), F.col("maximumSalary")
    ref = F.coalesce(high, low)
    period = F.when(ref < HOURLY_BELOW, "hourly").when(ref.isNotNull(), "annual")
    out = items.select(
        *[c for c in ("keyword", "search_location") if c in items.columns],
        "ord",
        F.coalesce(F.col("jobId").cast("string"), F.lit("")).alias("job_id"),
        F.lit(source).alias("source"),
        F.coalesce("jobTitle", F.lit("Unknown")).alias("title"),
        F.col("employerName").alias("company"),
        F.col("locationName").alias("location"),
        F.when(ref.isNotNull(), render_salary(low, high, period)).alias("salary_text"),
        low.alias("salary_min"),
        high.alias("salary_max"),
        period.alias("salary_period"),
        cut(blank_to_null(html_to_text(F.col("jobDescription"))), description_chars).alias("description"),
        dmy_to_iso(F.col("date")).alias("posted_at"),
        dmy_to_iso(F.col("expirationDate")).alias("expires_at"),
        F.col("jobUrl").alias("apply_url"),
        time_stamp(now).alias("scraped_at"),
    )
    return out


def top_n(df: DataFrame, n: int, by: list[str], order: str = "ord") -> DataFrame:
    """First ``n`` rows per group: row_number() <= n lets Spark trim groups before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def compose_job_type(full: Column, part: Column, contract: Column) -> Column:
    contract = F.lower(blank_to_null(contract))
    repeated = (F.coalesce(full, F.lit(False)) & (contract == "full-time")) | (
        F.coalesce(part, F.lit(False)) & (contract == "part-time")
    )
    return blank_to_null(
        F.concat_ws(
            ", ", F.when(full, "full-time"), F.when(part, "part-time"),
            F.when(~F.coalesce(repeated, F.lit(False)), contract),
        )
    )


def upgrade_details(
    postings: DataFrame, details: DataFrame, k: int, by: list[str],
    description_chars: int | None = DESCRIPTION_CHARS,
) -> DataFrame:
    """Take the fuller detail row for the first ``k`` postings per search; keep the old on a miss.

    Only keys are ranked, and the rank is trimmed before its shuffle, so a search may have any number of postings.
    """
    rank = F.row_number().over(W.partitionBy(*by).orderBy("ord"))
    first = postings.select(*by, "ord", "job_id").withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
    d = details.select(
        F.col("jobId").cast("string").alias("job_id"),
        cut(blank_to_null(html_to_text(F.col("jobDescription"))), description_chars).alias("_description"),
        compose_job_type(F.col("fullTime"), F.col("partTime"), F.col("contractType")).alias("_job_type"),
        F.when(F.lower("salaryType").contains("hour"), "hourly")
        .when(F.lower("salaryType").rlike("annum|year"), "annual").alias("_period"),
        blank_to_null("externalUrl").alias("_url"),
    )
    found = first.join(d, "job_id").select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate([*by, "ord"])], "_description", "_job_type", "_period", "_url"
    )
    have = set(postings.columns)

    def old(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate([*by, "ord"])])
    joined = postings.join(found, match, "left")
    new = {
        "description": F.coalesce("_description", old("description")),
        "job_type": F.coalesce("_job_type", old("job_type")),
        "salary_period": F.coalesce("_period", old("salary_period")),
        "company_url": F.coalesce(blank_to_null(old("company_url")), "_url", old("company_url")),
    }
    keep = [c for c in postings.columns if c not in new]
    return joined.select(*keep, *[v.alias(k) for k, v in new.items()])


def to_postings(df: DataFrame) -> DataFrame:
    return conform(df, POSTINGS)
