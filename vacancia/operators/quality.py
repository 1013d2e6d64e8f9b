"""Quality and provenance reports as tidy frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CONTACT_TRACKED, JOB_TRACKED, filled, has_items


def per_source_raw(postings: DataFrame) -> DataFrame:
    return postings.groupBy("source").agg(F.count("*").alias("n"))


def per_source_unique(unique: DataFrame) -> DataFrame:
    """A posting counts once for each of its sources."""
    own = F.when(has_items("sources"), F.col("sources")).otherwise(F.array("source"))
    return unique.select(F.explode(own).alias("source")).groupBy("source").agg(F.count("*").alias("n"))


def source_counts(raw: DataFrame, unique: DataFrame) -> DataFrame:
    """Raw and unique counts side by side; a source missing on one side counts zero there."""
    r = per_source_raw(raw).withColumnRenamed("n", "raw")
    u = per_source_unique(unique).withColumnRenamed("n", "unique_n")
    both = r.join(u, "source", "full_outer")
    return both.select(
        "source", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("unique_n", F.lit(0)).alias("unique_n")
    )


def with_contact_flags(postings: DataFrame, contacts: DataFrame) -> DataFrame:
    """Add ``has_contact``, ``has_phone``, ``has_email``; a blank company never matches."""
    flags = contacts.select(
        F.col("company").alias("_company"), F.lit(True).alias("_hit"),
        has_items("phone_numbers").alias("_phone"), has_items("emails").alias("_email"),
    )
    j = postings.join(flags, filled("company") & (F.col("company") == F.col("_company")), "left")
    no = F.lit(False)
    return j.withColumns(
        {
            "has_contact": F.coalesce("_hit", no), "has_phone": F.coalesce("_phone", no),
            "has_email": F.coalesce("_email", no),
        }
    ).drop("_company", "_hit", "_phone", "_email")


def field_coverage(flagged: DataFrame) -> DataFrame:
    """One row per field: populated rows, all rows, share rounded half-even to 3 places."""
    tests = {
        "company": filled("company"), "location": filled("location"),
        "salary": F.col("salary_min").isNotNull() | filled("salary_text"),
        "description": filled("description"), "posted_at": filled("posted_at"),
        "requirements": has_items("requirements"), "benefits": has_items("benefits"),
        "phone": F.col("has_phone"), "email": F.col("has_email"),
    }
    one = flagged.agg(F.count("*").alias("total"), *[F.count_if(t).alias(f) for f, t in tests.items()])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n")) for f in tests])
    long = one.select("total", F.explode(pairs).alias("p")).select("p.field", "p.n", "total")
    share = F.when(F.col("total") > 0, F.bround(F.col("n") / F.col("total"), 3)).otherwise(F.lit(0.0))
    return long.withColumn("coverage", share)


def _attribution(df: DataFrame, tracked: list[str]) -> DataFrame:
    long = df.select(F.explode("field_sources").alias("field", "origins")).where(F.col("field").isin(tracked))
    return long.select("field", F.explode("origins").alias("origin")).groupBy("field", "origin").agg(
        F.count("*").alias("n")
    )


def attribution_jobs(postings: DataFrame) -> DataFrame:
    """How many postings got each field from each origin."""
    return _attribution(postings, JOB_TRACKED)


def attribution_contacts(contacts: DataFrame) -> DataFrame:
    return _attribution(contacts, CONTACT_TRACKED)


def attribution_lines(attribution: DataFrame) -> DataFrame:
    """One line per field, ``origin: n, ...`` with the largest first (ties by origin name)."""
    item = F.struct((-F.col("n")).alias("k"), F.col("origin"))
    text = F.transform(
        F.array_sort(F.collect_list(item)), lambda x: F.concat(x["origin"], F.lit(": "), (-x["k"]).cast("string"))
    )
    return attribution.groupBy("field").agg(F.array_join(text, ", ").alias("line"))


def export_totals(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count("*").alias("total_jobs"),
        F.count_if("has_contact").alias("total_with_contact"),
        F.count_if("has_phone").alias("total_with_phone"),
        F.count_if("has_email").alias("total_with_email"),
    )


def kpi_summary(flagged: DataFrame) -> DataFrame:
    """(metric, value) rows: totals, then one row per source."""
    t = flagged.agg(
        F.count("*").alias("total_jobs"),
        F.count_if("has_phone").alias("with_phone"),
        F.count_if("has_email").alias("with_email"),
        F.count_if(F.col("has_phone") | F.col("has_email")).alias("with_any_contact"),
    )
    metrics = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in t.columns]
    )
    totals = t.select(F.explode(metrics).alias("m")).select("m.metric", "m.value")
    sources = flagged.groupBy("source").agg(F.count("*").alias("value")).select(
        F.concat(F.lit("source:"), F.col("source")).alias("metric"), "value"
    )
    return totals.unionByName(sources)


def counts_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def has_origin(field: str, origin: str) -> Column:
    """Stored-provenance predicate: the field's value came from ``origin``."""
    return F.coalesce(F.array_contains(F.col("field_sources")[field], origin), F.lit(False))
