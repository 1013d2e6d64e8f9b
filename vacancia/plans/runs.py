"""Whole runs: import, no-lookup run, resume, enrichment with cache, report, website mining."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cache import cached_contacts, split_cache
from ..operators.clean import clean, filter_since
from ..operators.counts import StageCounts
from ..operators.contacts import first_company_rep, merge_contacts, seed_contacts
from ..operators.dedup import dedup_stats, deduplicate
from ..operators.export import nested_objects
from ..operators.quality import (
    attribution_contacts, attribution_jobs, export_totals, field_coverage, source_counts,
    with_contact_flags,
)
from ..operators.upsert import KeyedTable
from ..operators.waterfall import Enricher, contacts_for, run_waterfall, seed_parts
from ..schema import CONTACTS, RUNS, conform
from ..session import brief_shuffles, landed
from ..sources.registers import resume, seen_hashes, seen_keys


@dataclass
class RunOptions:
    levels: int = 3
    threshold: float = 0.85
    since_days: int | None = None
    cache_days: int = 30
    as_of: Column | None = None
    enrichers: list[tuple[int, Enricher]] = field(default_factory=list)

    def now(self) -> Column:
        return F.current_timestamp() if self.as_of is None else self.as_of

    def stamp(self) -> Column:
        """The run's time as contacts store it, so that a later run finds them fresh."""
        return F.date_format(self.now(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


@dataclass
class RunResult:
    postings: DataFrame
    contacts: DataFrame
    raw: DataFrame
    counts: StageCounts

    def objects(self) -> DataFrame:
        return nested_objects(self.postings, self.contacts)

    def report(self) -> dict[str, DataFrame]:
        flagged = with_contact_flags(self.postings, self.contacts)
        return {
            "sources": source_counts(self.raw, self.postings),
            "dedup": dedup_stats(self.raw.sparkSession, self.counts),
            "coverage": field_coverage(flagged),
            "attribution_jobs": attribution_jobs(self.postings),
            "attribution_contacts": attribution_contacts(self.contacts),
            "totals": export_totals(flagged),
        }


def prepare(raw: DataFrame, options: RunOptions, seen: DataFrame | None = None, counts: StageCounts | None = None) -> DataFrame:
    """De-duplicate, drop what an earlier run stored, apply the recency filter, clean.

    The order is part of the meaning: a stored posting may be the leader that absorbs a new one,
    and the recency filter looks at dates that merging may have filled.
    """
    out = deduplicate(raw, options.levels, options.threshold, counts=counts)
    if seen is not None:
        out = resume(out, seen)
    if options.since_days is not None:
        out = filter_since(out, options.since_days, options.now())
    return clean(out)


def seed_only_contacts(postings: DataFrame, enriched_at: Column | None = None) -> DataFrame:
    """Contacts mined from the postings alone."""
    # Both halves of the merge read the parts: the texts are mined once.
    return merge_contacts(landed(seed_parts(seed_contacts(postings), enriched_at)))


def enrich(postings: DataFrame, options: RunOptions, cached: DataFrame | None = None) -> DataFrame:
    """Contact per company: fresh cache entries reused, the waterfall for everyone else."""
    companies = landed(first_company_rep(postings))
    seeds = landed(seed_contacts(postings))
    if cached is None:
        return contacts_for(companies, run_waterfall(companies, seeds, options.enrichers, options.stamp()))
    fresh, _ = split_cache(conform(cached, CONTACTS), options.cache_days, options.now())
    fresh = fresh.join(companies.select("company"), "company", "left_semi")
    todo = companies.join(fresh.select("company"), "company", "left_anti")
    rest = seeds.join(todo.select("company"), "company", "left_semi")
    looked_up = contacts_for(todo, run_waterfall(todo, rest, options.enrichers, options.stamp()))
    return conform(cached_contacts(fresh, seeds), CONTACTS).unionByName(looked_up)


def run(
    raw: DataFrame, options: RunOptions | None = None, seen: DataFrame | None = None,
    cached: DataFrame | None = None,
) -> RunResult:
    """Full run on normalised postings; ``seen`` are stored postings, or ``seen_keys`` of them. The de-duplicated frame and the contacts are stored once: mining, the report
    and every sink read them."""
    options = options or RunOptions()
    counts = StageCounts()
    postings = landed(prepare(raw, options, seen, counts))
    if options.enrichers or cached is not None:
        contacts = enrich(postings, options, cached)
    else:
        contacts = seed_only_contacts(postings, options.stamp())
    return RunResult(postings, landed(contacts), raw, counts)


def store_run(
    result: RunResult, jobs: KeyedTable, contacts: KeyedTable, runs: KeyedTable, batch: int,
    run_row: DataFrame,
) -> None:
    """Upsert a run's postings, contacts and audit row under one batch number."""
    jobs.write_batch(result.postings, batch)
    contacts.write_batch(result.contacts.withColumn("ord", F.lit(batch).cast("bigint")), batch)
    runs.write_batch(run_row.withColumn("ord", F.lit(batch).cast("bigint")), batch)


def run_audit(
    run_id: str, started: str, finished: str, result: RunResult, jobs: KeyedTable, batch: int,
    rejects: DataFrame | None = None, calls: DataFrame | None = None,
) -> DataFrame:
    """The audit row of a run that is about to be stored under ``batch``.

    ``jobs_scraped`` are the postings kept, ``jobs_new`` those whose key no earlier batch holds, ``jobs_duplicate``
    what de-duplication removed, as counted in passing. Each of ``rejects`` (refused items) is an error, each of ``calls`` one
    call of an outside model.
    """
    def n(df: DataFrame | None) -> int:
        return 0 if df is None else df.count()

    counts = result.counts
    removed = counts.n("raw") - counts.n(counts.stages()[-1])
    kept = result.postings.count()
    with brief_shuffles(result.raw.sparkSession):
        new = jobs.new_keys(result.postings, batch).count() if batch else kept
    row = (run_id, started, finished, kept, new, removed, n(result.contacts), n(calls), n(rejects))
    return result.raw.sparkSession.createDataFrame([row], RUNS)


__all__ = ["RunOptions", "RunResult", "enrich", "prepare", "run", "run_audit", "seen_hashes", "seen_keys", "store_run"]
