"""Three-level de-duplication of postings.

Level 1 keeps the first row per (source, job_id); level 2 merges rows with equal content hash;
level 3 merges near-equal titles within a company. Merging keeps the richest record and fills
its gaps from the others, with the origin of every filled field.

Descriptions are most of the bytes. All three levels shuffle slim rows that carry a reference to
the posting whose description is used; the text itself is joined back once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ..functions.text import content_hash, content_key, hash_of, norm_name
from ..schema import JOB_TRACKED, POSTINGS, conform, filled, filled_sql
from ..session import landed
from .counts import StageCounts
from .fuzzy import THRESHOLD, title_leaders

# Fields that may be filled from another record when null / when empty.
FILL_WHEN_NULL = [
    "description", "salary_text", "salary_min", "salary_max", "salary_period", "job_type",
    "company_url", "location_city", "location_postcode", "posted_at", "expires_at", "apply_url",
]
FILL_WHEN_EMPTY = ["requirements", "benefits"]


def level1(df: DataFrame) -> DataFrame:
    """First row per (source, job_id). row_number() = 1 is trimmed map-side, so no key is hot."""
    rank = F.row_number().over(W.partitionBy("source", "job_id").orderBy("ord"))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def last_per_key(df: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """Last row per key (re-sends replace)."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def origin_map() -> Column:
    """Origin of every populated tracked field of a fresh posting: its own source."""
    return F.expr(_origins())


def _origins(prefix: str = "", slim: bool = False) -> str:
    types = {f.name: f.dataType for f in POSTINGS.fields}
    tests = {n: filled_sql(StructField(prefix + n, types[n])) for n in JOB_TRACKED}
    if slim:
        tests["description"] = f"coalesce({prefix}description.filled, false)"
    marks = [f"CASE WHEN {test} THEN struct('{n}' AS key, array({prefix}source) AS value) END" for n, test in tests.items()]
    return f"map_from_entries(array_compact(array({', '.join(marks)})))"


def completeness(slim: bool = False) -> Column:
    """Number of populated fields out of 23; ``sources`` and the origin map always count."""
    return F.expr(_completeness(slim))


def _completeness(slim: bool, fresh: bool = False) -> str:
    """The digest of a fresh record is not there yet; it counts the same for all of them."""
    skip = {"ord", "sources", "field_sources"} | ({"description"} if slim else set()) | ({"hash"} if fresh else set())
    tests = [filled_sql(f) for f in POSTINGS.fields if f.name not in skip]
    if slim:
        tests.append("coalesce(description.filled, false)")
    return " + ".join(f"CAST({t} AS int)" for t in tests) + " + 2"


def with_hash(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "hash", content_hash(F.col("title"), F.col("company"), F.col("location"), F.col("job_id"))
    )


# Follow from the other fields of a fresh posting, so they are added behind the shuffles.
_DERIVED = ("sources", "field_sources", "hash")
# The key of level 1 and the ordinal: postings that share an ordinal keep their own texts.
_REF = ["source", "job_id", "ord"]


def _slim(df: DataFrame) -> DataFrame:
    ref = F.struct(F.struct(*_REF).alias("ref"), filled("description").alias("filled"))
    return df.withColumn("description", F.when(F.col("description").isNotNull(), ref))


def _restore(slim: DataFrame, full: DataFrame) -> DataFrame:
    texts = full.where(F.col("description").isNotNull()).select(F.struct(*_REF).alias("_ref"), F.col("description").alias("_text"))
    out = slim.withColumn("_ref", F.col("description.ref")).join(texts, "_ref", "left")
    return out.withColumn("description", F.col("_text"))


def merge_groups(df: DataFrame, keys: list[str], fresh: bool = False) -> DataFrame:
    """One record per key: the richest (ties: earliest), gaps filled by (richness, order).

    All aggregates combine map-side and hold one record or a set of source names, so a group may
    be of any size. ``sources`` lists the first record's, then the others by name. ``fresh`` records
    come without sources and origins, which are their own source; the merged ones have them.
    """
    columns = [c for c in df.columns if c not in keys]
    order = "_order"
    # Source and id keep the choice of one record when ordinals repeat.
    rows = df.withColumn(order, F.expr(f"struct(-({_completeness(slim=True, fresh=fresh)}) AS s, ord AS o, source AS p, job_id AS j)"))
    held = {n: f"{n} IS NOT NULL" for n in FILL_WHEN_NULL}
    held |= {n: f"coalesce(size({n}), 0) > 0" for n in FILL_WHEN_EMPTY}

    sources = "array(source)" if fresh else "sources"

    def donor(name: str) -> str:
        if fresh:
            # The order names the source already.
            return f"min(struct({order} AS o, {name} AS v)) FILTER (WHERE {held[name]}) AS _{name}"
        origin = f"coalesce(field_sources['{name}'], array(source))"
        return f"min_by(struct({name} AS v, {origin} AS origin), {order}) FILTER (WHERE {held[name]}) AS _{name}"

    merged = rows.groupBy(*keys).agg(
        *[
            F.expr(e)
            for e in [
                f"min_by(struct({', '.join(columns)}), {order}) AS base",
                "min(ord) AS first_ord",
                f"min_by({sources}, ord) AS first_sources",
                f"collect_set({sources}) AS all_sources",
                *[donor(n) for n in held],
            ]
        ]
    )
    lack = {n: f"base.{n} IS NULL" for n in FILL_WHEN_NULL}
    lack |= {n: f"coalesce(size(base.{n}), 0) <= 0" for n in FILL_WHEN_EMPTY}
    own = _origins("base.", slim=True) if fresh else "base.field_sources"
    gains = ", ".join(
        f"CASE WHEN {test} AND _{n} IS NOT NULL THEN struct('{n}' AS key, {f'array(_{n}.o.p)' if fresh else f'_{n}.origin'} AS value) END"
        for n, test in lack.items()
    )
    special = {
        "ord": "first_ord",
        "sources": "array_distinct(concat(first_sources, array_sort(array_distinct(flatten(all_sources)))))",
        "field_sources": f"map_concat({own}, map_from_entries(array_compact(array({gains}))))",
    }
    special |= {n: f"CASE WHEN {test} THEN coalesce(_{n}.v, base.{n}) ELSE base.{n} END" for n, test in lack.items()}
    columns = list(dict.fromkeys([*columns, "sources", "field_sources"]))
    return merged.selectExpr(*keys, *[f"{special.get(c, f'base.{c}')} AS {c}" for c in columns])


def _start(df: DataFrame) -> DataFrame:
    return conform(df, POSTINGS).drop(*_DERIVED)


def _derived(slim: DataFrame) -> DataFrame:
    return with_hash(slim).withColumn("sources", F.array("source")).withColumn("field_sources", F.expr(_origins(slim=True)))


def _level2(slim: DataFrame) -> DataFrame:
    key = content_key(F.col("title"), F.col("company"), F.col("location"), F.col("job_id"))
    merged = merge_groups(slim.withColumn("_key", key), ["_key"], fresh=True)
    return merged.withColumn("hash", hash_of(F.col("_key"))).drop("_key")


def company_titles(df: DataFrame, match_location: bool = False, blank_company: str = "group") -> DataFrame:
    """Add ``company_key`` and ``norm_title``, the coordinates of near-duplicate search.

    Postings without a company share one key, as an empty name; ``blank_company='skip'`` leaves
    them out of the search, ``match_location`` also asks for the same place.
    """
    key = F.lower(F.coalesce("company", F.lit("")))
    if blank_company == "skip":
        key = F.when(key == "", F.lit(None)).otherwise(key)
    if match_location:
        key = F.concat(key, F.lit("|"), norm_name(F.col("location")))
    return df.withColumn("company_key", key).withColumn("norm_title", norm_name(F.col("title")))


def _level3(slim: DataFrame, threshold: float, match_location: bool, blank_company: str, kind: str) -> DataFrame:
    # Read several times, with the names it is searched by.
    rows = landed(company_titles(slim, match_location, blank_company))
    titles = landed(
        rows.where(F.col("company_key").isNotNull())
        .groupBy("company_key", F.col("norm_title").alias("title"))
        .agg(F.min("ord").alias("tid"), F.count("*").alias("n"))
    )
    absorbed = landed(title_leaders(titles.drop("n"), threshold, kind=kind).groupBy("tid").agg(F.min("leader").alias("leader")))
    heads = absorbed.select(F.col("leader").alias("tid")).distinct().withColumn("leads", F.lit(True))
    # Most rows are alone in their cluster and pass through; only the others are regrouped.
    cluster = titles.join(absorbed, "tid", "left").join(heads, "tid", "left")
    members = landed(
        cluster.where((F.col("n") > 1) | F.col("leader").isNotNull() | F.col("leads"))
        .select("company_key", F.col("title").alias("norm_title"), F.coalesce("leader", "tid").alias("cluster"))
    )
    tagged = rows.join(members, ["company_key", "norm_title"], "left").drop("company_key", "norm_title")
    alone = tagged.where(F.col("cluster").isNull()).drop("cluster")
    merged = merge_groups(tagged.where(F.col("cluster").isNotNull()), ["cluster"]).drop("cluster")
    return alone.unionByName(merged)


def deduplicate(
    df: DataFrame,
    levels: int = 3,
    threshold: float = THRESHOLD,
    match_location: bool = False,
    blank_company: str = "group",
    counts: StageCounts | None = None,
    kind: str = "sequence",
) -> DataFrame:
    """Run the first ``levels`` levels; ``df`` is read once for keys and once for descriptions.

    ``kind`` is the measure of titles, the sequence ratio or ``edit`` similarity. ``counts`` gets the rows of ``raw, level1, level2, level3`` from the job that runs them.
    """
    def counted(stage: str, rows: DataFrame) -> DataFrame:
        return rows if counts is None else counts.at(stage, rows)

    start = _start(df)
    out = counted("level1", level1(counted("raw", _slim(start))))
    if levels < 2:
        out = _derived(out)
    else:
        out = counted("level2", _level2(out))
    if levels >= 3:
        out = counted("level3", _level3(out, threshold, match_location, blank_company, kind))
    elif levels == 2:
        # Stored before the texts come back: the shuffles of both levels need no disk any more.
        out = landed(out)
    return conform(_restore(out, start), POSTINGS)


def dedup_stats(spark: SparkSession, counts: StageCounts) -> DataFrame:
    """One row: raw, unique and removed counts of a de-duplication that has run."""
    raw, unique = counts.n("raw"), counts.n(counts.stages()[-1])
    return spark.createDataFrame([(raw, unique, raw - unique)], "raw_total long, unique_total long, removed long")
