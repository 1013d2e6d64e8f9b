"""Near-duplicate titles within a company: greedy leader clustering.

Semantics: titles of one company in order of first appearance; a title joins the earliest leader
whose title is similar enough, else it becomes a leader. Leaders are the lexicographically first
maximal independent set of the similarity graph.

A company of few titles is gone through in one piece. The titles of a larger one meet in blocks of bounded
size by length, each pair of which is one row and yields the similar pairs; the graph of these is settled
from its first titles on. Masses of alike titles would be too many pairs: a company that has blocks full of
them is left to rounds of joins, which do without placing it in one task and without writing out all its pairs:

1. titles meet only in buckets of lossless signatures; a company of few titles is one bucket;
2. a round looks at the first few undecided titles of every bucket. A title that is inside that
   window in *all* its buckets and has no similar undecided title before it is a leader. The
   window starts small and doubles: masses of alike titles are absorbed while it is small, and
   only unlike ones are left when it is large;
3. new leaders absorb similar titles of their buckets, also beyond the window. Many mutually
   similar titles therefore cost one comparison each, not one per pair.

The earliest undecided title always becomes a leader, so the rounds end without a round limit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.similarity import (
    bag_bits, edit_similarity, first_leaders, length_compatible, may_reach, near_titles, ratio_at_least, shared_buckets, signatures, taken_in_order,
)
from ..session import landed

THRESHOLD = 0.85
FIRST_WINDOW = 4
# Companies of up to this many titles are one bucket: comparing all of them is cheaper than keys.
SMALL_COMPANY = 64
# Titles of a company that meet at once, similar pairs a title beyond which a block is crowded, and pairs that one task
# settles; results do not depend on them.
BLOCK, CROWDED, AT_ONCE = 16_384, 64, 1_000_000


def _similar(pairs: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Pairs (early, early_title, late, late_title) at or above the threshold."""
    early, late = F.col("early_title"), F.col("late_title")
    near = pairs.where(length_compatible(early, late, threshold, kind)).distinct()
    if kind == "edit":
        return near.where(edit_similarity(early, late) >= threshold)
    return near.where(may_reach(early, late, threshold)).where(ratio_at_least(threshold)(early, late).isNotNull())


def _against_leaders(rows: DataFrame, leaders: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Rows against the leaders before them in their buckets; hot buckets are spread over salts."""
    early = leaders.select(
        "bucket", "company_key", F.col("tid").alias("early"), F.col("title").alias("early_title"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    late = rows.select(
        "bucket", "company_key", F.col("tid").alias("late"), F.col("title").alias("late_title"),
        F.pmod(F.hash("tid"), F.col("salts")).alias("salt"),
        *[c for c in ("known",) if c in rows.columns],
    )
    # Buckets are hashes: the company itself is compared too.
    pairs = early.join(late, ["bucket", "salt", "company_key"]).where(F.col("early") < F.col("late"))
    if "known" in rows.columns:
        pairs = pairs.where(F.col("early") < F.col("known"))
    return _similar(pairs.select("early", "early_title", "late", "late_title"), threshold, kind)


def _keyed(titles: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Titles once per bucket. Companies of a single title have no pair and are left out."""
    n_titles = titles.groupBy("company_key").agg(F.count("*").alias("_titles")).where(F.col("_titles") > 1)
    sized = titles.join(n_titles, "company_key")
    few = sized.where(F.col("_titles") <= SMALL_COMPANY).select(
        "tid", "title", "company_key", F.xxhash64("company_key").alias("bucket"))
    keys = signatures(threshold, kind)
    many = sized.where(F.col("_titles") > SMALL_COMPANY).select(
        "tid", "title", F.explode(keys(F.col("title"))).alias("sig"), "company_key"
    ).select("tid", "title", "company_key", F.xxhash64("company_key", "sig").alias("bucket"))
    return few.unionByName(many)


def title_leaders(
    titles: DataFrame, threshold: float = THRESHOLD, window: int = FIRST_WINDOW, kind: str = "sequence",
) -> DataFrame:
    """Map absorbed titles to their leader.

    ``titles`` has one row per (company_key, title) with ``tid``, the ordinal of its first
    posting. Returns ``company_key, title, tid, leader`` (the leader's tid) for titles that are
    not leaders themselves. ``kind='edit'`` compares by edit distance. ``window`` is the first one of the rounds.
    """
    rows = titles.where(F.col("tid").isNotNull()).select("company_key", "title", F.col("tid").cast("bigint").alias("tid"))
    sizes = rows.groupBy("company_key").agg(F.count("*").alias("_titles")).where(F.col("_titles") > 1)
    few = rows.join(sizes.where(F.col("_titles") <= SMALL_COMPANY), "company_key").groupBy("company_key").agg(
        F.array_sort(F.collect_list(F.struct("tid", "title"))).alias("held"))
    few = few.select("company_key", F.col("held.tid").alias("tids"), F.col("held.title").alias("titles"))
    out = few.mapInPandas(first_leaders(threshold, kind), "company_key string, title string, tid bigint, leader bigint")

    many = landed(
        rows.join(sizes.where(F.col("_titles") > SMALL_COMPANY), "company_key").select("company_key", "title", "tid", "_titles", bag_bits(F.col("title")).alias("bits")))
    if many.isEmpty():
        return out
    found = landed(_blocks(many, threshold, kind).mapInPandas(near_titles(threshold, kind, CROWDED), "company_key string, early bigint, late bigint"))
    pairs = found.where(F.col("early").isNotNull()).select("early", "late")
    crowded = found.where(F.col("early").isNull()).select("company_key").distinct()
    of = many.select("company_key", "title", "tid")
    if not crowded.isEmpty():
        masses = of.join(crowded, "company_key", "left_semi")
        out = out.unionByName(_in_rounds(masses, threshold, window, kind))
        pairs = pairs.join(masses.select(F.col("tid").alias("early")), "early", "left_anti")
    return out.unionByName(of.join(_settled(pairs), "tid").select("company_key", "title", "tid", "leader"))


def _blocks(many: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Pairs of blocks of a company whose titles' lengths may go together; a block beside itself has no second one."""
    size = F.length("title")
    # One block, or blocks of one length each.
    rows = many.withColumn("_length", F.when(F.col("_titles") <= BLOCK, F.lit(0)).otherwise(size))
    parts = rows.groupBy("company_key", "_length").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("_parts"))
    dealt = rows.join(parts, ["company_key", "_length"]).withColumn("_part", F.pmod(F.xxhash64("title"), F.col("_parts")).cast("int"))
    blocks = landed(
        dealt.groupBy("company_key", "_length", "_part").agg(F.collect_list(F.struct("tid", "title", "bits")).alias("held"), F.min(size).alias("_size")))

    def side(name: str) -> DataFrame:
        return blocks.select("company_key", F.struct("_length", "_part").alias(f"{name}_at"), F.col("_size").alias(f"{name}_size"),
                             *[F.col(f"held.{x}").alias(f"{name}_{y}") for x, y in (("tid", "tid"), ("title", "title"), ("bits", "bits"))])

    a, b = side("a"), side("b")
    short, long = F.col("a_size"), F.col("b_size")
    together = short >= threshold * long - 1e-9 if kind == "edit" else 2 * short >= threshold * (short + long) - 1e-9
    others = a.join(b, "company_key").where((F.col("a_at") < F.col("b_at")) & together)
    alone = a.select("*", *[F.lit(None).cast(b.schema[c].dataType).alias(c) for c in b.columns if c != "company_key"])
    tasks = 3 * many.sparkSession.sparkContext.defaultParallelism
    # Blocks are small and comparing them is long: dealt out by number.
    return alone.unionByName(others).repartition(tasks, "company_key", "a_at", "b_at")


def _settled(pairs: DataFrame) -> DataFrame:
    """Absorbed titles and their leaders (tid, leader), from all similar pairs (early, late).

    A title without a similar one before it leads; those after it that are similar to it are taken and take no others. Of many
    pairs rounds of joins do this, until the rest fits one task.
    """
    left, taken = landed(pairs.distinct()), []
    while left.count() > AT_ONCE:
        heads = left.select("early").join(left.select(F.col("late").alias("early")), "early", "left_anti").distinct()
        gone = landed(left.join(heads, "early", "left_semi").select(F.col("late").alias("tid")).distinct())
        taken.append(gone)
        left = left.join(gone.withColumnRenamed("tid", "early"), "early", "left_anti")
        left = landed(left.join(gone.withColumnRenamed("tid", "late"), "late", "left_anti"))
    rest = left.repartition(1).sortWithinPartitions("late", "early").mapInPandas(taken_in_order, "tid bigint")
    taken = landed(reduce(DataFrame.unionByName, [*taken, rest]))
    leading = pairs.join(taken.withColumnRenamed("tid", "early"), "early", "left_anti")
    return leading.groupBy(F.col("late").alias("tid")).agg(F.min("early").alias("leader"))


def _in_rounds(titles: DataFrame, threshold: float, window: int, kind: str) -> DataFrame:
    members = landed(shared_buckets(_keyed(titles, threshold, kind)))

    undecided, absorbed = members, []
    while not undecided.isEmpty():
        rank = F.row_number().over(W.partitionBy("bucket").orderBy("tid"))
        front = landed(undecided.withColumn("_rank", rank).where(F.col("_rank") <= window).drop("_rank"))
        seen = front.groupBy("tid").agg(F.count("*").alias("n_front"))
        total = undecided.groupBy("tid").agg(F.count("*").alias("n_all"))
        whole = seen.join(total, "tid").where(F.col("n_front") == F.col("n_all")).select("tid")

        a = front.select("bucket", "company_key", F.col("tid").alias("early"), F.col("title").alias("early_title"))
        b = front.select("bucket", "company_key", F.col("tid").alias("late"), F.col("title").alias("late_title"))
        inside = a.join(b, ["bucket", "company_key"]).where(F.col("early") < F.col("late")).drop("bucket", "company_key")
        blocked = _similar(inside, threshold, kind).select(F.col("late").alias("tid"))
        leaders = landed(whole.join(blocked, "tid", "left_anti"))

        leading = undecided.join(leaders, "tid", "left_semi")
        hits = _against_leaders(undecided, leading, threshold, kind)
        taken = landed(hits.groupBy(F.col("late").alias("tid")).agg(F.min("early").alias("known")))
        absorbed.append(taken)
        left = undecided.join(leaders, "tid", "left_anti").join(taken, "tid", "left_anti")
        undecided = landed(shared_buckets(left))
        window *= 2

    if not absorbed:
        return titles.limit(0).withColumn("leader", F.col("tid"))
    # A leader confirmed in a later round may come earlier in order: check those before the known one.
    taken = reduce(DataFrame.unionByName, absorbed)
    rows = members.join(taken, "tid")
    heads = members.join(taken.select("tid"), "tid", "left_anti")
    better = _against_leaders(rows, heads, threshold, kind).groupBy(F.col("late").alias("tid")).agg(
        F.min("early").alias("better")
    )
    final = taken.join(better, "tid", "left").select("tid", F.least("known", "better").alias("leader"))
    return titles.join(final, "tid").select("company_key", "title", "tid", "leader")
