"""Mixing sources to target weights by a temperature, in DataFrame operations alone.

A source's weight is its token share to the power of an exponent between 0 (all alike) and 1 (as
they are). The exponent is bisected, 32 intervals at a time, to the largest that reaches a target
entropy (a fraction of the greatest possible), and is raised again until no source repeats more often
than the limit. The budget, unless given, is the least that uses every source in full once.

A source's budget is realised in blocks, by a hash of the identifier: as many whole passes as fit,
then whole blocks in the order of a permutation that differs by pass, then documents of one last block,
while they fit. A source of n documents has sqrt(n) blocks, so neither the blocks of a source nor the
documents of a block outgrow a task. No source is held by one task: its blocks are counted map-side.

A null source is a source of its own. Tokens are words unless a column is given; rows without tokens
are used in every whole pass, once at least, and cost nothing. Rows repeated under one identifier go the same way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import whole_text

#: Intervals that one pass over the sources tells apart, and passes.
INTERVALS, PASSES = 32, 6


def word_count(text: str | Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _solve(shares: DataFrame, low: float, high: float, holds) -> float:
    """Least exponent in [low, high] from which on ``holds(z, s, exponent)`` is true; ``high`` if none is."""
    for _ in range(PASSES):
        grid = [low + (high - low) * i / INTERVALS for i in range(INTERVALS + 1)]
        sums = []
        for i, a in enumerate(grid):
            sums += [F.sum(F.pow("p", F.lit(a))).alias(f"z{i}"), F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"s{i}")]
        row = shares.agg(*sums).first()
        at = next((i for i, a in enumerate(grid) if holds(row[f"z{i}"], row[f"s{i}"], a)), None)
        if at is None:
            return high
        if at == 0:
            return low
        low, high = grid[at - 1], grid[at]
    return high


def exponent(shares: DataFrame, repeat_limit: float, entropy: float | None, budget_share: float | None) -> float:
    """Exponent for token shares ``p`` (all positive)."""
    sources, least, most = shares.agg(F.count("*"), F.min("p"), F.max("p")).first()
    if not sources:
        return 1.0
    floor = 0.0
    if entropy is not None and sources > 1:
        wanted = entropy * math.log(sources)
        # Entropy falls as the exponent grows: the first exponent below the target ends the search.
        floor = _solve(shares, 0.0, 1.0, lambda z, s, a: math.log(z) - a * s / z < wanted - 1e-12)

    def within(z: float, s: float, a: float) -> bool:
        # The smallest source repeats most, the largest sets the budget unless one is given.
        budget = budget_share if budget_share is not None else z * most ** (1 - a)
        return budget * least ** (a - 1) / z <= repeat_limit + 1e-12

    return _solve(shares, floor, 1.0, within)


def _source(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("none"))


def plan(
    slim: DataFrame, repeat_limit: float = 3.0, entropy: float | None = None, budget: float | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sources, blocks and documents of last blocks to use, for ``slim`` (id, source, tokens).

    Sources: ``source, blocks, passes, weight``; blocks: ``source, block`` of the last, partial pass;
    documents: ``source, id`` of it.
    """
    totals = cut_lineage(slim.groupBy("source").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")))
    total = totals.agg(F.sum("t")).first()[0] or 0
    shares = totals.where("t > 0").select("source", "t", (F.col("t") / F.lit(max(1, total))).alias("p"))
    share = budget / total if budget is not None and total else None
    a = exponent(shares, repeat_limit, entropy, share)
    z, most = shares.agg(F.sum(F.pow("p", F.lit(a))), F.max("p")).first()
    z, most = z or 1.0, most or 1.0
    whole = budget if budget is not None else total * z * most ** (1 - a)
    weight = F.pow(F.col("t") / F.lit(max(1, total)), F.lit(a)) / z
    sources = totals.withColumn("weight", F.when(F.col("t") > 0, weight).otherwise(0.0))
    repeat = F.when(F.col("t") > 0, F.round(F.col("weight") * whole / F.col("t"), 9)).otherwise(1.0)
    sources = sources.select(
        "source", "t", "weight", F.ceil(F.sqrt("n")).alias("blocks"), F.floor(repeat).alias("passes"),
        F.floor((repeat - F.floor(repeat)) * F.col("t")).alias("rest"),
    )
    sources = cut_lineage(sources)
    placed = slim.join(sources.select("source", "blocks", "passes", "rest"), "source").withColumn("block", _block("id"))
    sizes = placed.groupBy("source", "block").agg(
        F.sum("tokens").alias("size"), F.first("passes").alias("passes"), F.first("rest").alias("rest")
    )
    order = W.partitionBy("source").orderBy(_order("block", "passes"), "block").rowsBetween(W.unboundedPreceding, 0)
    sizes = cut_lineage(sizes.withColumn("upto", F.sum("size").over(order)))
    blocks = sizes.where("upto <= rest").select("source", "block")
    cut = sizes.where("upto > rest AND upto - size < rest").select("source", "block", (F.col("rest") - F.col("upto") + F.col("size")).alias("left"))
    inside = placed.join(cut, ["source", "block"])
    order = W.partitionBy("source", "block").orderBy(_order("id", "passes"), "id", "tokens").rowsBetween(W.unboundedPreceding, 0)
    documents = inside.withColumn("upto", F.sum("tokens").over(order)).where("upto <= left").select("source", "id").distinct()
    return sources, blocks, documents


def _block(key: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(17)), F.col("blocks")).cast("long")


def _order(key: str, turn: str) -> Column:
    """A pseudo-random place that depends on the pass."""
    return F.xxhash64(key, turn, F.lit(23))


def _passes(rows: DataFrame, plans: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """Rows (id, source, ...) once per pass, with ``epoch`` and ``block``."""
    sources, blocks, documents = plans
    rows = rows.join(sources.select("source", "blocks", "passes"), "source").withColumn("block", _block("id"))
    rows = rows.join(blocks.withColumn("taken", F.lit(1)), ["source", "block"], "left")
    rows = rows.join(documents.withColumn("picked", F.lit(1)), ["source", "id"], "left")
    times = F.col("passes") + F.coalesce("taken", "picked", F.lit(0))
    used = rows.withColumn("times", times.cast("int")).where("times > 0").drop("taken", "picked", "blocks", "passes")
    return used.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1))).drop("times")


def mixed_rows(
    docs: DataFrame, repeat_limit: float = 3.0, entropy: float | None = None, budget: float | None = None,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens_col: str | None = None,
) -> DataFrame:
    """``doc_id, source, n_tokens, weight, epoch, block, place``: each use of a row, and its place in the pass."""
    tokens = F.coalesce(F.col(tokens_col), F.lit(0)).cast("long") if tokens_col else word_count(text_col)
    slim = cut_lineage(docs.select(F.col(id_col).alias("id"), _source(source_col).alias("source"), tokens.alias("tokens"), F.col(source_col).alias("name")))
    plans = plan(slim, repeat_limit, entropy, budget)
    used = _passes(slim, plans).join(plans[0].select("source", "weight"), "source")
    return used.select(
        F.col("id").alias("doc_id"), F.col("name").alias("source"), F.col("tokens").alias("n_tokens"),
        F.round("weight", 9).alias("weight"), "epoch", "block", _order("block", "epoch").alias("place"),
    )


def mix_documents(
    docs: DataFrame, repeat_limit: float = 3.0, entropy: float | None = None, budget: float | None = None,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The input's rows as often as the mixture uses them, all columns kept."""
    slim = cut_lineage(docs.select(F.col(id_col).alias("id"), _source(source_col).alias("source"), word_count(text_col).alias("tokens")))
    plans = plan(slim, repeat_limit, entropy, budget)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), _source(source_col).alias("source"))
    return _passes(rows, plans).select("row.*")
