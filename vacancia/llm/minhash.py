"""Near-duplicate texts: one-permutation MinHash, banded buckets, star-shaped candidate edges.

A text's set holds its distinct word shingles. One hash per shingle fills ``BANDS * ROWS`` bins (the
least hash of each); an empty bin copies the first full one in its own fixed random order of bins,
so that any two sets agree in a bin with a chance equal to their similarity, whatever their sizes.
Sets of one bucket become candidates through a star around one of them, and every candidate is
confirmed on full sets. A miss needs all bands to differ: about one pair in 100,000 at similarity 0.8.

* Equal sets are collapsed first; copies cost nothing afterwards.
* A star leaves out pairs of its rays. What buckets hold in several components after ``STARS`` rounds
  goes through an exact search by rare shingles, which leaves out only pairs that cannot be similar.
  No bucket, partner or candidate is capped.
* Hot buckets are found by counts that combine map-side, and joined by equi joins that adaptive
  execution may split.

Null and empty texts have no shingles and are linked with nothing; a text of fewer words than a
shingle is one shingle. Rows that repeat identifier and text are copies; different texts under one
identifier are linked each by its own set. A null identifier has no links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import compact, components, mix, row_key, slices, spare, whole_text, word_hashes, worker_state

BANDS, ROWS = 40, 5
STARS = 1
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of the ``k``-word shingles, A-Z lower-cased."""
    for part in slices(texts):
        # bytes.lower and bytes.split know ASCII alone: A-Z, and white space 0x20, 0x09 to 0x0D.
        for words in word_hashes([t.encode().lower().split() for t in part]):
            width = min(k, len(words))
            total = np.full(len(words) - width + 1 if width else 0, width, np.uint64)
            for i in range(width):
                total = mix(total * _FACTOR + words[i : len(words) - width + 1 + i])
            total.sort()
            yield total[np.diff(total, prepend=np.uint64(0)) > 0] if len(total) and total[0] else np.unique(total)


def _orders(bins: int) -> np.ndarray:
    """For each bin a fixed random order of all bins, as ranks."""
    state, key = worker_state(), ("orders", bins)
    if key not in state:
        cells = mix(np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins) * _FACTOR + np.uint64(1))
        state[key] = cells.argsort(axis=1).argsort(axis=1).astype(np.uint16)
    return state[key]


def bins_of(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation sketch with optimal densification of sorted distinct hashes."""
    place = (((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    full = place[first]
    out = np.empty(bins, np.uint64)
    out[full] = hashes[first]
    if len(full) < bins:
        lacks = np.ones(bins, bool)
        lacks[full] = False
        empty = np.flatnonzero(lacks)
        out[empty] = out[full[_orders(bins)[empty][:, full].argmin(axis=1)]]
    return out


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bins = bins_of(hashes, bands * rows).reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = mix(key * _FACTOR + bins[:, i])
    return key.view(np.int64)


def sketches(docs: DataFrame, k: int, threshold: float, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id, text_hash, n, digest, keys`` of documents (id, text); sets that only equal ones can match get no keys."""
    alone = threshold / (1 - threshold) if threshold < 1 else math.inf

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, digest, keys = [], [], []
            for hashes in shingle_sets(batch["text"], k):
                n.append(len(hashes))
                digest.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                keys.append(band_keys(hashes, bands, rows) if len(hashes) >= alone - 1e-9 else np.empty(0, np.int64))
            yield pd.DataFrame({"id": batch["id"], "text_hash": batch["text_hash"], "n": n, "digest": digest, "keys": keys})

    hashed = docs.select("id", F.xxhash64("text").alias("text_hash"), "text")
    return hashed.mapInPandas(sketch, "id long, text_hash long, n long, digest binary, keys array<bigint>")


def full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """``id, hashes`` of the sets ``ids`` (id, rep, text_hash), each from a document ``rep`` with that text."""

    @F.pandas_udf("array<bigint>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([h.view(np.int64) for h in shingle_sets(texts, k)], dtype=object)

    texts = docs.select(F.col("id").alias("rep"), F.xxhash64("text").alias("text_hash"), "text")
    some = texts.join(ids, ["rep", "text_hash"])
    # Rows may repeat identifier and text.
    return some.groupBy("id").agg(F.min("text").alias("text")).select("id", hashes("text").alias("hashes"))


def _confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - shared
    return both.where(100 * shared >= per_cent * union).select("a", "b")


def _fits(n: str, m: str, per_cent: int) -> str:
    return f"100 * least({n}, {m}) >= {per_cent} * greatest({n}, {m})"


def rare_shingle_pairs(rows: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Every pair (a, b) of different components among ``rows`` (id, component) that can reach the threshold.

    With the shingles of each set ordered from rare to common, two similar sets share one near the
    front of both: as many shingles as follow their first shared one must be enough for the threshold.
    """
    held = rows.join(sets, "id").select("id", "component", F.size("hashes").alias("n"), F.explode("hashes").alias("key"))
    # A shingle of one set alone keeps a place at the front and pairs nothing.
    common = held.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    own = W.partitionBy("id")
    place = F.row_number().over(own.orderBy("df", "key")) + F.col("n") - F.count("*").over(own)
    front = compact(
        held.join(common, "key").withColumn("place", place).where(f"100 * (n - place + 1) >= {per_cent} * n").drop("df")
    )
    # Each pair has a member outside the most frequent component: its rows never meet each other.
    counts = front.groupBy("key", "component").agg(F.count("*").alias("c"))
    split = counts.groupBy("key").agg(
        F.expr("max_by(component, struct(c, component))").alias("top"), F.count("*").alias("kinds")
    ).where("kinds > 1").drop("kinds")
    left = front.join(split, "key").where("component <> top")
    right = front.selectExpr("key", "id AS id2", "component AS component2", "n AS n2", "place AS place2")
    reach = f"{100 + per_cent} * (1 + least(n - place, n2 - place2)) >= {per_cent} * (n + n2)"
    return left.join(right, "key").where(
        f"(component2 = top OR component < component2) AND {_fits('n', 'n2', per_cent)} AND {reach}"
    ).selectExpr("least(id, id2) AS a", "greatest(id, id2) AS b")


def link_members(members: DataFrame, sets: DataFrame, per_cent: int, stars: int = STARS) -> DataFrame:
    """Links (a, b) that join all similar members of buckets (key, id, n, weight) into components."""
    labels, tested, links = None, [], []
    for turn in range(stars + 1):
        if labels is None:
            rows = members.withColumn("component", F.col("id"))
        else:
            rows = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        # The same order of members in all buckets makes stars of different bands coincide. The member
        # that meets most others is nearest to the middle of its group.
        turn_order = "-weight" if turn == 0 else f"xxhash64(id, {turn})"
        split = rows.groupBy("key").agg(
            F.expr(f"min_by(struct(id, n, component), struct({turn_order}, id))").alias("centre"),
            F.min("component").alias("low"), F.max("component").alias("high"),
        ).where("low <> high")
        if turn < stars:
            pairs = (
                rows.join(split.select("key", "centre"), "key")
                .where(f"component <> centre.component AND {_fits('n', 'centre.n', per_cent)}")
                .selectExpr("least(id, centre.id) AS a", "greatest(id, centre.id) AS b")
            )
        else:
            pairs = rare_shingle_pairs(
                compact(rows.join(split.select("key"), "key").select("id", "component").distinct()), sets, per_cent
            )
        pairs = pairs.distinct()
        for done in tested:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = compact(pairs)
        if pairs.isEmpty():
            continue
        tested.append(pairs)
        found = compact(_confirmed(pairs, sets, per_cent))
        links.append(found)
        if turn < stars:
            labels = components(reduce(DataFrame.union, links))
    if not links:
        return members.selectExpr("id AS a", "id AS b").limit(0)
    return reduce(DataFrame.union, links)


def _labelled(docs: DataFrame, k: int, per_cent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    sketched = cut_lineage(sketches(texts, k, per_cent / 100))
    reps = sketched.where("n > 0 AND id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("id", "text_hash")).alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys")
    )
    # Sets have numbers of their own, since an identifier may carry several.
    reps = cut_lineage(reps.select(
        F.monotonically_increasing_id().alias("id"), "digest", F.col("first.id").alias("rep"), "first.text_hash", "n", "keys"
    ))
    keyed = reps.select("id", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    weight = F.sum("m").over(W.partitionBy("id"))
    members = cut_lineage(keyed.join(shared, "key").select("key", "id", "n", weight.alias("weight")))
    wanted = reps.select("id", "rep", "text_hash").join(members.select("id").distinct(), "id", "left_semi")
    sets = cut_lineage(full_sets(texts, wanted, k))
    found = components(link_members(members, sets, per_cent))
    slim = reps.select("id", "digest", "rep")
    linked = slim.join(found.withColumnRenamed("component", "number"), "id")
    least = linked.groupBy("number").agg(F.min("rep").alias("component"))
    labels = linked.join(least, "number").select("id", "component")
    groups = slim.join(labels, "id", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return sketched.drop("keys").join(groups, "digest", "left").select(
        F.col("id").alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"),
    )


def near_duplicates(
    docs: DataFrame, k: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; links at ``per_cent`` of the union."""
    return _labelled(docs, k, per_cent, id_col, text_col).drop("text_hash")


def keep_one_of_each(docs: DataFrame, k: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows, one document of each near-duplicate group (the smallest identifier); columns of any name stay as they are."""
    name = spare(docs, "_k")
    kept = _labelled(docs, k, per_cent, id_col, text_col).where("kept").select(row_key("doc_id", "text_hash").alias(name))
    key = row_key(F.col(id_col).cast("long"), F.xxhash64(whole_text(text_col)))
    return docs.join(kept, key == F.col(name), "left_semi")
