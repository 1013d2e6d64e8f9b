"""Near-duplicate vectors: an exact range join in the metric space of directions.

Vectors of one label are linked when their cosine reaches a threshold, that is, when the distance of
their unit vectors is at most ``r``. Equal vectors are collapsed first. Sampled pivots cut the space
into cells, every vector belongs to the cell of its nearest pivot, and is copied into each cell that
may hold a partner: by the triangle inequality one whose pivot is at most ``2 r`` further away than
its own, and at most ``r`` beyond the cell's radius. Each cell then finds its own vectors' links alone,
so every link of a vector is counted once, in its home cell.

The number of pivots is bounded, so they can be broadcast; a cell beyond ``BLOCK`` vectors is joined in
blocks of home rows by blocks of members. A block returns counts and, for its components, one edge
per vector, never its pairs.

Vectors that are null, of length zero, or hold null or non-finite parts have no links, nor have null
labels; vectors of different dimensions are not compared. Null identifiers have no component.
Repeated rows are copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import components, ship

#: Vectors of a cell at which it is split, vectors that a pivot stands for, and pivots at most.
BLOCK, PER_PIVOT, PIVOTS = 2048, 4096, 8192
#: A space of fewer vectors is one cell; every other has two pivots at least.
SMALL_SPACE = 16
#: Slack for rounding in the copying bounds; links themselves are decided by the cosine.
_SLACK = 1e-6


def _unit(vectors) -> np.ndarray:
    matrix = np.stack([np.asarray(v, np.float64) for v in vectors])
    with np.errstate(over="ignore", under="ignore"):
        square = (matrix * matrix).sum(axis=1)
    # Squares of huge or tiny parts leave the range of a double: bring the largest part to 1 first.
    odd = ~np.isfinite(square) | (square < 1e-200)
    if odd.any():
        matrix[odd] /= np.abs(matrix[odd]).max(axis=1)[:, None]
        square[odd] = (matrix[odd] * matrix[odd]).sum(axis=1)
    return matrix / np.sqrt(square)[:, None]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


# A row (id, space, vector) whose vector has a direction.
_USABLE = """CASE WHEN space IS NULL OR id IS NULL OR vector IS NULL THEN false
    WHEN exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) THEN false
    ELSE exists(vector, x -> x <> 0) END"""


def pivot_rows(reps: DataFrame, per_pivot: int, pivots: int) -> DataFrame:
    """``space, vector``: about one row in ``per_pivot`` of each larger space, and two about at least.

    So few spaces hold more than the ``pivots``-th part of all rows that the pivots number some ``3 * pivots`` at most.
    """
    sizes = reps.groupBy("space").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    per_pivot = max(per_pivot, -(-total // pivots))
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53)
    least = min(per_pivot, max(SMALL_SPACE, -(-total // pivots)))
    large = reps.withColumn("place", place).join(sizes.where(F.col("n") > least), "space")
    wanted = F.greatest(F.lit(2), F.ceil(F.col("n") / per_pivot))
    few = large.where(F.col("place") * F.col("n") < wanted).select("space", "vector")
    # A space of which the threshold lets nothing through has its first row.
    first = large.groupBy("space").agg(F.min_by("vector", F.struct("place", "id")).alias("vector"))
    return few.union(first.join(few.select("space").distinct(), "space", "left_anti"))


def choose_pivots(reps: DataFrame, per_pivot: int, pivots: int) -> dict[str, np.ndarray]:
    """Unit vectors of a few rows of each larger space, by a hash of the identifier."""
    chosen = pivot_rows(reps, per_pivot, pivots).collect()
    by: dict[str, list] = {}
    for row in chosen:
        by.setdefault(row["space"], []).append(row["vector"])
    return {space: _unit(vectors) for space, vectors in by.items()}


def into_cells(reps: DataFrame, pivots, r: float) -> DataFrame:
    """``id, space, copies, vector, cell, home, home_distance, distance`` for each cell that a vector may matter to."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for space, rows in batch.groupby("space", sort=False):
                rows = rows.reset_index(drop=True)
                centres = pivots.value.get(space)
                if centres is None:
                    yield rows.assign(cell=0, home=True, distance=0.0)
                    continue
                d = _distances(_unit(rows["vector"]), centres)
                nearest = d.argmin(axis=1)
                near = d <= d[np.arange(len(d)), nearest][:, None] + 2 * r + _SLACK
                at, cell = np.nonzero(near)
                yield rows.iloc[at].reset_index(drop=True).assign(cell=cell, home=cell == nearest[at], distance=d[at, cell])

    return reps.select("id", "space", "copies", "vector").mapInPandas(
        assign, "id long, space string, copies long, vector array<double>, cell long, home boolean, distance double"
    )


def _block_links(threshold: float):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        home, member = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if not len(home) or not len(member):
            return pd.DataFrame({"id": [], "n": [], "least": []}).astype("int64")
        a, b = home["id"].to_numpy(np.int64), member["id"].to_numpy(np.int64)
        close = _unit(home["vector"]) @ _unit(member["vector"]).T >= threshold
        close &= a[:, None] != b[None, :]
        n = close @ member["copies"].to_numpy(np.int64)
        # Least labels run through the block until they rest; both sides get an edge to theirs.
        left, right = a.copy(), b.copy()
        far = np.iinfo(np.int64).max
        while True:
            new_left = np.minimum(left, np.where(close, right[None, :], far).min(axis=1))
            new_right = np.minimum(right, np.where(close, new_left[:, None], far).min(axis=0))
            if (new_left == left).all() and (new_right == right).all():
                break
            left, right = new_left, new_right
        linked = close.any(axis=0)
        ids = np.concatenate([a, b[linked]])
        return pd.DataFrame({"id": ids, "n": np.concatenate([n, np.zeros(linked.sum(), np.int64)]), "least": np.concatenate([left, right[linked]])})

    return links


def near_vectors(
    vectors: DataFrame, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    block: int = BLOCK, per_pivot: int = PER_PIVOT, pivots: int = PIVOTS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per input row."""
    spark, r = vectors.sparkSession, math.sqrt(max(0.0, 2 - 2 * threshold))
    vector = F.col(vector_col).cast("array<double>")
    space = F.concat_ws("/", F.col(label_col).cast("string"), F.size(vector).cast("string"))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.when(F.col(label_col).isNotNull(), space).alias("space"), vector.alias("vector")
    )
    sound, poor = rows.where(_USABLE), rows.where(f"NOT ({_USABLE})")
    reps = cut_lineage(sound.groupBy("space", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    centres = choose_pivots(reps, per_pivot, pivots)
    shipped = ship(spark, centres, sum(c.nbytes for c in centres.values()))
    cells = cut_lineage(into_cells(reps, shipped, r))
    sizes = cells.groupBy("space", "cell").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("home"), F.col("distance"))).alias("radius"),
        F.sum(F.col("home").cast("int")).alias("homes"),
    ).where("homes > 0")
    parts = sizes.select("space", "cell", "radius", F.ceil(F.col("homes") / block).alias("hs"), F.ceil(F.col("n") / block).alias("ms"))
    placed = cells.join(parts, ["space", "cell"]).where(F.col("distance") <= F.col("radius") + r + _SLACK)
    own = F.xxhash64("id")
    home = placed.where("home").withColumn("h", F.pmod(own, F.col("hs"))).withColumn("m", F.explode(F.expr("sequence(0L, ms - 1)")))
    member = placed.withColumn("m", F.pmod(own, F.col("ms"))).withColumn("h", F.explode(F.expr("sequence(0L, hs - 1)")))
    shape = ["space", "cell", "h", "m", "id", "copies", "vector"]
    both = home.select(*shape, F.lit(0).alias("side")).union(member.select(*shape, F.lit(1).alias("side")))
    found = cut_lineage(
        both.groupBy("space", "cell", "h", "m").applyInPandas(_block_links(threshold), "id long, n long, least long")
    )
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(found.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct())
    told = reps.join(links, "id", "left").join(groups, "id", "left").select(
        "space", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"),
    )
    good = sound.join(told, ["space", "vector"]).select("id", "n_links", "component")
    poor = poor.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return good.union(poor).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
