"""Helpers shared by the operators: tables, bytes of model files, per-worker state, hashes, components."""

from __future__ import annotations

import sys
import types

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Largest model or vocabulary that is shipped to every executor.
BROADCAST_LIMIT = 256 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_text(text: str | Column) -> Column:
    """A text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def row_key(identifier: str | Column, digest: str | Column) -> Column:
    """Identifier and digest of the text as one join key that is never null."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (identifier, digest)]
    return F.concat_ws(":", F.coalesce(parts[0].cast("string"), F.lit("none")), parts[1].cast("string"))


def ship(spark: SparkSession, value: object, n_bytes: int):
    """Broadcast a value whose size is known, and refuse one beyond the limit."""
    if n_bytes > BROADCAST_LIMIT:
        raise ValueError(f"{n_bytes} bytes are too many to broadcast")
    return spark.sparkContext.broadcast(value)


def ship_file(spark: SparkSession, path: str):
    """A vocabulary file's bytes; executors need not see the driver's folders."""
    with open(path, "rb") as f:
        data = f.read()
    return ship(spark, data, len(data))


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, over all tasks that it runs."""
    return sys.modules.setdefault("_vacancia_worker", types.ModuleType("_vacancia_worker")).__dict__


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit changes every output bit with chance one half."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Remembered:
    """Values of words, remembered in two generations of at most ``limit`` words together.

    When the young generation is full it becomes the old one, from which words that are used again
    move back; so frequent words are never lost. ``fixed`` is a first tier that is only read.
    """

    def __init__(self, calculate, limit: int = 1_000_000, longest: int = 64, fixed: dict | None = None):
        self.calculate, self.half, self.longest = calculate, limit // 2, longest
        self.young, self.old, self.fixed = {}, {}, fixed or {}

    def of(self, lists: list[list]) -> dict:
        """Values of all words of the lists; what is missing is calculated in one call."""
        words = set().union(*lists)
        found, missing = {}, []
        for word in words:
            value = self.fixed.get(word)
            if value is None:
                value = self.young.get(word)
            if value is None:
                value = self.old.get(word)
                if value is None:
                    missing.append(word)
                    continue
                self.young[word] = value
            found[word] = value
        new = dict(zip(missing, self.calculate(missing))) if missing else {}
        found.update(new)
        self.young.update((w, v) for w, v in new.items() if len(w) <= self.longest)
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        return found


def slices(texts, size: int = 1 << 20):
    """Texts in lists of about ``size`` characters, or one longer text each."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def word_hashes(lists: list[list[bytes]]) -> list[np.ndarray]:
    """64-bit hashes of lists of words; each distinct word is hashed once."""
    import xxhash

    get = {w: xxhash.xxh64_intdigest(w) for w in set().union(*lists)}.__getitem__
    return [np.fromiter(map(get, words), np.uint64, len(words)) for words in lists]


def compact(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """Checkpoint a table, and read it in as many partitions as its rows deserve."""
    kept = cut_lineage(df)
    return kept.coalesce(max(1, -(-kept.count() // rows)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component), the smallest id reachable.

    Every round gives each node the least label found next to it, then follows the labels once, so
    that labels reach twice as far each time. All state stays in distributed, checkpointed tables;
    null ids have no edges.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = compact(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = compact(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")))
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        )
        hooked = compact(labels.join(near, "id").select("id", "component", F.least("component", "m").alias("m")))
        after = hooked.select(F.col("id").alias("m"), F.col("m").alias("component2"))
        jumped = compact(hooked.join(after, "m").select("id", F.col("component2").alias("component"), (F.col("component") != F.col("component2")).alias("moved")))
        labels = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return labels
