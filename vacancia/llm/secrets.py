"""Secret scans in SQL expressions: three fixed patterns, and strings that look random.

Markov models over characters are counted from labelled samples of the whole corpus. Random: digests of every
document's identifier, written in base 64 and in hexadecimal, and the long values that the patterns find, each with the
samples in its own writing. Ordinary: long identifiers that are no part of such a value, as they stand and by twos in the
usual spellings (snake, kebab, path, capitals, camel). A further string of ``LEAST`` characters is a secret when the
mean logarithm of its likelihood ratio, by the better of the two random models, exceeds a threshold. The threshold comes
from the samples of every ``HELD_OUT``-th document by hash, which no count includes: it makes the sum of
missed random and flagged ordinary samples smallest. The models have one number for each pair of characters of a fixed
alphabet and become literals of the query.

Spans are code points, end exclusive. Nulls count as empty texts, which have no spans. Without ordinary samples only
the patterns speak. Rows repeat with their input; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import whole_text

# The patterns, and the least length of an assigned value.
ASSIGN = r"""(?=[PSTApsta])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
# A run of a class matches as a whole, so the least length can stand in the pattern.
ACCESS, ACCESS_LENGTH = "AKIA[A-Z0-9]{16,}", 20
HEX, HEX_LENGTH = "(?<![0-9a-f])[0-9a-f]{24,}", 24
KINDS = ["assign", "access", "hex", "markov"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Characters of a string to be judged, and of an ordinary identifier to learn from.
LEAST, ORDINARY = 20, 12
#: Shortest found value that says how random strings look; shorter ones are often chosen by people.
CHOSEN = 16
#: One in so many documents sets the threshold; the one used while nothing is held out.
HELD_OUT, LEAST_MEAN = 5, 0.5
#: Weight of single characters where a pair of characters is rare, and steps of the threshold.
SMOOTHING, STEPS = 4.0, 16
_SIDE = len(ALPHABET)
_ORDINARY, _MIXED, _HEX = range(3)


@dataclass
class Model:
    """Log ratios of the two random models, a row for each first character, and what held-out samples gave."""

    mixed: list[float]
    hexadecimal: list[float]
    threshold: float = LEAST_MEAN
    recall: float | None = None
    false_rate: float | None = None


def _run(length: int) -> str:
    """Whole runs of the alphabet of at least ``length`` characters."""
    return f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{length},}}"


def _spans(text: str, pattern: str, kind: str) -> Column:
    """Matches as structs (start, kind, end, value), leftmost and without overlap.

    What lies between the matches, and the matches, give the starts as running sums; a text is read by the pattern
    once to see whether it matches, and three times more if it does.
    """
    match = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1 if kind == "assign" else 0))
    rows = F.arrays_zip(F.split(F.col(text), pattern, -1).alias("gap"), match.alias("hit"), value.alias("value"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>").alias("out"))

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + F.length(row["gap"])
        end = start + F.coalesce(F.length(row["hit"]), F.lit(0))
        span = F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), row["value"].alias("value")
        )
        # The last gap has no match after it.
        return F.struct(end.alias("at"), F.when(row["hit"].isNull(), state["out"]).otherwise(F.array_append(state["out"], span)).alias("out"))

    found = F.aggregate(rows, empty, step, lambda state: state["out"])
    if kind == "assign":
        found = F.filter(found, lambda s: F.length(s["value"]) >= ASSIGN_VALUE)
    return F.when(F.col(text).rlike(pattern), found).otherwise(empty["out"])


def _has(length: int) -> Column:
    return F.exists("long", lambda w: F.length(w) >= length)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, long, others``: spans of the patterns, long strings, and spans of strings to be judged."""
    texts = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    texts = texts.withColumn("long", F.regexp_extract_all("text", F.lit(_run(ORDINARY)), F.lit(0)))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    # A match of the other two patterns lies in a long string.
    assigned = F.when(F.contains("text", F.lit(":")) | F.contains("text", F.lit("=")), _spans("text", ASSIGN, "assign"))
    access = F.when(_has(ACCESS_LENGTH) & F.contains("text", F.lit("AKIA")), _spans("text", ACCESS, "access"))
    hexes = F.when(_has(HEX_LENGTH), _spans("text", HEX, "hex"))
    others = F.when(_has(LEAST), _spans("text", _run(LEAST), "markov"))
    base = F.array_sort(F.concat(*[F.coalesce(x, none) for x in (assigned, access, hexes)]))
    return texts.select("doc_id", base.alias("base"), "long", F.coalesce(others, none).alias("others"))


def samples(scanned: DataFrame) -> DataFrame:
    """``held, kind, token``: labelled samples of scanned documents, of the ordinary, mixed or hexadecimal kind."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.sha2(name, 256)
    values = F.filter(
        F.transform("base", lambda s: F.regexp_replace(s["value"], "[.]", "")),
        lambda v: v.rlike("[0-9]") & (F.length(v) >= CHOSEN),
    )
    found = F.transform(
        values, lambda v: F.struct(F.when(v.rlike("^[0-9a-f]+$"), _HEX).otherwise(_MIXED).alias("kind"), v.alias("token"))
    )
    made = F.array(
        # Without the padding, which no random choice makes.
        F.struct(F.lit(_MIXED).alias("kind"), F.base64(F.unhex(digest)).substr(1, 42).alias("token")),
        F.struct(F.lit(_HEX).alias("kind"), digest.alias("token")),
    )
    words = F.filter(
        "long", lambda w: ~F.exists("base", lambda s: F.contains(s["value"], w) | F.contains(w, s["value"]))
    )
    # A sequence from 1 to less than 1 would count downwards.
    twos = F.when(
        F.size("words") > 1,
        F.transform(F.sequence(F.lit(1), F.size("words") - 1, F.lit(2)), lambda i: F.slice("words", i, 2)),
    ).otherwise(F.array().cast("array<array<string>>"))

    def spelled(two: Column) -> Column:
        snake = F.array_join(two, "_")
        camel = F.concat(F.lower(F.get(two, F.lit(0))), F.initcap(F.get(two, F.lit(1))))
        return F.array(snake, F.upper(snake), camel, F.array_join(two, "-"), F.array_join(two, "/"))

    ordinary = F.concat("words", F.flatten(F.transform(twos, spelled)))
    every = F.concat(
        found, made, F.transform(ordinary, lambda w: F.struct(F.lit(_ORDINARY).alias("kind"), w.alias("token")))
    )
    rows = scanned.withColumn("words", words).select(
        (F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(HELD_OUT)) == 0).alias("held"), F.explode(every).alias("s")
    )
    return rows.select("held", "s.kind", "s.token")


def pair_counts(sampled: DataFrame) -> DataFrame:
    """``kind, pair, n``: neighbouring characters of the samples that are not held out."""
    pairs = sampled.where(~F.col("held")).select(
        "kind", F.explode(F.regexp_extract_all("token", F.lit("(?=(..))"), F.lit(1))).alias("pair")
    )
    return pairs.groupBy("kind", "pair").agg(F.count("*").alias("n"))


def _logs(counts: Counter) -> list[float]:
    """Logarithms of second characters' shares after each first one, smoothed by their shares in all."""
    seconds = Counter()
    for (_, second), n in counts.items():
        seconds[second] += n
    whole = sum(seconds.values()) + 0.5 * _SIDE
    shares = [(seconds[c] + 0.5) / whole for c in ALPHABET]
    out = []
    for first in ALPHABET:
        row = [counts[first, c] for c in ALPHABET]
        out += [math.log((n + SMOOTHING * p) / (sum(row) + SMOOTHING)) for n, p in zip(row, shares)]
    return out


def train(scanned: DataFrame) -> Model | None:
    """Count the models and set the threshold; the driver gets pairs of the alphabet and a histogram of fixed steps."""
    sampled = samples(scanned)
    counts = [Counter() for _ in range(3)]
    for r in pair_counts(sampled).collect():
        counts[r["kind"]][tuple(r["pair"])] += r["n"]
    if not counts[_ORDINARY]:
        return None
    ordinary, mixed, hexadecimal = map(_logs, counts)
    model = Model([a - b for a, b in zip(mixed, ordinary)], [a - b for a, b in zip(hexadecimal, ordinary)])
    # The shortest strings to be judged are the hardest: random samples are held to that length.
    token = F.when(F.col("kind") == _ORDINARY, F.col("token")).otherwise(F.col("token").substr(1, LEAST))
    step = F.least(F.greatest(F.floor(mean_ratio(token, model) * STEPS), F.lit(-20 * STEPS)), F.lit(20 * STEPS))
    rows = (
        sampled.where("held").groupBy((F.col("kind") > 0).alias("random"), step.alias("step"))
        .agg(F.count("*").alias("n")).collect()
    )
    held = {flag: Counter({r["step"]: r["n"] for r in rows if r["random"] == flag}) for flag in (True, False)}
    sizes = {flag: sum(c.values()) for flag, c in held.items()}
    if not all(sizes.values()):
        return model

    def rates(t: int) -> tuple[float, float]:
        caught = sum(n for s, n in held[True].items() if s >= t)
        flagged = sum(n for s, n in held[False].items() if s >= t)
        return caught / sizes[True], flagged / sizes[False]

    steps = range(-20 * STEPS, 20 * STEPS + 1)
    cost = [1 - recall + wrong for recall, wrong in map(rates, steps)]
    best = [t for t, c in zip(steps, cost) if c <= min(cost) + 1e-12]
    middle = best[len(best) // 2]
    model.threshold = middle / STEPS
    model.recall, model.false_rate = rates(middle)
    return model


def _literal(numbers: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{r:.6g}" for r in numbers)), ",").cast("array<double>")


def mean_ratio(token: Column, model: Model) -> Column:
    """Mean log-likelihood ratio per step from character to character, by the random model that fits better."""
    mixed, hexadecimal = _literal(model.mixed), _literal(model.hexadecimal)

    def place(i: Column) -> Column:
        return F.instr(F.lit(ALPHABET), token.substr(i, F.lit(1))) - 1

    def step(state: Column, i: Column) -> Column:
        at = place(i - 1) * _SIDE + place(i)
        return F.struct((state["m"] + F.get(mixed, at)).alias("m"), (state["h"] + F.get(hexadecimal, at)).alias("h"))

    start = F.struct(F.lit(0.0).alias("m"), F.lit(0.0).alias("h"))
    return F.aggregate(
        F.sequence(F.lit(2), F.length(token)), start, step,
        lambda state: F.greatest(state["m"], state["h"]) / (F.length(token) - 1),
    )


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: arrays of (start, kind, end, value) by start, then kind."""
    scanned = cut_lineage(scan(docs, id_col, text_col))
    model = train(scanned)
    if model is None:
        return scanned.select("doc_id", "base", F.col("base").alias("spans"))
    others = F.filter(
        "others",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        & (mean_ratio(s["value"], model) >= model.threshold),
    )
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", others)).alias("spans"))


def _listed(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _counted(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")


def with_digests(found: DataFrame) -> DataFrame:
    """``doc_id``, counts of base spans by kind, their digest, and all spans as text."""
    return found.select(
        "doc_id", *map(_counted, KINDS[:3]), F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans")
    )
