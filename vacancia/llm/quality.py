"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal updates.

Words are runs of letters and digits, or of other signs; a word equal to the one before it is written
``=``. Words and word pairs are hashed to ``2 ** BITS`` weights; a feature's value is its share of the
text's features. Training takes a bounded sample of labelled rows (``TRAINING_ROWS``, by a hash of the
identifier) in independent runs of about ``PART_ROWS``, whose weights are averaged; every text is then scored by one
sparse dot product with the broadcast weights, 8 bytes times ``2 ** BITS`` at most.

Null and empty texts have no features and get the score of the offset alone. Without labels every
score is 0.5. Rows repeat with their input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, ship, slices, whole_text
from .learning import fold, labelled, sampled, teaching_labels

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
BITS, PART_ROWS, TRAINING_ROWS = 18, 5_000, 40_000
#: Passes over a part: few for a full one, more for a small one.
LEAST_PASSES, MOST_PASSES = 3, 30
#: Learning rate, its smoothing, and the penalties of FTRL-proximal.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
#: Factor on the shares, so that penalties and rates are of the usual size.
SCALE = 8.0
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+|(?:[^\w\s]|_)+", text.lower())
    return [w if w != last else "=" for w, last in zip(words, [None, *words])]


def features(texts) -> Iterator[np.ndarray]:
    """Hashed words and word pairs of each text, one place per occurrence."""
    import xxhash

    shift = np.uint64(64 - BITS)
    for part in slices(texts):
        lists = [words_of(t) for t in part]
        get = {w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in set().union(*lists)}.__getitem__
        for words in lists:
            one = mix(np.fromiter(map(get, words), np.uint64, len(words)))
            two = mix(one[:-1] * _FACTOR + one[1:])
            yield (np.concatenate([one, two]) >> shift).astype(np.int64)


def ftrl(places: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Weights after some passes over the examples; the last one is the offset."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at):
        grown = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(z[at]) > L1, -(z[at] - np.sign(z[at]) * L1) / grown, 0.0)

    examples = []
    for p in places:
        at, times = np.unique(p, return_counts=True)
        examples.append((np.append(at, 1 << BITS), np.append(times * (SCALE / max(1, len(p))), 1.0)))
    for _ in range(min(MOST_PASSES, max(LEAST_PASSES, LEAST_PASSES * PART_ROWS // max(1, len(y))))):
        for (at, x), target in zip(examples, y):
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - target) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(np.arange(len(z)))


def train(rows: DataFrame, parts: int) -> np.ndarray:
    """Mean weights of ``parts`` runs over labelled rows (id, text, y)."""

    def fit(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("order")
        w = ftrl(list(features(batch["text"])), batch["y"].to_numpy(float))
        at = np.flatnonzero(w)
        return pd.DataFrame({"place": at, "w": w[at]})

    split = rows.select("text", "y", F.xxhash64("id", F.lit(3)).alias("order")).withColumn("part", F.pmod(F.xxhash64("order"), F.lit(parts)))
    runs = split.groupBy("part").applyInPandas(fit, "place long, w double")
    mean = runs.groupBy("place").agg((F.sum("w") / parts).alias("w")).toPandas()
    out = np.zeros((1 << BITS) + 1)
    out[mean["place"].to_numpy(int)] = mean["w"]
    return out


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    spark = docs.sparkSession
    marks = teaching_labels(labels, label, FOLDS, HELD_OUT)
    n_marks = marks.count()
    share = min(1.0, training_rows / max(1, n_marks))
    parts = -(-int(n_marks * share) // PART_ROWS) or 1
    chosen = sampled("id", share)
    # About TRAINING_ROWS identifiers at most, so texts need not be shuffled to meet them.
    weights = train(labelled(docs, F.broadcast(marks.where(chosen)), FOLDS, HELD_OUT, id_col, text_col), parts)
    model = ship(spark, weights, weights.nbytes)

    @F.pandas_udf("double")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = model.value
        for texts in batches:
            out = [SCALE / max(1, len(p)) * w[p].sum() + w[-1] for p in features(texts)]
            yield pd.Series(out, dtype="float64")

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), raw(whole_text(text_col)).alias("raw"))
    score = 1 / (1 + F.exp(-F.least(F.greatest("raw", F.lit(-30.0)), F.lit(30.0))))
    return rows.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
