"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two models, one of toxic and one of ordinary texts, give each character of a word a probability
after the seven before it. Both discount their own counts absolutely and give the discounted mass to
one shared lower-order Kneser-Ney distribution, built from continuation counts of both classes
together; so an expression that is rare in either class falls back to the same estimate and speaks
for neither, and spelling variants of a stem support each other. With the difference of the two
log-likelihoods known for every word, a text is described by the difference per word, by the part
beyond ``EXCESS`` per word, and by that of its second most toxic word, so that few toxic words count
in a long text too. A logistic curve over these, fitted on labelled rows that were kept from the
counts, gives the score.

All other labelled rows outside the held-out fold are counted. Only ``CALIBRATION_ROWS`` labelled rows
at most fit the curve. The scoring table has one number for each context, and one for each n-gram that
differs from it; a word's difference is the sum of those of its contexts and n-grams. Every distinct
word is scored once. The ``MODEL_ENTRIES`` most frequent entries are broadcast, the others joined; so
are the ``WORDS`` most frequent words' differences and the others. Tiers change the speed and not the result.

Null and empty texts, and texts without a word, have difference 0. With no label of one class every
score is the share of toxic labels, 0 if there are none. Rows repeat with their input.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..session import brief_shuffles, cut_lineage, work_dir
from .common import mix, row_key, ship, slices, spare, whole_text, word_hashes, worker_state
from .learning import fold, labelled, sampled, teaching_labels

#: Characters of an n-gram in the class models, and in the shared distribution that they fall back to.
ORDER, SHARED = 8, 3
#: Absolute discount of the class models: so many occurrences in a class prove nothing.
DISCOUNT, EXCESS = 2, 2.0
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
#: Entries and words of the first tiers, at most.
MODEL_ENTRIES, WORDS = 400_000, 1_000_000
#: Bits of the filter of second-tier entries, at most; with fewer a key, more keys are joined in vain.
FILTER_BITS = 1 << 27
#: Share of the labelled rows that fit the curve, and their number at most.
CALIBRATION, CALIBRATION_ROWS = 0.2, 20_000
#: Characters of a text that are split into words together, those whose words are counted together, and
#: words whose n-grams are held together, about: they bound the memory of a worker.
TEXT_CHARS, COUNT_CHARS, BLOCK_WORDS = 1 << 20, 1 << 21, 20_000
_PAD, _END, _GAP = "\x02", "\x03", re.compile(r"[\W_]")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def word_lists(text: str, size: int = TEXT_CHARS) -> Iterator[list[str]]:
    """The words of a text; of a longer one in lists from about ``size`` characters each."""
    at = 0
    while len(text) - at > size and (gap := _GAP.search(text, at + size)):
        yield words_of(text[at : gap.start()])
        at = gap.start()
    yield words_of(text[at:] if at else text)


def word_counts(texts: Iterable[str], size: int) -> Iterator[Counter]:
    """Counts of words, from about ``size`` characters each."""
    seen, held = Counter(), 0
    for text in texts:
        for words in word_lists(text):
            seen.update(words)
            held += sum(map(len, words))
            if held >= size:
                yield seen
                seen, held = Counter(), 0
    if seen:
        yield seen


def ngram_hashes(words: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joined text, ends of n-grams in it, the word of each, hashes of the n-grams and of their contexts."""
    pad = _PAD * (ORDER - 1)
    joined = "".join(f"{pad}{w}{_END}" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + ORDER for w in words])
    owner = np.repeat(np.arange(len(words)), lengths)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ends = np.flatnonzero(inside >= ORDER - 1)
    context = np.full(len(ends), ORDER, np.uint64)
    for i in range(ORDER - 1, 0, -1):
        context = mix(context * _FACTOR + codes[ends - i])
    return joined, ends, owner[ends], mix(context * _FACTOR + codes[ends]), context


def _gram_counts(words: list[str], times: np.ndarray) -> tuple[pd.Series, np.ndarray]:
    """Distinct n-grams of distinct words, and how often they occur if the words do so many times."""
    joined, ends, owner, grams, _ = ngram_hashes(words)
    _, first, same = np.unique(grams, return_index=True, return_inverse=True)
    n = np.bincount(same, times[owner], len(first)).astype(np.int64)
    return pd.Series([joined[e - ORDER + 1 : e + 1] for e in ends[first]], dtype=object), n


def count_ngrams(rows: DataFrame) -> DataFrame:
    """``gram, t, o``: how often each n-gram occurs in toxic and in ordinary texts (text, y)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("y")["text"]:
                for seen in word_counts(part, COUNT_CHARS):
                    # Words that begin alike share n-grams, so they are brought into one block.
                    words = sorted(seen)
                    for at in range(0, len(words), BLOCK_WORDS):
                        block = words[at : at + BLOCK_WORDS]
                        grams, n = _gram_counts(block, np.array([seen[w] for w in block], float))
                        none = np.zeros(len(n), np.int64)
                        yield pd.DataFrame({"gram": grams, "t": n if name else none, "o": none if name else n})

    counts = rows.select("text", "y").mapInPandas(count, "gram string, t long, o long")
    return counts.groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _discount(ones: float, twos: float) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.75


def shared_backoff(grams: DataFrame) -> DataFrame:
    """``gram, p``: Kneser-Ney probability of the last of ``SHARED`` characters after the others."""
    tables, drop = [], ORDER - SHARED
    for n in range(SHARED, 0, -1):
        grams = cut_lineage(grams.groupBy(F.expr(f"substring(gram, {1 + drop})").alias("gram")).agg(F.count("*").alias("c")))
        tables.append((n, grams))
        drop = 1
    p = None
    for n, counts in reversed(tables):
        if p is None:
            # Counts of single characters: at most one row per character of Unicode.
            whole = W.partitionBy(F.lit(0))
            p = counts.select("gram", (F.col("c") / F.sum("c").over(whole)).alias("p"))
            continue
        k1, k2 = counts.agg(F.sum(F.expr("int(c = 1)")), F.sum(F.expr("int(c = 2)"))).first()
        d = _discount(k1 or 0, k2 or 0)
        context = W.partitionBy(F.expr(f"substring(gram, 1, {n - 1})"))
        lower = p.select(F.col("gram").alias("tail"), F.col("p").alias("q"))
        own = counts.withColumn("total", F.sum("c").over(context)).withColumn("types", F.count("*").over(context))
        p = own.join(lower, F.expr("substring(gram, 2)") == F.col("tail")).selectExpr(
            "gram", f"((c - {d}D) + {d}D * types * q) / total AS p"
        )
    return p


def log_ratios(grams: DataFrame) -> DataFrame:
    """``gram, seen, r`` of n-grams and of contexts: log of toxic over ordinary probability.

    An n-gram's ratio is listed as its difference from its context's, which is listed too. An n-gram
    within the discount in both classes has its context's ratio, and a context of only such n-grams
    has ratio 0; neither is listed.
    """
    head = f"substring(gram, 1, {ORDER - 1})"
    contexts = grams.groupBy(F.expr(head).alias("context")).agg(
        F.sum("t").alias("nt"), F.sum("o").alias("no"), F.max(F.greatest("t", "o")).alias("most"),
        F.sum(F.least("t", F.lit(DISCOUNT))).alias("dt"), F.sum(F.least("o", F.lit(DISCOUNT))).alias("do"),
    ).where(F.col("most") > DISCOUNT)
    contexts = contexts.selectExpr(
        "*", "CASE WHEN nt > 0 THEN dt / nt ELSE 1D END AS lt", "CASE WHEN no > 0 THEN do / no ELSE 1D END AS lo"
    )
    lower = shared_backoff(grams).select(F.col("gram").alias("tail"), "p")
    proven = grams.where((F.col("t") > DISCOUNT) | (F.col("o") > DISCOUNT))
    full = proven.join(contexts, F.expr(head) == F.col("context")).join(
        lower, F.expr(f"substring(gram, {1 + ORDER - SHARED})") == F.col("tail")
    )
    pt = f"CASE WHEN nt > 0 THEN greatest(t - {DISCOUNT}, 0) / nt ELSE 0D END + lt * p"
    po = f"CASE WHEN no > 0 THEN greatest(o - {DISCOUNT}, 0) / no ELSE 0D END + lo * p"
    ratios = full.selectExpr("gram", "t + o AS seen", f"ln(({pt}) / ({po})) - ln(lt / lo) AS r")
    return ratios.union(contexts.selectExpr("context AS gram", "nt + no AS seen", "ln(lt / lo) AS r"))


def _stored(rows: DataFrame) -> DataFrame:
    path = work_dir(rows.sparkSession, "toxicity")
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _keyed(rows: DataFrame) -> DataFrame:
    """``key, n, r``: the entries by their hashes."""

    @F.pandas_udf("long")
    def key(grams: pd.Series) -> pd.Series:
        if not len(grams):
            return pd.Series([], dtype="int64")
        # n-grams and contexts differ in length: pad in front, and leave out what was padded.
        codes = np.frombuffer("".join(g.rjust(ORDER, "\0") for g in grams).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.astype(np.uint64).reshape(len(grams), ORDER)
        keys = np.full(len(codes), ORDER, np.uint64)
        for i in range(ORDER):
            keys = np.where(codes[:, i] > 0, mix(keys * _FACTOR + codes[:, i]), keys)
        return pd.Series(keys.view(np.int64))

    return rows.select(key("gram").alias("key"), F.col("seen").alias("n"), "r")


def _least(rows: DataFrame, most: int) -> int:
    """The smallest power of two that ``n`` reaches in at most so many rows."""
    sizes = dict(rows.groupBy(F.length(F.bin("n"))).count().collect())
    for digits in range(64, 0, -1):
        most -= sizes.get(digits, 0)
        if most < 0:
            return 1 << digits
    return 1


def _first_tier(rows: DataFrame, key: str, value: str, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and values of the rows of at least that frequency."""
    table = rows.where(F.col("n") >= least).select(key, value).toArrow()
    keys = table[key].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], table[value].to_numpy().astype(float)[order]


def _bits(keys: np.ndarray, size: int) -> list[np.ndarray]:
    return [(keys >> np.uint64(shift)) & np.uint64(size - 1) for shift in (0, 32)]


def _filter(keys: DataFrame) -> np.ndarray:
    """Bits at two places for each key, in 64-bit words; their number is a power of two."""
    size = min(FILTER_BITS, max(64, 1 << (16 * keys.count()).bit_length()))
    places = keys.select(F.explode(F.array("key", F.shiftrightunsigned("key", 32))).alias("at"))
    places = places.select(F.col("at").bitwiseAND(F.lit(size - 1)).alias("at"))
    words = places.groupBy(F.shiftright("at", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[words["i"].to_numpy()] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


class Lookup:
    """Values of sorted hashes."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, 0 where there is none, and which are there."""
        if not len(self.keys):
            return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return np.where(hit, self.values[at], 0.0), hit


def score_words(words: list[str], entries: Lookup, later: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each word's sum over the first tier, and its keys that may be in the second."""
    _, _, owner, grams, contexts = ngram_hashes(words)
    keys, owner = np.concatenate([grams, contexts]), np.concatenate([owner, owner])
    value, hit = entries.of(keys)
    maybe = ~hit
    for at in _bits(keys, 64 * len(later)):
        maybe &= (later[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
    rest = np.flatnonzero(maybe)
    rest = rest[np.argsort(owner[rest], kind="stable")]
    ends = np.searchsorted(owner[rest], np.arange(1, len(words)))
    return np.bincount(owner, value, len(words)), np.split(keys[rest].view(np.int64), ends)


def word_differences(texts: DataFrame, ratios: DataFrame, most: int) -> DataFrame:
    """``word, n, v``: hash, frequency and difference of every distinct word of the texts (text)."""
    spark = texts.sparkSession

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for seen in word_counts(batch["text"], COUNT_CHARS):
                yield pd.DataFrame({"text": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})

    words = texts.select("text").mapInPandas(count, "text string, n long").groupBy("text").agg(F.sum("n").alias("n"))
    ratios = _stored(_keyed(ratios))
    least = _least(ratios, most)
    rare = ratios.where(F.col("n") < least).select("key", "r")
    model = (*_first_tier(ratios, "key", "r", least), _filter(rare))
    model = ship(spark, model, sum(a.nbytes for a in model))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, values, later = model.value
        entries = Lookup(keys, values)
        for batch in batches:
            counts = iter(batch["n"])
            for part in slices(batch["text"], 10 * BLOCK_WORDS):
                v, rest = score_words(part, entries, later)
                yield pd.DataFrame({
                    "word": word_hashes([[w.encode() for w in part]])[0].view(np.int64), "n": list(islice(counts, len(part))),
                    "v": v, "rest": pd.Series(rest, dtype=object),
                })

    known = _stored(words.mapInPandas(score, "word long, n long, v double, rest array<bigint>"))
    late = known.select("word", F.explode("rest").alias("key")).join(rare, "key").selectExpr("word", "0L AS n", "r AS v")
    open_ = known.where(F.size("rest") > 0).select("word", "n", "v").union(late)
    closed = open_.groupBy("word").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    return _stored(known.where(F.size("rest") == 0).select("word", "n", "v").union(closed))


class Differences:
    """Summed differences of texts, from sorted hashes of the first tier's words."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.first = Lookup(keys, values)

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the difference, whether the first tier has it, and its hash; each distinct word is hashed once."""
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        hashes = np.fromiter(map(xxh64_intdigest, number), np.uint64, len(number))
        value, hit = self.first.of(hashes)
        return value[ids], hit[ids], hashes[ids]

    def _sums(self, lists: list[list[str]]) -> list[list]:
        """For each list of words: words, sum and summed excess of the first tier's, their largest two, hashes of the others."""
        sizes = np.array([len(w) for w in lists])
        value, hit, hashes = self.look_up([w for x in lists for w in x])
        owner = np.repeat(np.arange(len(lists)), sizes)
        sums = [np.bincount(owner, x, len(lists)) for x in (value, np.where(hit, np.maximum(value - EXCESS, 0), 0))]
        out, at = [], 0
        for i, n in enumerate(sizes.tolist()):
            here = slice(at, at + n)
            at += n
            top = np.append(value[here][hit[here]], [-np.inf, -np.inf])
            out.append([n, sums[0][i], sums[1][i], np.partition(top, -2)[-2:], hashes[here][~hit[here]].view(np.int64)])
        return out

    def describe(self, texts: list[str]) -> list[tuple]:
        """Words, sum and summed excess of the first tier's, the two most toxic of them, hashes of the others."""
        out = []
        for part in slices(texts, TEXT_CHARS // 2):
            if len(part) > 1:
                found = self._sums([words_of(t) for t in part])
            else:
                # A text of its own slice may have several lists.
                lists = [self._sums([w])[0] for w in word_lists(part[0])]
                n, s, e, tops, rest = zip(*lists)
                found = [[sum(n), sum(s), sum(e), np.partition(np.concatenate(tops), -2)[-2:], np.concatenate(rest)]]
            out += [(n, s, e, top[1], top[0], rest) for n, s, e, top, rest in found]
        return out


def measure(texts: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """``id, text_hash, x`` of every text: difference per word, excess per word, and difference of the
    second most toxic word."""
    spark = texts.sparkSession
    least = _least(words, most)
    model = _first_tier(words, "word", "v", least)
    model = ship(spark, model, sum(a.nbytes for a in model))

    @F.pandas_udf("n long, s double, e double, a double, b double, rest array<bigint>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        state, key = worker_state(), ("differences", len(model.value[0]), model.value[1].tobytes()[:4096], float(model.value[1].sum()))
        if key not in state:
            state[key] = Differences(*model.value)
        for texts in batches:
            yield pd.DataFrame(state[key].describe(list(texts)), columns=["n", "s", "e", "a", "b", "rest"])

    rows = texts.select("id", F.xxhash64("text").alias("text_hash"), describe("text").alias("m"))
    rows = _stored(rows.select("id", "text_hash", "m.*", F.monotonically_increasing_id().alias("row")))
    rare = words.where(F.col("n") < least).select("word", "v")
    late = rows.select("row", "b", F.explode("rest").alias("word")).join(rare, "word").groupBy("row").agg(
        F.sum("v").alias("s2"), F.sum(F.greatest(F.col("v") - EXCESS, F.lit(0.0))).alias("e2"),
        F.collect_list(F.expr("CASE WHEN v > b THEN v END")).alias("tops"),
    )
    second = "sort_array(concat(array(a, b), coalesce(tops, CAST(array() AS array<double>))), false)[1]"
    whole = rows.join(late, "row", "left").selectExpr(
        "id", "text_hash", f"""CASE WHEN n > 0 THEN array((s + coalesce(s2, 0D)) / n, (e + coalesce(e2, 0D)) / n,
        CASE WHEN n > 1 THEN least(greatest({second}, -10D), 15D) ELSE 0D END) ELSE array(0D, 0D, 0D) END AS x"""
    )
    return _stored(whole)


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights of a lightly penalised logistic curve over the columns of x and an offset (Newton's method)."""
    scale = np.append(x.std(0) + 1e-9, 1.0)
    a, w = np.c_[x, np.ones(len(x))] / scale, np.zeros(x.shape[1] + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        curve = (a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(len(w))
        step = np.linalg.solve(curve, a.T @ (y - p) - 0.01 * w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return w / scale


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
    entries: int = MODEL_ENTRIES, words: int = WORDS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted, text_hash`` of every row, taught by the labelled ones."""
    marks = teaching_labels(labels, label, FOLDS, HELD_OUT)
    # Every step's result is stored: what was shuffled for it is not kept beside it.
    with brief_shuffles(docs.sparkSession):
        share = min(CALIBRATION, CALIBRATION_ROWS / max(1, marks.count()))
        spared = sampled("id", share)
        # The same join at every size.
        rows = labelled(docs, marks.where(~spared).hint("merge"), FOLDS, HELD_OUT, id_col, text_col)
        ratios = log_ratios(_stored(count_ngrams(rows)))
        texts = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
        measured = measure(texts, word_differences(texts, ratios, entries), words)
        points = measured.join(marks.where(spared), "id").select("x", "y").toPandas()
    toxic, total = int(points["y"].sum()), len(points)
    if 0 < toxic < total:
        *weights, offset = fit_curve(np.stack(points["x"].to_list()), points["y"].to_numpy(float)).tolist()
        raw = sum((F.col("x")[i] * w for i, w in enumerate(weights)), F.lit(offset))
        score = 1 / (1 + F.exp(-F.least(F.greatest(raw, F.lit(-30.0)), F.lit(30.0))))
    else:
        score = F.lit(toxic / total if total else 0.0)
    return measured.select(
        F.col("id").alias("doc_id"), (fold("id", FOLDS) == HELD_OUT).alias("held_out"), score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"), "text_hash",
    )


def keep_ordinary(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows that are not predicted toxic, decided by identifier and text; columns of any name stay as they are."""
    scores, name = toxicity_scores(docs, labels, id_col, text_col), spare(docs, "key")
    toxic = scores.where("predicted = 1").select(row_key("doc_id", "text_hash").alias(name)).distinct()
    key = row_key(F.col(id_col).cast("long"), F.xxhash64(whole_text(text_col)))
    return docs.join(toxic, key == F.col(name), "left_anti")
