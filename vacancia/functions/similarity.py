"""Similarity ratios, and lossless signatures that turn a similarity join into an equi join.

Every ratio used here is bounded by how many characters two strings share as bags:

* sequence ratio ``2*M/(la+lb)``: the M matched characters occur in both strings, so bags that
  share fewer than ``t*(la+lb)/2`` characters cannot reach ``t``;
* edit similarity ``1 - d/max(la,lb)``: every edit spoils at most one character of the longer
  string, so the bags share at least ``t*max(la,lb)``.

Two bags that share ``o`` of their characters must share ``k`` characters among the first
``len - o + k`` of each, in any common order. Putting rare characters first makes these heads
selective, and the k-subsets of the head are exact join keys: no qualifying pair is lost.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The helpers below travel with the functions that use them, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# English letters from rare to common; any other character counts as rare.
_RARE_FIRST = "zqxjkvbpygfwmucldrhsnioate "


def ratio_at_least(threshold: float) -> Callable[[Column, Column], Column]:
    """Sequence ratio of two text columns (argument order kept); null when below ``threshold``."""

    @F.pandas_udf("double")
    def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
        matcher, last, out = SequenceMatcher(None), None, []
        for a, b in zip(left, right):
            if b != last:
                matcher.set_seq2(b)
                last = b
            matcher.set_seq1(a)
            possible = matcher.real_quick_ratio() >= threshold and matcher.quick_ratio() >= threshold
            score = matcher.ratio() if possible else 0.0
            out.append(score if score >= threshold else None)
        return pd.Series(out, dtype="float64")

    return lambda a, b: F.nanvl(ratio(a, b), F.lit(None))


def edit_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def _least_overlap(length: int, threshold: float, kind: str) -> int:
    """Fewest shared characters with any partner that can reach the threshold."""
    if kind == "edit":
        return math.ceil(threshold * length - 1e-9)
    shortest = math.ceil(threshold / (2 - threshold) * length - 1e-9)
    return math.ceil(threshold * (length + shortest) / 2 - 1e-9)


def _bag(text: str) -> list[str]:
    """Occurrence-numbered characters, rare first: a repeat of a letter is rarer than the letter."""
    seen: Counter = Counter()
    tokens = []
    for ch in text:
        seen[ch] += 1
        tokens.append((_RARE_FIRST.find(ch) - 6 * (seen[ch] - 1), ch, seen[ch]))
    tokens.sort()
    return [f"{ch}{nth}" for _, ch, nth in tokens]


def signatures(threshold: float, kind: str = "sequence", k: int = 3) -> Callable[[Column], Column]:
    """Join keys of a text: any two texts that reach ``threshold`` have at least one in common."""
    # Pairs so short that they may share fewer than k characters meet on single characters.
    short = 2 * (k - 1) / threshold

    @F.pandas_udf("array<string>")
    def keys(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            bag = _bag(text)
            head = bag[: len(bag) - _least_overlap(len(bag), threshold, kind) + k]
            found = ["|".join(c) for c in combinations(head, k)]
            if len(bag) <= short:
                found += bag
            out.append(found)
        return pd.Series(out)

    return keys


def length_compatible(a: Column, b: Column, threshold: float, kind: str = "sequence") -> Column:
    la, lb = F.length(a), F.length(b)
    short, long = F.least(la, lb), F.greatest(la, lb)
    if kind == "edit":
        return short >= threshold * long - 1e-9
    return 2 * short >= threshold * (la + lb) - 1e-9


def may_reach(a: Column, b: Column, threshold: float) -> Column:
    """Whether two texts can have that sequence ratio, decided JVM-side.

    Characters outside the matched ones number ``la + lb - 2 * M``. Deleting and inserting them turns one text
    into the other, so the edit distance is no larger; it is calculated up to that bound only.
    """
    most = F.floor((1 - threshold) * (F.length(a) + F.length(b)) + 1e-9).cast("int")
    return F.call_function("levenshtein", a, b, most) >= 0


def _shared_characters(lefts: list[str], rights: list[str], threshold: float, kind: str) -> tuple[np.ndarray, ...]:
    """Pairs (i, j), and the most characters they can have in order alike: those whose bags share enough characters, and of names up to 64 long whose common subsequences are long enough.

    Matched blocks, and characters that no edit touches, are a common subsequence.
    """
    alphabet = {ch: n for n, ch in enumerate(sorted(set("".join(lefts)) & set("".join(rights))))}
    none, width = len(alphabet), max(map(len, rights))
    wide = np.uint8 if width < 256 else np.int32
    counts = np.zeros((none + 1, len(rights)), dtype=wide)
    codes = np.full((len(rights), min(width, 64)), none, dtype=np.int32)
    for j, text in enumerate(rights):
        for n, ch in enumerate(text):
            at = alphabet.get(ch, none)
            counts[at, j] += 1
            if n < 64:
                codes[j, n] = at
    la, lb = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])

    def least(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.ceil((threshold * np.maximum(x, y) if kind == "edit" else threshold * (x + y) / 2) - 1e-9)

    masks = np.zeros((len(lefts), none + 1), dtype=np.uint64)
    rows, cols, most = [], [], []
    for i, text in enumerate(lefts):
        overlap = np.zeros(len(rights), dtype=np.int32 if wide is np.int32 else np.uint16)
        for ch, n in Counter(text).items():
            if ch in alphabet:
                overlap += np.minimum(counts[alphabet[ch]], min(n, np.iinfo(wide).max))
        hit = np.flatnonzero(overlap >= least(la[i], lb))
        rows.append(np.full(len(hit), i)), cols.append(hit), most.append(overlap[hit].astype(np.int64))
        for n, ch in enumerate(text[:64]):
            if ch in alphabet:
                masks[i, alphabet[ch]] |= np.uint64(1 << n)
    rows, cols, most = np.concatenate(rows), np.concatenate(cols), np.concatenate(most)
    for at in range(0, len(rows), 16_384):
        i, j = rows[at : at + 16_384], cols[at : at + 16_384]
        # Longest common subsequence of all pairs, a bit for each character on the left: the bits that are off at the end.
        v = np.full(len(i), ~np.uint64(0))
        for n in range(int(min(lb[j].max(initial=0), 64))):
            u = v & masks[i, codes[j, n]]
            v = (v + u) | (v - u)
        long = (la[i] > 64) | (lb[j] > 64)
        most[at : at + 16_384] = np.where(long, most[at : at + 16_384], np.bitwise_count(~v))
    keep = most >= least(la[rows], lb[cols])
    return rows[keep], cols[keep], most[keep]


def _least_alike(a: int | np.ndarray, b: int | np.ndarray, threshold: float, kind: str) -> np.ndarray:
    """Fewest characters that two texts of these lengths have in order alike if they reach the threshold."""
    return np.ceil((threshold * np.maximum(a, b) if kind == "edit" else threshold * (a + b) / 2) - 1e-9)


def _edits(a: str, b: str) -> int:
    """Edit distance; a column of the table is two numbers of a bit for each character of ``a``."""
    if not a:
        return len(b)
    at: dict[str, int] = {}
    for n, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << n
    full, last, more, less, score = (1 << len(a)) - 1, 1 << len(a) - 1, (1 << len(a)) - 1, 0, len(a)
    for ch in b:
        same = at.get(ch, 0)
        diagonal = (((same & more) + more) ^ more) | same
        up, down = less | ~(diagonal | more) & full, more & diagonal
        score += bool(up & last) - bool(down & last)
        up, down = up << 1 | 1, down << 1
        more, less = (down | ~(same | less | up)) & full, up & (same | less) & full
    return score


def _alike(a: str, b: str, threshold: float, kind: str, matcher: SequenceMatcher) -> bool:
    """Whether an earlier and a later text reach the threshold, as ``edit_similarity`` and ``ratio_at_least`` say."""
    if kind == "edit":
        longest = max(len(a), len(b))
        return longest == 0 or 1 - _edits(a, b) / longest >= threshold
    matcher.set_seqs(a, b)
    return matcher.real_quick_ratio() >= threshold and matcher.quick_ratio() >= threshold and matcher.ratio() >= threshold


def first_leaders(threshold: float, kind: str = "sequence") -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For ``mapInPandas``: companies (company_key, tids, titles) of few titles, in order, to their absorbed titles (company_key, title, tid, leader)."""

    def leaders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, places = SequenceMatcher(None), {}

        def bag(text: str) -> int:
            """A bit for each occurrence-numbered character."""
            seen: Counter = Counter()
            bits = 0
            for ch in text:
                seen[ch] += 1
                bits |= 1 << places.setdefault((ch, seen[ch]), len(places))
            return bits

        for batch in batches:
            out = []
            for company, tids, titles in zip(batch["company_key"], batch["tids"], batch["titles"]):
                heads: list[tuple] = []
                for tid, title in zip(tids.tolist(), titles):
                    own, size = bag(title), len(title)
                    for head, text, other, length in heads:
                        least = max(threshold * max(size, length) if kind == "edit" else threshold * (size + length) / 2, 0) - 1e-9
                        if head < tid and min(size, length) >= least and (own & other).bit_count() >= least and _alike(text, title, threshold, kind, matcher):
                            out.append((company, title, tid, head))
                            break
                    else:
                        heads.append((tid, title, own, size))
            if out:
                yield pd.DataFrame({name: np.array(column, dtype=kept) for name, column, kept in zip(("company_key", "title", "tid", "leader"), zip(*out), (object, object, np.int64, np.int64))})

    return leaders


def bag_bits(c: Column) -> Column:
    """64 bits of a text's occurrence-numbered characters; two texts differ in no more bits than their bags do in characters."""

    @F.pandas_udf("bigint")
    def bits(texts: pd.Series) -> pd.Series:
        places: dict[tuple[str, int], int] = {}

        def place(ch: str, nth: int) -> int:
            at = "abcdefghijklmnopqrstuvwxyz ".find(ch)
            if at < 0:
                return 1 << 57 + (ord(ch) + nth) % 7
            return 1 << (at if nth == 1 else 27 + at % 20 if nth == 2 else 47 + (at + nth) % 10)

        out = np.zeros(len(texts), dtype=np.uint64)
        for n, text in enumerate(texts):
            seen: Counter = Counter()
            found = 0
            for ch in text:
                seen[ch] += 1
                token = (ch, seen[ch])
                if token not in places:
                    places[token] = place(*token)
                found |= places[token]
            out[n] = found
        return pd.Series(out.view(np.int64))

    return bits(c)


class _Block:
    """Texts by length, as arrays: their bags of 64 bits, and the codes of their first 64 characters."""

    def __init__(self, tids: np.ndarray, texts: np.ndarray, bits: np.ndarray):
        lengths = np.array([len(x) for x in texts], dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        self.length, self.tid = lengths[order], np.asarray(tids)[order]
        self.bits = np.ascontiguousarray(np.asarray(bits)[order]).view(np.uint64)
        self.text = np.asarray(texts, dtype=object)[order]
        self.wide = min(int(self.length.max(initial=1)) or 1, 64)
        # An end mark would be cut off by numpy, but lengths are known.
        self.chars = np.array([x[: self.wide] for x in self.text], dtype=f"U{self.wide}").view(np.uint32).reshape(len(self.text), self.wide)


def _near_by_bags(a: _Block, b: _Block, alone: bool, threshold: float, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts of the pairs (i, j) whose lengths and bags may reach the threshold; of one block each pair once."""
    rows, cols, held, limits = [], [], 0, {}
    for i in range(len(a.text)):
        size = int(a.length[i])
        if size not in limits:
            least = _least_alike(size, b.length, threshold, kind)
            fit = np.flatnonzero(least <= np.minimum(size, b.length))
            low, high = (int(fit[0]), int(fit[-1]) + 1) if len(fit) else (0, 0)
            limits[size] = low, high, np.clip(size + b.length[low:high] - 2 * least[low:high], 0, 255).astype(np.uint8)
        low, high, limit = limits[size]
        start = max(low, i + 1) if alone else low
        hit = np.flatnonzero(np.bitwise_count(b.bits[start:high] ^ a.bits[i]) <= limit[start - low :]) if start < high else ()
        if len(hit):
            rows.append(np.full(len(hit), i)), cols.append(hit + start)
            held += len(hit)
        if held >= 262_144:
            yield np.concatenate(rows), np.concatenate(cols)
            rows, cols, held = [], [], 0
    if held:
        yield np.concatenate(rows), np.concatenate(cols)


def _in_order(a: _Block, b: _Block, kind: str) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """For pairs of texts up to 64 long: their longest common subsequence, or their edit distance."""
    letters = np.unique(a.chars)
    code = np.minimum(np.searchsorted(letters, b.chars), len(letters) - 1)
    code = np.where(letters[code] == b.chars, code, len(letters)).astype(np.int32)
    masks = np.zeros((len(a.text), len(letters) + 1), dtype=np.uint64)
    each, own = np.arange(len(a.text)), np.searchsorted(letters, a.chars)
    for n in range(a.wide):
        masks[each, own[:, n]] |= np.where(n < a.length, np.uint64(1 << n), np.uint64(0))
    one = np.uint64(1)

    def common(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        v = np.full(len(i), ~np.uint64(0))
        for n in range(int(min(b.length[j].max(initial=0), 64))):
            u = v & np.where(n < b.length[j], masks[i, code[j, n]], np.uint64(0))
            v = (v + u) | (v - u)
        return np.bitwise_count(~v).astype(np.int64)

    def edits(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        last = (np.maximum(a.length[i], 1) - 1).astype(np.uint64)
        more, less, score = np.full(len(i), ~np.uint64(0)), np.zeros(len(i), dtype=np.uint64), a.length[i].copy()
        for n in range(int(min(b.length[j].max(initial=0), 64))):
            same, within = masks[i, code[j, n]], n < b.length[j]
            diagonal = (((same & more) + more) ^ more) | same
            up, down = less | ~(diagonal | more), more & diagonal
            score += within * ((up >> last & one).astype(np.int64) - (down >> last & one).astype(np.int64))
            up, down = up << one | one, down << one
            more, less = np.where(within, down | ~(same | less | up), more), np.where(within, up & (same | less), less)
        return score

    return edits if kind == "edit" else common


def near_titles(threshold: float, kind: str, crowded: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For ``mapInPandas``: pairs of blocks of a company's titles to all pairs (company_key, early, late) that reach the threshold.

    Bags of 64 bits leave few pairs, common subsequences or edit distances fewer, all on arrays; the sequence ratio is taken of
    those. Blocks with more than ``crowded`` such pairs a title say so by a row of the company alone and end there.
    """

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = SequenceMatcher(None)

        def found(a: _Block, b: _Block, alone: bool) -> tuple[list[np.ndarray], list[np.ndarray]] | None:
            early, late, n = [], [], 0
            measure = _in_order(a, b, kind)
            for rows, cols in _near_by_bags(a, b, alone, threshold, kind):
                short = (a.length[rows] <= 64) & (b.length[cols] <= 64)
                value = np.zeros(len(rows), dtype=np.int64)
                value[short] = measure(rows[short], cols[short])
                longest = np.maximum(np.maximum(a.length[rows], b.length[cols]), 1)
                near = 1 - value / longest >= threshold if kind == "edit" else value >= _least_alike(a.length[rows], b.length[cols], threshold, kind)
                keep = ~short | near
                i, j, sure = rows[keep], cols[keep], (short & (kind == "edit"))[keep]
                n += len(i)
                if n > crowded * (len(a.text) + len(b.text)):
                    return None
                first, second = np.minimum(a.tid[i], b.tid[j]), np.maximum(a.tid[i], b.tid[j])
                sure &= first < second
                for k in np.flatnonzero(~sure & (first < second)).tolist():
                    x, y = a.text[i[k]], b.text[j[k]]
                    if a.tid[i[k]] > b.tid[j[k]]:
                        x, y = y, x
                    sure[k] = _alike(x, y, threshold, kind, matcher)
                early.append(first[sure]), late.append(second[sure])
            return early, late

        def rows(company: list, early: list | np.ndarray, late: list | np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"company_key": np.array(company, dtype=object), "early": pd.array(early, dtype="Int64"), "late": pd.array(late, dtype="Int64")})

        for batch in batches:
            for company, left, texts, bits, right, others, marks in zip(*(batch[c] for c in ("company_key", "a_tid", "a_title", "a_bits", "b_tid", "b_title", "b_bits"))):
                alone = right is None
                a = _Block(left, texts, bits)
                pairs = found(a, a if alone else _Block(right, others, marks), alone)
                if pairs is None:
                    yield rows([company], [None], [None])
                elif pairs[0]:
                    yield rows([None] * sum(map(len, pairs[0])), *map(np.concatenate, pairs))

    return near


def taken_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For ``mapInPandas`` in one task: similar pairs (early, late) by late, then early, to the titles that an earlier leader takes."""
    taken: set[int] = set()
    for batch in batches:
        out = []
        for early, late in zip(batch["early"].tolist(), batch["late"].tolist()):
            if late not in taken and early not in taken:
                taken.add(late)
                out.append(late)
        if out:
            yield pd.DataFrame({"tid": np.array(out, dtype=np.int64)})


def near_names(threshold: float, kind: str = "sequence") -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For ``mapInPandas``: blocks (as_, bs, ords) to the pairs (a, b, cand_ord, score) that may reach the threshold.

    Of the sequence ratio, the best pairs of each left name with their score: all that share the
    highest one, so that a tie can be settled. Of the edit measure all pairs, without a score. Pairs leave in parts
    of bounded size, so those of many blocks are never held together.
    """

    def best(i: int, near: list[int], most: list[int], lefts: list[str], rights: list[str], matcher: SequenceMatcher) -> list[tuple]:
        a, top, out = lefts[i], threshold, []
        matcher.set_seq1(a)
        for bound, j in sorted(((2.0 * m / (len(a) + len(rights[j])), j) for m, j in zip(most, near)), reverse=True):
            if bound < top:
                break
            matcher.set_seq2(rights[j])
            score = matcher.ratio()
            if score >= top:
                out, top = [x for x in out if x[2] >= score] + [(i, j, score)], score
        return out

    def table(parts: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        return pd.DataFrame({name: np.concatenate(column) for name, column in zip(("a", "b", "cand_ord", "score"), zip(*parts))})

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, parts, held, most_pairs = SequenceMatcher(None), [], 0, 65_536
        for batch in batches:
            for lefts, rights, ords in zip(batch["as_"], batch["bs"], batch["ords"]):
                a, b = list(lefts), list(rights)
                i, j, most = _shared_characters(a, b, threshold, kind)
                score = np.full(len(i), np.nan)
                if kind != "edit":
                    found: list[tuple] = []
                    ends = np.searchsorted(i, np.arange(len(a) + 1))
                    for n in np.unique(i).tolist():
                        own = slice(ends[n], ends[n + 1])
                        found += best(n, j[own].tolist(), most[own].tolist(), a, b, matcher)
                    i, j, score = (np.array([x[k] for x in found], dtype=t) for k, t in enumerate((np.int64, np.int64, float)))
                for at in range(0, len(i), most_pairs):
                    x, y = i[at : at + most_pairs], j[at : at + most_pairs]
                    parts.append((np.asarray(lefts, dtype=object)[x], np.asarray(rights, dtype=object)[y], np.asarray(ords)[y], score[at : at + most_pairs]))
                    held += len(x)
                    if held >= most_pairs:
                        yield table(parts)
                        parts, held = [], 0
        if parts:
            yield table(parts)

    return near


def shared_buckets(keyed: DataFrame, spread: int = 10_000) -> DataFrame:
    """Keep buckets with at least two members, and say over how many salts each one is spread."""
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return (
        keyed.drop("salts")
        .join(sizes, "bucket")
        .withColumn("salts", F.ceil(F.col("_n") / spread).cast("int"))
        .drop("_n")
    )
