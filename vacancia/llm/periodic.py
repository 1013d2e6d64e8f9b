"""Periodic runs of words, by block convolution.

A run is a stretch of words with smallest period q and at least ``max(LEAST, TIMES * q)`` words that
no neighbour extends. At each dyadic scale b the words are cut into blocks of b. A run with period
q in [b, 2b) holds a whole block together with its copy q words later. So for each block the sum of
squared differences to the following window is calculated at all distances from b to 2b, exactly, by
number-theoretic transforms modulo as many primes as the sum needs. Distances with sum 0 seed a
run: neighbouring blocks with the same distance are one seed, which is extended word by word inside
the blocks next to it.

* A block matches at a distance below 2b only if each of its words comes again within 2b; other
  blocks are not transformed. In ordinary prose few blocks are left.
* A seed inside a run whose period divides the distance has a smaller period and is dropped.
* Documents are worked on together in slices of ``SLICE_WORDS`` words, or one longer text. Between
  them stands a word of its own. Nothing is shuffled.

Words are ``[^\\x20\\x09-\\x0D]+``. Null, empty and blank texts have no words and no run. Very long texts
keep word numbers and the distinct words, not their text. Rows repeat with their input.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, whole_text

#: Fewest words of a run, and fewest periods.
LEAST, TIMES = 6, 4
#: Words worked on together, and numbers transformed together, at most (or one longer text or block).
SLICE_WORDS, TRANSFORM = 1 << 19, 1 << 19
# Fixed value: primes k * 2^m + 1 below 2^31 with a primitive root.
PRIMES = ((2013265921, 31), (469762049, 3))
#: Words are numbered below this in a transform, so that sums stay below the product of the primes.
#: With more distinct words numbers are used again, and seeds are compared word by word.
CODES = 1 << 19
_GAP = re.compile(rb"[ \t-\r]")


def _modulo(x: np.ndarray, p: int) -> np.ndarray:
    # Division by a scalar is vectorised, the remainder is not.
    return x - x // np.uint64(p) * np.uint64(p)


def _roots(p: int, g: int, size: int) -> np.ndarray:
    """Powers 0 to size / 2 - 1 of a root of unity of order ``size``."""
    root, out = pow(g, (p - 1) // size, p), np.ones(1, np.uint64)
    while len(out) < size // 2:
        out = np.concatenate([out, _modulo(out * np.uint64(pow(root, len(out), p)), p)])
    return out


def transform(x: np.ndarray, p: int, g: int) -> np.ndarray:
    """Number-theoretic transform of rows, left in bit-reversed order."""
    rows, size = x.shape
    half = size // 2
    while half:
        x = x.reshape(rows, -1, 2, half)
        a, b = x[:, :, 0], x[:, :, 1]
        x = np.stack([_modulo(a + b, p), _modulo((a + (np.uint64(p) - b)) * _roots(p, g, 2 * half), p)], 2)
        half //= 2
    return x.reshape(rows, size)


def inverse(x: np.ndarray, p: int, g: int) -> np.ndarray:
    """Rows from their bit-reversed transform."""
    rows, size = x.shape
    half = 1
    while half < size:
        x = x.reshape(rows, -1, 2, half)
        a, b = x[:, :, 0], _modulo(x[:, :, 1] * _roots(p, pow(g, -1, p), 2 * half), p)
        x = np.stack([_modulo(a + b, p), _modulo(a + (np.uint64(p) - b), p)], 2)
        half *= 2
    return _modulo(x.reshape(rows, size) * np.uint64(pow(size, -1, p)), p)


def mismatches(blocks: np.ndarray, windows: np.ndarray, largest: int) -> list[np.ndarray]:
    """Sums of squared differences of each block of b to its window of 2b at offsets 0 to b - 1, as
    remainders by enough primes that only 0 has all remainders 0."""
    rows, b = blocks.shape
    bound, out = b * largest * largest, []
    if bound >= PRIMES[0][0] * PRIMES[1][0]:
        raise ValueError("codes too large for exact sums")
    for p, g in PRIMES if bound >= PRIMES[0][0] else PRIMES[:1]:
        pad = np.zeros((rows, 2 * b), np.uint64)
        # Correlation: the block stands reversed, and offset t comes out at t + b - 1.
        pad[:, :b] = blocks[:, ::-1]
        product = _modulo(transform(pad, p, g) * transform(windows.astype(np.uint64), p, g), p)
        cross = inverse(product, p, g)[:, b - 1 : 2 * b - 1]
        squares = _modulo(windows.astype(np.uint64) ** np.uint64(2), p)
        sums = np.concatenate([np.zeros((rows, 1), np.uint64), np.cumsum(squares, 1)], 1)
        moving = sums[:, b : 2 * b] - sums[:, :b]
        own = _modulo(blocks.astype(np.uint64) ** np.uint64(2), p).sum(1, dtype=np.uint64)[:, None]
        out.append(_modulo(moving + own + np.uint64(2) * (np.uint64(p) - cross), p))
    return out


class Known:
    """Runs found so far; which of them holds a stretch."""

    def __init__(self) -> None:
        self.start = self.end = self.period = np.zeros(0, np.int64)
        self._index()

    def _index(self) -> None:
        self.reach = np.maximum.accumulate(self.end) if len(self.end) else self.end
        new = np.append(True, self.reach[1:] > self.reach[:-1]) if len(self.end) else np.zeros(0, bool)
        self.farthest = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else self.start

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        rows = np.concatenate([[self.start, self.end, self.period], [start, end, period]], 1)
        self.start, self.end, self.period = np.unique(rows, axis=1)
        self._index()

    def period_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The period of the run that holds a stretch, 0 if none does.

        Of runs with periods below half of the stretch at most one can hold it, and that reaches farthest.
        """
        if not len(self.start):
            return np.zeros(len(start), np.int64)
        at = np.searchsorted(self.start, start, "right") - 1
        held = (at >= 0) & (self.reach[at] >= end)
        return np.where(held, self.period[self.farthest[at]], 0)


def _extend(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words from ``at`` on, by steps of +1 or -1, equal the word a period later."""
    done, on, n = np.zeros(len(at), np.int64), np.arange(len(at)), len(words)
    width = 8
    while len(on):
        rows = max(1, TRANSFORM // width)
        left = []
        for i in range(0, len(on), rows):
            some = on[i : i + rows]
            place = (at[some] + step * done[some])[:, None] + step * np.arange(width)
            later = place + period[some][:, None]
            same = (place >= 0) & (later < n)
            same &= words[np.clip(place, 0, n - 1)] == words[np.clip(later, 0, n - 1)]
            run = np.where(same.all(1), width, same.argmin(1))
            done[some] += run
            left.append(some[(run == width) & (done[some] <= most)])
        on, width = np.concatenate(left), min(2 * width, TRANSFORM)
    return done


def find_runs(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs in numbered words, of which no document has more than ``longest``."""
    n, none = len(words), np.iinfo(np.int64).max
    order = np.argsort(words, kind="stable")
    again = np.flatnonzero(words[order[1:]] == words[order[:-1]])
    wait = np.full(n, none)
    wait[order[again]] = order[again + 1] - order[again]
    known, b, top = Known(), 1, int(words.max(initial=0)) + 1
    while TIMES * b <= longest:
        alive = np.flatnonzero(wait < 2 * b)
        begin = alive * b
        stop = np.minimum(begin + 3 * b - 1, n)
        outer = known.period_of(begin, stop)
        # Inside a run of a smaller period a block comes again at multiples of that only.
        alive = alive[(outer == 0) & (begin + 2 * b <= n)]
        seeds = []
        largest = min(top, CODES, math.isqrt((PRIMES[0][0] * PRIMES[1][0] - 1) // b))
        codes = words if largest == top else words % largest
        for i in range(0, len(alive), rows := max(1, TRANSFORM // (2 * b))):
            some = alive[i : i + rows]
            place = (some * b)[:, None] + np.arange(b)
            window = (some * b + b)[:, None] + np.arange(2 * b)
            block, seen = codes[place] + 1, np.where(window < n, codes[np.minimum(window, n - 1)] + 1, 0)
            zero = np.logical_and.reduce([s == 0 for s in mismatches(block, seen, largest)])
            row, offset = np.nonzero(zero)
            seed = np.stack([some[row], offset + b])
            if largest < top:
                seed = seed[:, _extend(words, seed[0] * b, seed[1], 1, b) >= b]
            seeds.append(seed)
        block, period = np.concatenate([np.zeros((2, 0), np.int64), *seeds], 1)
        inner = known.period_of(block * b, block * b + b + period)
        keep = (inner == 0) | (period % np.maximum(inner, 1) > 0)
        found = _join(words, block[keep], period[keep], b)
        if len(found[0]):
            inner = known.period_of(found[0], found[1])
            true = (inner == 0) | (found[2] % np.maximum(inner, 1) > 0)
            known.add(*(x[true] for x in found))
        pairs = wait[: len(wait) // 2 * 2].reshape(-1, 2)
        wait, b = pairs.max(1), 2 * b
    return known.start, known.end, known.period


def _join(words: np.ndarray, block: np.ndarray, period: np.ndarray, b: int) -> list[np.ndarray]:
    """Runs from seeds (block, period): neighbouring blocks of one period are one stretch, then extended."""
    by = np.lexsort((block, period))
    block, period = block[by], period[by]
    head = np.ones(len(by), bool)
    head[1:] = (period[1:] != period[:-1]) | (block[1:] != block[:-1] + 1)
    tail = np.append(head[1:], True)[: len(by)]
    first, last, period = block[head] * b, (block[tail] + 1) * b, period[head]
    need = np.maximum(LEAST, TIMES * period)
    # Each side can gain less than a block, or that block would have been a seed.
    able = last - first + 2 * (b - 1) + period >= need
    first, last, period, need = first[able], last[able], period[able], need[able]
    start = first - _extend(words, first - 1, period, -1, b)
    end = last + _extend(words, last, period, 1, b) + period
    long = end - start >= need
    return [start[long], end[long], period[long]]


class Slice:
    """Documents worked on together: word numbers, and the distinct words behind them."""

    def __init__(self) -> None:
        self.number: defaultdict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.docs: list[np.ndarray] = []
        self.plain: list[str | None] = []
        self.held = 0

    def add(self, text: str, rebuild: Callable[[np.ndarray], np.ndarray] | None) -> None:
        data, at, parts, digest = text.encode("utf-8", "surrogatepass"), 0, [], hashlib.sha256()
        while at < len(data):
            gap = _GAP.search(data, at + (1 << 20))
            end = gap.start() if gap else len(data)
            words, at = data[at:end].split(), end
            if words:
                if rebuild is None:
                    digest.update((b" " if parts else b"") + b" ".join(words))
                parts.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.docs.append(codes if rebuild is None else rebuild(codes))
        self.plain.append(digest.hexdigest() if rebuild is None else None)
        self.held += len(codes) + 1

    def rows(self) -> Iterator[tuple]:
        """For each document its runs (start, length, period) and the digest of its kept words."""
        sizes = np.array([len(d) for d in self.docs], np.int64)
        base = np.append(0, np.cumsum(sizes + 1))
        whole = np.empty(base[-1], np.int64)
        for i, codes in enumerate(self.docs):
            whole[base[i] : base[i + 1] - 1] = codes
        # A word of its own between documents: no run spans it.
        whole[base[1:] - 1] = len(self.number) + np.arange(len(self.docs))
        start, end, period = find_runs(whole, int(sizes.max(initial=0)))
        order = np.lexsort((period, start))
        start, end, period = start[order], end[order], period[order]
        cut = np.searchsorted(start, base)
        names = list(self.number)
        for i, codes in enumerate(self.docs):
            here = slice(cut[i], cut[i + 1])
            runs = np.stack([start[here] - base[i], end[here] - start[here], period[here]], 1)
            if len(runs) or self.plain[i] is None:
                mark = np.zeros(len(codes) + 1, np.int64)
                np.add.at(mark, runs[:, 0] + runs[:, 2], 1)
                np.add.at(mark, runs[:, 0] + runs[:, 1], -1)
                codes, digest = codes[np.cumsum(mark)[:-1] == 0], hashlib.sha256()
                for at in range(0, len(codes), 1 << 16):
                    digest.update((b" " if at else b"") + b" ".join(map(names.__getitem__, codes[at : at + (1 << 16)].tolist())))
                yield runs, digest.hexdigest()
            else:
                yield runs, self.plain[i]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rebuild: Callable | None = None) -> DataFrame:
    """``doc_id, runs, collapsed_sha256`` of every row: runs by start and period, and the digest of the text
    whose runs are cut down to one period, words joined by one space.

    ``rebuild(doc_id, number of words)`` may return a function of the word numbers that makes another text of
    the same words before runs are looked for, or None.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(ids: list, part: Slice) -> pd.DataFrame:
            runs, digests = zip(*part.rows())
            return pd.DataFrame({
                "doc_id": pd.Series(ids, dtype="Int64"),
                "runs": pd.Series([[tuple(map(int, r)) for r in x] for x in runs], dtype=object), "collapsed_sha256": digests,
            })

        for batch in batches:
            part, ids = Slice(), []
            at = iter(batch["doc_id"])
            for texts in slices(batch["text"]):
                for text in texts:
                    doc = next(at)
                    doc = None if pd.isna(doc) else int(doc)
                    part.add(text, rebuild and rebuild(doc))
                    ids.append(doc)
                    if part.held >= SLICE_WORDS:
                        yield out(ids, part)
                        part, ids = Slice(), []
            if ids:
                yield out(ids, part)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(find, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed_sha256 string")


def with_digests(found: DataFrame) -> DataFrame:
    """``n_runs``, the longest run and ``runs_sha256`` beside the runs."""
    longest = F.expr("array_sort(runs, (x, y) -> CASE WHEN x.length <> y.length THEN IF(x.length > y.length, -1, 1) "
                     "WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1) ELSE IF(x.period < y.period, -1, IF(x.period > y.period, 1, 0)) END)")
    longest = F.get(longest, F.lit(0))
    lines = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n')), '')")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), F.sha2(lines, 256).alias("runs_sha256"), "collapsed_sha256")
    return rows.select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.expr("top.length * 1000L div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
