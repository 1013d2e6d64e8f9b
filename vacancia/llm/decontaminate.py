"""Benchmark decontamination: an FM-index per shard of training texts, searched with the test phrases.

Every benchmark item gives its windows of ``window`` consecutive words; an item of fewer words, but
not none, is one window. Each shard, a batch of documents, is indexed once over an alphabet of words:
suffix order, Burrows-Wheeler transform, wavelet matrix for ranks, and positions sampled every
``SAMPLE`` words. All distinct windows are searched backward together; the rows that remain are
located by stepping to the next sampled position, and their words are merged into removal spans.

A word that no item holds can be in no occurrence. Such words end the indexed strings, and only
strings as long as the shortest window are indexed: what is left out cannot match.

* Windows and vocabulary are broadcast in blocks of ``BLOCK_BYTES`` of benchmark text at most; a
  larger benchmark takes one pass over the documents for each block, merged by row.
* A shard holds ``SHARD_WORDS`` indexed words at most. A longer text is cut into segments that overlap
  by one word less than a window, so none of its occurrences is lost and memory stays bounded.
* No shuffle with one block, and no limit on occurrences, items or documents.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null and empty texts have no
words and are not contaminated; null and wordless items have no window. Items that share an identifier
count as one; items without one mark words but are not listed. Rows repeat with their input, and further
columns of it are left alone. With no benchmark nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import row_key, ship, slices, whole_text

WINDOW = 10
#: Benchmark text in one broadcast, and words of an item in one piece of it.
BLOCK_BYTES, PIECE_WORDS = 8 << 20, 1 << 16
#: Indexed words of a shard and words of a segment, at most; a position is kept every so many words.
SHARD_WORDS, SAMPLE = 1 << 20, 4

# Lower-cases A-Z; every other ASCII character that is no digit or letter becomes a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def word_lists(text: str, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """A text's words, in lists from about ``size`` bytes each."""
    data, at = text.encode("utf-8", "surrogatepass").translate(_FOLD), 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = end if end >= 0 else len(data)
        yield data[at:end].split()
        at = end


class Wavelet:
    """Ranks of symbols in a sequence, by one bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        self.shifts = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        for shift in self.shifts:
            bit = (symbols >> shift) & 1 == 1
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(bit) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
            self.levels.append((words, before, int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        every = np.arange(largest + 1)
        self.start = self._follow(every, np.zeros(largest + 1, np.int64))

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        block, low = at >> 6, (at & 63).astype(np.uint64)
        return before[block] + np.bitwise_count(words[block] & ((np.uint64(1) << low) - np.uint64(1)))

    def _follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, (words, before, zeros) in zip(self.shifts, self.levels):
            ones = self._ones(words, before, at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are ``symbol``."""
        return self._follow(symbol, at) - self.start[symbol]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbol = np.zeros(len(at), np.int64)
        for words, before, zeros in self.levels:
            bit = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(words, before, at)
            symbol = symbol * 2 + bit
            at = np.where(bit, zeros + ones, at - ones)
        return symbol, at - self.start[symbol]


def _open_slots(head: np.ndarray) -> np.ndarray:
    """Which entries share their group, if groups begin at the heads."""
    return ~(head & np.append(head[1:], True))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes of strings that end in 0. Ends differ from each other, by their order.

    Prefix doubling that sorts only suffixes still alike.
    """
    n = len(text)
    rank = text.astype(np.int64) + n
    ends = np.flatnonzero(text == 0)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    slots, key, length = np.arange(n), rank[order], 0
    while True:
        head = np.append(True, key[1:] != key[:-1])
        rank[order[slots]] = np.maximum.accumulate(np.where(head, slots, 0))
        slots = slots[_open_slots(head)]
        if not len(slots):
            return order
        length = length * 2 or 1
        some = order[slots]
        # Suffixes alike in so many words have not ended within them.
        key = rank[some] * n + rank[some + length]
        by = np.argsort(key, kind="stable")
        order[slots], key = some[by], key[by]


class FmIndex:
    """Occurrences of phrases in strings of words 1 and up, each string ended by 0."""

    def __init__(self, text: np.ndarray, largest: int, sample: int = SAMPLE):
        order = suffix_order(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])
        self.last_column = Wavelet(text[order - 1].astype(np.int64), largest)
        # Sampled from the start of each string, so that no step leaves it.
        starts = np.append(0, np.flatnonzero(text == 0)[:-1] + 1)
        begun = np.zeros(len(text), np.int64)
        begun[starts] = starts
        inside = np.arange(len(text)) - np.maximum.accumulate(begun)
        self.kept = inside[order] % sample == 0
        self.index = np.cumsum(self.kept) - 1
        self.places = order[self.kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row (exclusive) of each phrase; phrases stand at the right of their matrix row."""
        width = phrases.shape[1]
        low, high = self.first[phrases[:, -1]], self.first[phrases[:, -1] + 1]
        for column in range(width - 2, -1, -1):
            on = np.flatnonzero((lengths >= width - column) & (low < high))
            if not len(on):
                break
            word = phrases[on, column].astype(np.int64)
            low[on] = self.first[word] + self.last_column.rank(word, low[on])
            high[on] = self.first[word] + self.last_column.rank(word, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by steps backward to a sampled one."""
        out, on, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(on):
            hit = self.kept[rows]
            out[on[hit]] = self.places[self.index[rows[hit]]] + steps
            on, rows = on[~hit], rows[~hit]
            word, before = self.last_column.read(rows)
            rows, steps = self.first[word] + before, steps + 1
        return out


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    sizes = high - low
    owner = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner], owner


def _pairs(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order; b is below n."""
    return np.divmod(np.unique(a * max(1, n) + b), max(1, n))


class Phrases:
    """The windows of benchmark pieces (identifier or None, words)."""

    def __init__(self, pieces: list[tuple], window: int):
        code: dict[bytes, int] = {}
        rows, owners = [], []
        for number, (_, words) in enumerate(pieces):
            codes = np.array([code.setdefault(w, len(code) + 1) for w in words.split()], np.int32)
            if len(codes) < window:
                rows.append(np.pad(codes, (window - len(codes), 0))[None])
            else:
                rows.append(np.lib.stride_tricks.sliding_window_view(codes, window))
            owners.append(np.full(len(rows[-1]), number))
        self.words = b" ".join(code)
        every = np.concatenate(rows) if rows else np.zeros((0, window), np.int32)
        self.matrix, which = np.unique(every, axis=0, return_inverse=True)
        self.lengths = (self.matrix > 0).sum(1)
        pairs = _pairs(which.ravel(), np.concatenate(owners or [np.zeros(0, int)]), len(pieces))
        self.begin = np.searchsorted(pairs[0], np.arange(len(self.matrix) + 1))
        self.piece = pairs[1]
        self.ids = [i for i, _ in pieces]

    @property
    def nbytes(self) -> int:
        return len(self.words) + self.matrix.nbytes + self.begin.nbytes + self.piece.nbytes + 64 * len(self.ids)


class Shard:
    """Documents of one batch: their indexed segments, and what was found in them."""

    def __init__(self, phrases: Phrases, code: dict[bytes, int]):
        self.phrases, self.code = phrases, code
        self.least = int(phrases.lengths.min()) if len(phrases.lengths) else 0
        self.longest = phrases.matrix.shape[1]
        self.n_words: list[int] = []
        self.waiting, self.held, self.found = [], 0, []

    def add(self, text: str) -> None:
        get, at, tail = self.code.get, 0, np.zeros(0, np.int32)
        for words in word_lists(text):
            codes = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
            start = at - len(tail)
            at += len(words)
            if self.least:
                # The next list sees the end of this one.
                codes = np.concatenate([tail, codes])
                self._keep(codes, start)
                tail = codes[max(0, len(codes) - self.longest + 1) :]
        self.n_words.append(at)

    def _keep(self, codes: np.ndarray, start: int) -> None:
        """Put strings of known words that can hold a window on the waiting list."""
        known = np.concatenate([[False], codes > 0, [False]])
        edge = np.flatnonzero(known[1:] != known[:-1])
        begin, end = edge[::2], edge[1::2]
        long = end - begin >= self.least
        if not long.any():
            return
        at, owner = _spread(begin[long], end[long] + 1)
        text = np.append(codes, np.int32(0))[at]
        self.waiting.append((text, np.full(len(at), len(self.n_words), np.int32), at + start))
        self.held += len(at)
        if self.held >= SHARD_WORDS:
            self.search()

    def search(self) -> None:
        """Index what waits and look up all windows."""
        if not self.held:
            return
        text, doc, place = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.held = [], 0
        index = FmIndex(text, len(self.code))
        low, high = index.search(self.phrases.matrix, self.phrases.lengths)
        hit = np.flatnonzero(low < high)
        rows, owner = _spread(low[hit], high[hit])
        at, window = index.locate(rows), hit[owner]
        self.found.append((doc[at].astype(np.int64), place[at], window))

    def results(self) -> tuple[list, list, list]:
        """Words, merged spans and listed items of each document."""
        self.search()
        n = len(self.n_words)
        doc, place, window = (np.concatenate(x) for x in zip(*self.found)) if self.found else (np.zeros(0, np.int64),) * 3
        base = np.append(0, np.cumsum(np.array(self.n_words, np.int64) + 1))
        start = base[doc] + place
        by = np.argsort(start)
        start, end = start[by], np.maximum.accumulate((start + self.phrases.lengths[window])[by]) if len(by) else start
        # Spans that touch are one.
        head = np.append(True, start[1:] > end[:-1]) if len(by) else np.zeros(0, bool)
        first, last = start[head], end[np.append(head[1:], True)] if len(by) else end
        owner = np.searchsorted(base, first, "right") - 1
        spans = np.stack([first - base[owner], last - base[owner]], 1)
        spans = np.split(spans, np.searchsorted(owner, np.arange(1, n)))
        pairs, ids = _pairs(doc, window, len(self.phrases.matrix)), self.phrases.ids
        entry, which = _spread(self.phrases.begin[pairs[1]], self.phrases.begin[pairs[1] + 1])
        pairs = _pairs(pairs[0][which], self.phrases.piece[entry], len(ids))
        items = [
            sorted({ids[i] for i in part if ids[i] is not None})
            for part in np.split(pairs[1], np.searchsorted(pairs[0], np.arange(1, n)))
        ]
        return self.n_words, [[(int(a), int(b)) for a, b in s] for s in spans] if n else [], items if n else []


def benchmark_pieces(benchmark: DataFrame, id_col: str, text_col: str, window: int, piece_words: int = PIECE_WORDS) -> DataFrame:
    """``item, words, size``: items of some words, long ones in pieces that overlap by a word less than a window."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"]):
                held: list[bytes] = []
                out = []
                for words in word_lists(text, piece_words):
                    held += words
                    while len(held) >= piece_words + window:
                        out.append(b" ".join(held[:piece_words]))
                        held = held[piece_words - window + 1 :]
                if held:
                    out.append(b" ".join(held))
                yield pd.DataFrame({"item": item, "words": pd.Series(out, dtype=object), "size": [len(x) for x in out]})

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(cut, "item string, words binary, size long")


def _contaminated(docs: DataFrame, pieces: DataFrame, window: int) -> DataFrame:
    """The rows of docs (key, text) with ``n_words, spans, items`` by the pieces of one block."""
    phrases = Phrases([(r["item"], bytes(r["words"])) for r in pieces.collect()], window)
    data = ship(docs.sparkSession, phrases, phrases.nbytes)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        phrases = data.value
        code = {w: i for i, w in enumerate(phrases.words.split(), 1)}
        for batch in batches:
            shard = Shard(phrases, code)
            for part in slices(batch["text"]):
                for text in part:
                    shard.add(text)
            n_words, spans, items = shard.results()
            yield pd.DataFrame({
                "key": batch["key"], "n_words": n_words, "spans": pd.Series(spans, batch.index, dtype=object),
                "items": pd.Series(items, batch.index, dtype=object),
            })

    schema = f"key {docs.schema['key'].dataType.simpleString()}, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    return docs.select("key", "text").mapInPandas(search, schema)


def _union_spans(spans: str) -> str:
    """SQL for spans merged where they touch, from an array of any spans."""
    return f"""aggregate(array_sort({spans}), CAST(array() AS array<struct<start:bigint,end:bigint>>), (done, x) ->
        IF(size(done) > 0 AND element_at(done, -1).end >= x.start,
           concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, x.end)))),
           concat(done, array(x))))"""


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row: spans of hit word numbers (end exclusive), and item
    identifiers as sorted strings."""
    pieces = cut_lineage(benchmark_pieces(benchmark, item_col, item_text, window))
    total = pieces.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    identifier, text = F.col(id_col).cast("long"), whole_text(text_col)
    if blocks == 1:
        return _contaminated(docs.select(identifier.alias("key"), text.alias("text")), pieces, window).withColumnRenamed("key", "doc_id")
    block = F.pmod(F.xxhash64("words", "item"), F.lit(blocks))
    key = row_key(identifier, F.sha2(text, 256))
    distinct = docs.select(key.alias("key"), text.alias("text")).dropDuplicates(["key"])
    parts = [cut_lineage(_contaminated(distinct, pieces.where(block == i), window)) for i in range(blocks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    merged = found.groupBy("key").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merged = merged.selectExpr("key", "n_words", f"{_union_spans('spans')} AS spans", "items")
    return docs.select(identifier.alias("doc_id"), key.alias("key")).join(merged, "key").drop("key")


def with_digests(found: DataFrame) -> DataFrame:
    """``n_hit, n_items, items_sha256, contaminated`` beside the spans."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans",
    )


def without_spans(text: str, spans: str):
    """Column: the text without the words of its spans and what stands between them."""
    import re

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, parts in zip(texts, spans):
            if not text or parts is None or not len(parts):
                out.append(text)
                continue
            places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
            kept, at = [], 0
            for part in parts:
                kept.append(text[at : places[part["start"]][0]])
                at = places[part["end"] - 1][1]
            out.append("".join([*kept, text[at:]]))
        return pd.Series(out, dtype=object)

    return cut(text, spans)
