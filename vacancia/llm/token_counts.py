"""Token counts of a sentencepiece BPE vocabulary, by a two-tier lookup on the map side.

No piece of the vocabulary holds a space after another character, so no merge crosses the start of
a run of spaces: a text's count is the sum over its pre-tokens, each a run of spaces and what
follows up to the next. The frequent pre-tokens of a bounded sample, with their lengths, are
broadcast as one compact block of bytes, from which each worker builds its hash table; misses are
encoded by the library and remembered in a bounded cache of the worker. Only counts of the sample
are shuffled, never the corpus's pre-tokens. Tiers change the speed and not the result.

A vocabulary that breaks the rule, or changes characters before encoding, is refused.
A null text counts as empty and has no tokens. Long pre-tokens go to the library and are not kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, ship, ship_file, slices, whole_text, worker_state

#: Documents in the sample behind the first tier, at most about so many.
SAMPLE_DOCUMENTS = 5_000
#: Pre-tokens in the first tier, and the characters that one may have.
FREQUENT, FREQUENT_CHARS = 50_000, 48
# Fixed value: the piece character that stands for a space.
SPACE = "▁"


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens without their first space, which the library's own dummy space stands for."""
    if SPACE in text:
        text = text.replace(SPACE, " ")
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return re.findall(" ( *[^ ]*)", " " + text)


class Lengths:
    """Token counts of pre-tokens: broadcast table first, then cache, then library."""

    def __init__(self, model: bytes, words: bytes = b"", lengths: bytes = b""):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        bad = [i for i in range(self.model.get_piece_size()) if re.search(f"[^{SPACE}]{SPACE}", self.model.id_to_piece(i))]
        probe = " ﬁ　x  y\t"
        if bad or self.model.decode(self.model.encode(probe)) not in (probe, probe[1:]) or len(self.model.encode("")):
            raise ValueError("this vocabulary merges across spaces or normalises text")
        table = dict(zip(words.decode().split("\0"), lengths)) if words else {}
        self.known = Remembered(self.encode, fixed=table)

    def encode(self, words: list[str]) -> list[int]:
        # The library leaves out its dummy space for an empty text, which here still is one space.
        return [len(ids) or 1 for ids in self.model.encode(words, num_threads=1)]

    def count(self, texts: list[str]) -> list[int]:
        out = []
        for part in slices(texts):
            words = [pre_tokens(t) for t in part]
            get = self.known.of(words).__getitem__
            out += [sum(map(get, w)) for w in words]
        return out


def frequent_pre_tokens(docs: DataFrame, text_col: str, sample_documents: int) -> list[str]:
    """The sample's most frequent pre-tokens; counted per task first."""
    total = docs.count()
    sample = docs.select(whole_text(text_col).alias("text"))
    if total > sample_documents:
        sample = sample.sample(sample_documents / total, 11)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(w for w in pre_tokens(text) if len(w) <= FREQUENT_CHARS and "\0" not in w)
        yield pd.DataFrame({"word": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})

    counts = sample.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").toPandas()
    return [w for w in top["word"] if w]


def token_counts(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row per input row."""
    spark = docs.sparkSession
    model = ship_file(spark, model_path)
    words = frequent_pre_tokens(docs, text_col, sample_documents)
    lengths = Lengths(model.value)
    counted = list(zip(words, lengths.encode(words)))
    counted = [(w, n) for w, n in counted if 0 < n < 256]
    block = "\0".join(w for w, _ in counted).encode()
    frequent = ship(spark, (block, bytes(n for _, n in counted)), len(block) + len(counted))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        state, key = worker_state(), ("lengths", hash(model.value), hash(frequent.value))
        if key not in state:
            state[key] = Lengths(model.value, *frequent.value)
        for texts in batches:
            yield pd.Series(state[key].count(list(texts)), dtype="int64")

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    counts = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), count("text").alias("n_tokens"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
