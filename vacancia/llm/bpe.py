"""Byte-level BPE through a sentencepiece model that is written out directly from a rank file.

Every byte becomes one character (its value plus 0x100) and every vocabulary entry a piece whose
score is its negative rank, with identity normalisation and no space handling. Merging the pair with
the best score is then merging the pair with the least rank. Pre-tokens are encoded one by one;
decoding looks every id up in the inverse mapping.

A null text counts as empty; the empty text has no ids and decodes to no bytes. Whole texts of any
length are encoded; the ids of short pre-tokens are remembered in a bounded worker cache.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from .common import Remembered, ship_file, slices, whole_text, worker_state


#: Pre-tokens whose ids a worker remembers.
CACHED = 500_000
_SHIFT = {b: chr(256 + b) for b in range(256)}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def as_text(token: bytes) -> str:
    """Bytes as characters 0x100 .. 0x1FF."""
    return token.decode("latin-1").translate(_SHIFT)


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model: piece 0 is unknown, piece i + 1 the i-th token by rank."""
    parts = [_field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _field(3, 2))]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        score = _varint(2 << 3 | 5) + struct.pack("<f", -float(rank))
        parts.append(_field(1, _field(1, as_text(token).encode()) + score))
    trainer = _field(3, 2) + _field(4, len(ranks) + 1) + _field(40, 0) + b"".join(
        # No begin, end or padding piece.
        _varint(n << 3) + _varint((1 << 64) - 1) for n in (41, 42, 43)
    )
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(parts) + _field(2, trainer) + _field(3, normaliser)


def ascii_pattern(pattern: str) -> str | None:
    """The same pattern for ASCII texts and the standard library's faster engine, if it can be had."""
    sets = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r"\t-\r ", r"\S": None}
    out, inside, i = "", False, 0
    while i < len(pattern):
        name = next((n for n in sets if pattern.startswith(n, i)), None)
        if name == r"\S":
            if inside:
                return None
            out += r"[^\t-\r ]"
        elif name:
            out += sets[name] if inside else f"[{sets[name]}]"
        elif pattern[i] == "\\":
            return None
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out += pattern[i]
        i += len(name or " ")
    return out


class Decoder:
    """Inverse mapping of a rank file: ids to bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.start = np.zeros(len(self.size), np.int64)
        at = [ranks[t] for t in tokens]
        self.size[at] = [len(t) for t in tokens]
        self.start[at] = np.cumsum([0] + [len(t) for t in tokens])[:-1]
        self.block = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for i in range(0, len(ids), 1 << 18):
            some = ids[i : i + (1 << 18)]
            size = self.size[some]
            ends = np.cumsum(size)
            out.append(self.block[np.arange(ends[-1]) + np.repeat(self.start[some] - ends + size, size)].tobytes())
        return b"".join(out)


class Encoder:
    """Encoder of one rank file and splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.ranks = ranks
        # Ids need not be gapless: piece i + 1 stands for the i-th rank.
        self.ids = np.array([0, *sorted(ranks.values())], np.int32)
        self.split_any = regex.compile(pattern).findall
        simple = ascii_pattern(pattern)
        self.split_ascii = re.compile(simple).findall if simple else self.split_any
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        self.known = Remembered(self.pieces, limit=CACHED)

    def pieces(self, words: list[str]) -> list[bytes]:
        """The ids of pre-tokens, as 32-bit numbers; a token of the vocabulary is itself."""
        raw = [w.encode() for w in words]
        found = self.model.encode([as_text(r) for r in raw], num_threads=1)
        out = [self.ids[f].tobytes() for f in found]
        return [out[i] if len(found[i]) == 1 or r not in self.ranks else np.int32(self.ranks[r]).tobytes() for i, r in enumerate(raw)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for part in slices(texts):
            words = [self.split_ascii(t) if t.isascii() else self.split_any(t) for t in part]
            get = self.known.of(words).__getitem__
            out += [np.frombuffer(b"".join(map(get, w)), np.int32) for w in words]
        return out


def _cached(data, pattern: str | None):
    """Decoder, or encoder if there is a pattern, of the worker."""
    state, key = worker_state(), ("bpe", hash(data.value), pattern)
    if key not in state:
        ranks = read_ranks(data.value)
        state[key] = Decoder(ranks) if pattern is None else Encoder(ranks, pattern)
    return state[key]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, ids, decoded`` of every row, and the columns to keep; batches leave in small slices.

    Columns to keep may not have the names of these three or ``text``.
    """
    if clash := {"doc_id", "text", "ids", "decoded"} & {k.lower() for k in keep}:
        raise ValueError(f"columns of the result: {sorted(clash)}")
    data = ship_file(docs.sparkSession, path)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, decoder = _cached(data, pattern), _cached(data, None)
        for batch in batches:
            at = 0
            for part in slices(batch["text"]):
                ids = encoder.encode(part)
                rows = batch.iloc[at : at + len(part)].drop(columns="text")
                at += len(part)
                yield rows.assign(
                    ids=pd.Series(ids, rows.index, dtype=object),
                    decoded=pd.Series([decoder.decode(x) for x in ids], rows.index, dtype=object),
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, whole_text(text_col).alias("text"))
    schema = rows.drop("text").schema.add("ids", ArrayType(IntegerType())).add("decoded", BinaryType())
    return rows.mapInPandas(code, schema)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes that their ids stand for; null ids are none."""
    data = ship_file(rows.sparkSession, path)

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = _cached(data, None)
        for ids in batches:
            yield pd.Series([decoder.decode(np.asarray(x, np.int32)) for x in ids], dtype=object)

    return rows.withColumn("decoded", decode(F.coalesce(ids_col, F.array().cast("array<int>"))))


def id_text(ids: str) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(F.col(ids).cast("array<string>"), " ")
