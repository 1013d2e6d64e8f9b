"""Operators that keep state per key across micro-batches: repeats, caches with a time to live, field merges.

State lives in Spark's state store and is read by key, so a micro-batch costs its own keys and not the
history. The store is checkpointed with the stream: after a failure a batch is replayed on the state
it started from, and a keyed table overwrites that batch, so nothing is counted or stored twice.

Rows of one key in one micro-batch are put in their order before they are applied. Between micro-batches
arrival decides. A micro-batch is bounded by the stream's own settings (``maxFilesPerTrigger`` and the like).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.upsert import KeyedTable

# The processors travel with their streams, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STREAM, _AT, _BUCKET = "__stream", "__at", "__bucket"
# Groups that streams are dealt to; a stream's checkpoint holds for one number only.
BUCKETS = 4096
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside use the store that arbitrary state needs; the setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _STORE)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def drain(stream: DataFrame, table: KeyedTable, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
    """Run a stateful stream over all that is there; each micro-batch is stored under its number."""
    with keyed_state(stream.sparkSession):
        query = (
            stream.writeStream.outputMode("update")
            .foreachBatch(lambda rows, batch: table.write_batch(prepare(rows), batch))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


def _rows(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(batches), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)


class _Repeats(StatefulProcessor):
    """Last change key of every stream of a bucket; null change keys are never equal to the one before."""

    def __init__(self, names: list[str], change_key: str):
        self.names, self.change_key = names, change_key

    def init(self, handle) -> None:
        self.last = handle.getMapState(
            "last", T.StructType([T.StructField("stream", T.StringType())]), T.StructType([T.StructField("change", T.StringType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Calculated columns arrive without their names.
        df = _rows((b.set_axis([*self.names, _STREAM, _AT, _BUCKET], axis=1) for b in rows), [_STREAM, _AT])
        stream, change = df[_STREAM], df[self.change_key]
        first = (stream != stream.shift(1)).to_numpy()
        before = change.astype(object).shift(1)
        starts = first.nonzero()[0].tolist()
        for start, end in zip(starts, [*starts[1:], len(df)]):
            name, new = (stream.iat[start],), change.iat[end - 1]
            held, new = self.last.getValue(name), None if pd.isna(new) else new
            before.iat[start] = None if held is None else held[0]
            if held is None or held[0] != new:
                self.last.updateValue(name, (new,))
        yield df.loc[~(before.notna() & (before == change)), self.names]

    def close(self) -> None:
        pass


def stream_repeats(batches: DataFrame, stream_key: str, order: str, change_key: str, buckets: int = BUCKETS) -> DataFrame:
    """``drop_repeats`` on a stream: rows whose change key equals that of the row before, also of an earlier micro-batch, go.

    The change key is a string column. A row that arrives in a later micro-batch comes after all earlier ones,
    whatever its order column says. Streams share a call by ``buckets``, each with an entry of its own in the state.
    """
    fields = batches.schema.fields
    whole = [f.name for f in fields if isinstance(f.dataType, T.IntegralType)]
    # Whole numbers travel as text: beside a null they would become floating-point numbers.
    text = batches.select(
        *[F.col(f.name).cast("string") if f.name in whole else F.col(f.name) for f in fields],
        F.to_json(F.struct(stream_key)).alias(_STREAM),
        (F.coalesce(F.col(order).cast("long"), F.lit(2**63 - 1)) if order in whole else F.col(order)).alias(_AT),
        F.pmod(F.hash(stream_key), F.lit(buckets)).alias(_BUCKET),
    )
    names = [f.name for f in fields]
    schema = T.StructType([f for f in text.schema.fields if f.name in names])
    kept = text.groupBy(_BUCKET).transformWithStateInPandas(_Repeats(names, change_key), schema, "Update", "None")
    return kept.select(*[F.col(f.name).cast(f.dataType) for f in fields])


class _Cache(StatefulProcessor):
    """When a key's entry was stored; a timer clears it once the watermark is past its time to live."""

    def __init__(self, ts: str, order: str, ttl_ms: int):
        self.ts, self.order, self.ttl = ts, order, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", T.StructType([T.StructField("stored_us", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, [self.ts, self.order])
        stored = self.entry.get()[0] if self.entry.exists() else None
        out, first = [], stored
        for at in (df[self.ts].astype("datetime64[us]").astype("int64")).tolist():
            hit = stored is not None and at - stored <= self.ttl * 1000
            if not hit:
                stored = at
            out.append((hit, stored))
        if stored != first:
            self.entry.update((stored,))
            self.handle.registerTimer(self._expiry(stored))
        hits, times = zip(*out)
        yield df.assign(outcome=["hit" if h else "lookup" for h in hits], stored_at=pd.to_datetime(list(times), unit="us"))

    def _expiry(self, stored_us: int) -> int:
        return -(-stored_us // 1000) + self.ttl + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A timer of an entry that was refreshed meanwhile finds a younger one.
        if self.entry.exists() and self._expiry(self.entry.get()[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.entry.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_cache(requests: DataFrame, key: str, ts: str, order: str, ttl_days: float, lateness: str = "0 seconds") -> DataFrame:
    """Requests for a cached record with ``outcome`` and ``stored_at``.

    A request within ``ttl_days`` of its key's stored entry is a ``hit``; any other is a ``lookup``, which stores
    a fresh entry at its own time. Entries are cleared by timers on the watermark, so the state holds live
    entries only. A request that is older than the entry is served by it; one older than the watermark is dropped.
    """
    schema = T.StructType([*requests.schema.fields, T.StructField("outcome", T.StringType()), T.StructField("stored_at", T.TimestampType())])
    cache = _Cache(ts, order, int(ttl_days * 86_400_000))
    return requests.withWatermark(ts, lateness).groupBy(key).transformWithStateInPandas(cache, schema, "Update", "EventTime")


def stream_merge(captures: DataFrame, keys: list[str], order: str, longest: str = "description") -> DataFrame:
    """``merge_captures`` on a stream: the merged row of every key that a micro-batch touches.

    Each field keeps its ordered extremum in the state of a streaming aggregation, combined map-side, so merging costs the new rows; sending rows again, in
    any order and micro-batch, changes nothing. Rows without a key are dropped. ``order`` is a whole number; it
    is one of the merged fields too.
    """
    def present(f: T.StructField) -> Column:
        there = F.col(f.name).isNotNull()
        if isinstance(f.dataType, (T.ArrayType, T.MapType)):
            return there & (F.size(f.name) > 0)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return there & (F.length(f.name) > 0)
        return there & ~F.isnan(f.name) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else there

    def by(f: T.StructField) -> Column:
        # Text: the longest, first of equals. Other fields: the last.
        if f.name != longest:
            return F.col(order)
        size = F.size(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType)) else F.length(f.name)
        return F.struct(size.alias("n"), (-F.col(order)).alias("o"))

    usable = captures
    for k in keys:
        usable = usable.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    fields = [f for f in captures.schema.fields if f.name not in keys]
    return usable.groupBy(*keys).agg(*[F.max_by(f.name, F.when(present(f), by(f))).alias(f.name) for f in fields])
