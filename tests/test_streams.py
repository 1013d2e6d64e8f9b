"""Stateful streams against their batch forms, over several files, out of order, and sent again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from checks import catalog_entities
from vacancia.operators.upsert import KeyedTable
from vacancia.streaming import capture, inbox, state

CAPTURES = "source string, job_id string, ord long, title string, description string, tags array<string>"


def landed(df, path, files):
    """Each list of rows as one file, in that order."""
    for rows in files:
        df.sparkSession.createDataFrame(rows, df.schema).coalesce(1).write.mode("append").parquet(path)
    return capture.file_stream(df.sparkSession, path, df.schema, maxFilesPerTrigger=1)


def test_merge_costs_touched_keys_and_ignores_what_is_sent_again(spark, tmp_path):
    rng = random.Random(1)
    rows = [
        ("s", rng.choice(["a", "b", "c", "", None]), i, rng.choice(["", None, f"t{i}"]), rng.choice([None, "", "x" * rng.randrange(5)]), rng.choice([None, [], [f"r{i}"]]))
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, CAPTURES)
    shuffled = rng.sample(rows, 60)
    files = [shuffled[:20], shuffled[20:40], shuffled[40:], shuffled[:30]]
    table = KeyedTable(spark, str(tmp_path / "t"), ["source", "job_id"])
    stream = state.stream_merge(landed(df, str(tmp_path / "in"), files), ["source", "job_id"], "ord")
    state.drain(stream, table, str(tmp_path / "c"))
    want = capture.merge_captures(df, ["source", "job_id"], F.col("ord"))
    cols = ["source", "job_id", "title", "description", "tags"]
    assert sorted(map(str, table.current().select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    # A file with one key stores one row.
    spark.createDataFrame([("s", "a", 99, "new", None, None)], CAPTURES).write.mode("append").parquet(str(tmp_path / "in"))
    state.drain(stream, table, str(tmp_path / "c"))
    last = table.batches().agg(F.max("batch")).first()[0]
    assert [r["title"] for r in table.batches().where(F.col("batch") == last).collect()] == ["new"]


@pytest.mark.parametrize("cuts", [1, 4])
def test_repeats_across_files_equal_the_batch_form(spark, tmp_path, cuts):
    rng = random.Random(2)
    rows = [(i, f"u{rng.randrange(3)}", rng.choice(["x", "x", "y", None])) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, user string, kind string")
    files = [rng.sample(rows[k * 80 // cuts : (k + 1) * 80 // cuts], 80 // cuts) for k in range(cuts)]
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], order="id")
    state.drain(state.stream_repeats(landed(df, str(tmp_path / "in"), files), "user", "id", "kind"), table, str(tmp_path / "c"))
    want = capture.drop_repeats(df, "user", "id", "kind")
    assert sorted(r["id"] for r in table.current().collect()) == sorted(r["id"] for r in want.collect())


def test_a_late_file_follows_what_came_before_it(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x")], "id long, user string, kind string")
    files = [[(5, "u", "x")], [(3, "u", "x"), (4, "u", "y")], [(9, "u", "y")]]
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], order="id")
    state.drain(state.stream_repeats(landed(df, str(tmp_path / "in"), files), "user", "id", "kind"), table, str(tmp_path / "c"))
    assert sorted(r["id"] for r in table.current().collect()) == [4, 5]


def test_cache_hits_expire_and_are_refreshed(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    days = [("a", 0), ("a", 2), ("b", 1), ("a", 3), ("a", 3.5), ("b", 9), ("a", 6.4), ("a", 20), ("b", 12.5)]
    days = [(i, *d) for i, d in enumerate(sorted(days, key=lambda d: d[1]))]
    rows = [(i, k, day(d)) for i, k, d in days]
    df = spark.createDataFrame(rows, "id long, company string, ts timestamp")
    files = [rows[:4][::-1], rows[4:6], rows[6:]]
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], order="id")
    state.drain(state.stream_cache(landed(df, str(tmp_path / "in"), files), "company", "ts", "id", 3), table, str(tmp_path / "c"))
    want, stored = {}, {}
    for i, k, d in days:
        hit = k in stored and d - stored[k] <= 3
        if not hit:
            stored[k] = d
        want[i] = ("hit" if hit else "lookup", day(stored[k]))
    assert {r["id"]: (r["outcome"], r["stored_at"]) for r in table.current().collect()} == want


def test_state_setting_is_put_back(spark):
    before = spark.conf.get(state._PROVIDER, None)
    with state.keyed_state(spark):
        assert spark.conf.get(state._PROVIDER) == state._STORE
    assert spark.conf.get(state._PROVIDER, None) == before


def test_inbox_keeps_rejects_and_counts_calls(spark, tmp_path):
    box, land = inbox.Inbox(spark, str(tmp_path / "box")), tmp_path / "in"
    land.mkdir()
    (land / "1.json").write_text('{"jobs": [{"job_id": "1", "title": "A", "source": "s"}, {"job_id": "", "title": "B"}, 7]}')
    stream = inbox.message_stream(spark, str(land))
    box.drain(stream, str(tmp_path / "c"))
    (land / "2.json").write_text('[{"job_id": "1", "title": "A2", "source": "s"}, {"job_id": "2", "title": "C", "source": "s"}]')
    (land / "3.json").write_text("not json at all")
    box.drain(stream, str(tmp_path / "c"))
    calls = [tuple(r) for r in box.calls().orderBy("batch").select("received", "stored", "rejected", "total").collect()]
    assert calls == [(3, 1, 2, 1), (3, 2, 1, 2)]
    assert {r["job_id"]: r["title"] for r in box.jobs.current().collect()} == {"1": "A2", "2": "C"}
    assert sorted(r["reject_reason"] for r in box.rejects().collect()) == ["missing_job_id", "unreadable", "unreadable"]
    # The same call again changes nothing.
    messages = spark.read.text(str(land / "1.json"), wholetext=True).select(F.lit("1.json").alias("file"), F.col("value").alias("body"))
    box.store(messages, 0)
    assert box.calls().where("batch = 0").first()["total"] == 1 and box.jobs.current().count() == 2


def test_field_merge_is_an_aggregation_of_the_engine(spark, tmp_path):
    spark.createDataFrame([("a", 1, "x")], "k string, ord bigint, description string").write.parquet(f"{tmp_path}/in")
    rows = capture.file_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    plan = state.stream_merge(rows, ["k"], "ord")._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan


def test_streams_that_share_a_call_keep_their_own_last_row_and_whole_numbers(spark, tmp_path):
    big = 2**60
    rows = [(big + i, None if i % 5 == 0 else big + i % 7, "xyx"[i % 3] if i % 4 else None) for i in range(60)]
    df = spark.createDataFrame([*rows, (None, big + 1, "x")], "id long, user long, kind string")
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], order="id")
    stream = landed(df, str(tmp_path / "in"), [rows[:20][::-1], rows[20:], [(None, big + 1, "x")]])
    plan = state.stream_repeats(stream, "user", "id", "kind", buckets=2)
    assert plan.schema == df.schema and "__bucket" in plan._jdf.queryExecution().analyzed().toString()
    state.drain(plan, table, str(tmp_path / "c"))
    want = capture.drop_repeats(df.where("id IS NOT NULL"), "user", "id", "kind").collect()
    got = [tuple(r) for r in table.current().select("id", "user", "kind").collect() if r["id"] is not None]
    assert sorted(got, key=str) == sorted(map(tuple, want), key=str)


class Events:
    """Stands for the inputs of a query that reads the events only."""

    def __init__(self, df):
        self.spark, self.df = df.sparkSession, df

    def table(self, name):
        assert name == "events"
        return self.df


@pytest.mark.parametrize("ids", [[*range(30), None, None], [None, None]])
def test_the_last_file_is_sent_twice_and_rows_without_a_number_come_too(spark, tmp_path, monkeypatch, ids):
    rows = [(n, "new" if n is None else "old", (n or 0) % 4, float(n or 0), "x" * ((n or 0) % 3)) for n in ids]
    df = spark.createDataFrame(rows, "event_id long, event_type string, user_id long, value double, props string")
    monkeypatch.setattr(catalog_entities, "work_dir", lambda spark, name: str(tmp_path / name))
    out = catalog_entities.stream_capture_merge(Events(df)).collect()
    sent = [r[0] for r in spark.read.parquet(str(tmp_path / "events")).select("event_id").collect()]
    last = [n for n in ids if n is None or n >= 29 * 2 / 3]
    assert sorted(map(str, sent)) == sorted(map(str, [*ids, *last]))
    table = KeyedTable(spark, str(tmp_path / "captures" / "table"), ["event_type", "user_id"], order="event_id")
    stored = {r["batch"]: r["n"] for r in table.batches().groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert stored[2] == stored[3] == len({(n is None, (n or 0) % 4) for n in last})
    want = {("old", u): max(n for n in ids if n is not None and n % 4 == u) for u in range(4)} if len(ids) > 2 else {}
    assert {(r["event_type"], r["user_id"]): r["event_id"] for r in out} == {**want, ("new", 0): None}
