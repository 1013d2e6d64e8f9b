"""Slim shuffles, keys of few titles, sizes that joins are planned by."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancia.functions import similarity
from vacancia.functions.similarity import edit_similarity
from vacancia.operators import dedup, fuzzy
from vacancia.session import landed


def _greedy(spark, rows):
    """Title to leader by the plain rule, with Spark's own edit similarity."""
    a, b = (spark.createDataFrame(rows, f"company_key string, {x} string, t{x} long") for x in "ab")
    near = {(r.ta, r.tb) for r in a.join(b, "company_key").where("ta < tb").where(edit_similarity(F.col("a"), F.col("b")) >= 0.85).collect()}
    leaders, out = {}, {}
    for company, _, tid in sorted(rows, key=lambda r: r[2]):
        first = next((x for x in leaders.setdefault(company, []) if (x, tid) in near), None)
        if first is None:
            leaders[company].append(tid)
        else:
            out[tid] = first
    return out


def test_leaders_of_small_and_large_companies(spark):
    words = ["senior nurse", "junior nurses", "ward manager", "theatre lead", "night porter"]
    rows = [(c, f"{words[i % 5]} {'abcdefghij'[i % 10]}{i // 3} team{'s' * (i % 2)}", 1000 * k + i)
            for k, (c, n) in enumerate([("few", 30), ("many", fuzzy.SMALL_COMPANY + 40), ("one", 1)]) for i in range(n)]
    titles = spark.createDataFrame(rows, "company_key string, title string, tid long")
    keyed = fuzzy._keyed(titles, 0.85, "edit")
    assert keyed.where("company_key = 'few'").count() == 30
    assert keyed.where("company_key = 'one'").count() == 0
    got = {r.tid: r.leader for r in fuzzy.title_leaders(titles, kind="edit").collect()}
    assert got == _greedy(spark, rows) and got


def test_no_derived_column_crosses_the_shuffles(spark):
    df = spark.createDataFrame([(1, "a", "s", "Nurse", "Co", "text")], "ord long, job_id string, source string, title string, company string, description string")
    assert not set(dedup._DERIVED) & set(dedup._slim(dedup._start(df)).columns)
    row = dedup.deduplicate(df, levels=2).head()
    assert row["sources"] == ["s"] and row["field_sources"] == {k: ["s"] for k in ("title", "company", "description")}
    assert row["hash"] == dedup.with_hash(df.withColumn("location", F.lit(None).cast("string"))).head()["hash"]


def test_landed_rows_are_planned_by_their_size(spark, capsys):
    names = landed(spark.range(200_000).select(F.col("id"), F.lit("the same long company name").alias("name")).coalesce(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5m")
    try:
        names.join(names.withColumnRenamed("name", "other"), "id").explain()
        assert "Broadcast" not in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _varied(n):
    words = ["senior", "nurse", "ward", "theatre", "porter", "night", "lead", "manager", "band", "rgn"]
    rng = random.Random(n)
    seen = dict.fromkeys(" ".join(rng.choices(words, k=rng.randint(1, 4)))[rng.randrange(3):] + rng.choice(["", "s", " x", " é", " y" * 30]) for _ in range(3 * n))
    return list(seen)[:n]


@pytest.mark.parametrize("kind", ["edit", "sequence"])
@pytest.mark.parametrize("at_once", [0, 1_000_000])
def test_a_large_company_is_settled_from_blocks_without_rounds(spark, monkeypatch, kind, at_once):
    """Blocks of one length and of many, pairs settled in one task and by joins."""
    def rounds(*_):
        raise AssertionError("no masses of alike titles here")

    monkeypatch.setattr(fuzzy, "_in_rounds", rounds)
    monkeypatch.setattr(fuzzy, "BLOCK", 100)
    monkeypatch.setattr(fuzzy, "AT_ONCE", at_once)
    rows = [(c, title, 7 * i + k) for k, (c, n) in enumerate([("few", 20), ("", 90), ("large", 300), ("one", 1)]) for i, title in enumerate(_varied(n))]
    titles = spark.createDataFrame([*rows, ("few", "without a number", None)], "company_key string, title string, tid long").repartition(3)
    found = fuzzy.title_leaders(titles, kind=kind)
    assert {r.tid: r.leader for r in found.collect()} == (_greedy(spark, rows) if kind == "edit" else _first(rows))
    assert found.count() > 40


def _first(rows):
    leaders, out = {}, {}
    for company, title, tid in sorted(rows, key=lambda r: r[2]):
        heads = leaders.setdefault(company, [])
        first = next((t for t, x in heads if SequenceMatcher(None, x, title).ratio() >= 0.85), None)
        if first is None:
            heads.append((tid, title))
        else:
            out[tid] = first
    return out


def test_a_crowded_company_goes_to_rounds_and_the_others_do_not(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "CROWDED", 5)
    asked = []
    monkeypatch.setattr(fuzzy, "_in_rounds", lambda t, *a, _old=fuzzy._in_rounds: (asked.extend(r[0] for r in t.select("company_key").distinct().collect()), _old(t, *a))[1])
    rows = [("alike", f"registered general nurse {i:04d}", 2 * i) for i in range(80)] + [("unlike", title, 2 * i + 1) for i, title in enumerate(_varied(80))]
    found = fuzzy.title_leaders(spark.createDataFrame(rows, "company_key string, title string, tid long"))
    assert {r.tid: r.leader for r in found.collect()} == _first(rows) and asked == ["alike"]


def test_measures_on_arrays_equal_the_plain_ones():
    def plain(a, b, same, step):
        row = list(range(len(b) + 1)) if step else [0] * (len(b) + 1)
        for n, x in enumerate(a, 1):
            last, row[0] = row[0], n if step else 0
            for m, y in enumerate(b, 1):
                last, row[m] = row[m], same(last, row[m], row[m - 1], x == y)
        return row[-1]

    rng = random.Random(4)
    texts = [t for t in {"".join(rng.choices("abcé \x00\U0001f600", k=rng.choice([1, 2, 9, 33, 63, 64]))): 0 for _ in range(40)}]
    block = similarity._Block(np.arange(len(texts)), np.array(texts, dtype=object), np.zeros(len(texts), dtype=np.int64))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    pairs = [(block.text[x], block.text[y]) for x, y in zip(i, j)]
    edits = [plain(a, b, lambda d, u, s, eq: min(d + (not eq), u + 1, s + 1), True) for a, b in pairs]
    assert similarity._in_order(block, block, "edit")(i, j).tolist() == edits == [similarity._edits(a, b) for a, b in pairs]
    common = [plain(a, b, lambda d, u, s, eq: d + 1 if eq else max(u, s), False) for a, b in pairs]
    assert similarity._in_order(block, block, "sequence")(i, j).tolist() == common
