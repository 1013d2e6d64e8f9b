"""Files, streams and whole runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from vacancia import schema
from vacancia.operators import dedup, export
from vacancia.operators.upsert import KeyedTable
from vacancia.plans import runs
from vacancia.sources import listings, registers
from vacancia.streaming import capture


def test_listing_files(spark, tmp_path):
    (tmp_path / "a b.json").write_text(json.dumps({"jobs": [{"job_id": 1, "title": " T ", "salary_min": "12.5", "requirements": ["x"], "contact": {"a": 1}}, {"job_id": "", "title": "no id"}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"job_id": "2", "title": "U", "source": "", "salary_min": "lots", "benefits": "text"}, {"title": ""}]))
    (tmp_path / "c.json").write_text("{broken")
    good, rejects = listings.load_listings(spark, str(tmp_path))
    rows = {r.job_id: r for r in good.collect()}
    assert sorted(rows) == ["1", "2"]
    assert rows["1"].salary_min == 12.5 and rows["1"].requirements == ["x"] and rows["1"].title == "T"
    assert rows["2"].source == "extension" and rows["2"].salary_min is None and rows["2"].benefits == []
    assert rows["1"].ord < rows["2"].ord
    assert sorted(r.reject_reason for r in rejects.collect()) == ["missing_job_id", "missing_title", "unreadable"]


def test_bad_items_leave_the_others_of_their_file(spark, tmp_path):
    good = {"job_id": "1", "title": "T"}
    long = {"job_id": "2", "title": "L", "description": "x" * 5000 + " 020 7946 0018"}
    bodies = [{"jobs": [good, "junk", None]}, [5, long, [good]], {"foo": 1}, {"jobs": "x"}]
    for n, body in enumerate(bodies):
        (tmp_path / f"{n}.json").write_text(json.dumps(body))
    (tmp_path / "4.json").write_text(" ")
    (tmp_path / "5.json").write_text("")
    kept, rejects = listings.load_listings(spark, str(tmp_path))
    rows = {r.job_id: r for r in kept.collect()}
    assert sorted(rows) == ["1", "2"] and rows["2"].description == long["description"]
    assert rows["1"].ord == 0 and rows["2"].ord == (1 << schema.ITEM_BITS) + 1
    bad = rejects.collect()
    assert {r.reject_reason for r in bad} == {"unreadable"}
    assert sorted((r.file[-6:], r.pos) for r in bad) == [
        ("0.json", 1), ("0.json", 2), ("1.json", 0), ("1.json", 2), ("3.json", 0), ("4.json", 0)]
    texts = spark.createDataFrame([(n, json.dumps(b)) for n, b in enumerate(bodies)] + [(9, None)], "n int, body string")
    parsed = listings.parse_listing_text(texts).collect()
    assert sorted((r.n, r.pos, r.job_id) for r in parsed if r._corrupt_record is None) == [(0, 0, "1"), (1, 1, "2")]
    assert sum(r._corrupt_record is not None for r in parsed) == 5


def test_ordinals_of_many_files_and_repeated_ordinals(spark):
    far = spark.createDataFrame([(200_000 << schema.ITEM_BITS,)], "ord bigint")
    first = spark.createDataFrame([(0,)], "ord bigint")
    assert schema.union_sources(far, first).distinct().count() == 2
    with pytest.raises(Exception, match="over its range"):
        schema.union_sources(spark.createDataFrame([(1 << 50,)], "ord bigint")).collect()
    rows = [(7, "a", "1", "Nurse", "A", "text of a"), (7, "b", None, "Cook", "B", "text of b"), (7, "c", "3", "Cook", "C", None)]
    df = spark.createDataFrame(rows, "ord bigint, source string, job_id string, title string, company string, description string")
    out = {(r.source, r.description) for r in dedup.deduplicate(df, levels=2).collect()}
    assert out == {("a", "text of a"), ("b", "text of b"), ("c", None)}


def test_inbox_over_out_of_order_files(spark, tmp_path):
    src, schema = tmp_path / "in", "source string, job_id string, title string, ord bigint"
    rows = [[("s", "1", "new", 5), ("s", None, "x", 6)], [("s", "1", "old", 2), ("s", "2", "two", 3)]]
    for n, batch in enumerate(rows):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{src}/f{n}")
    from pyspark.sql.types import StructType
    st = spark.createDataFrame([], schema).schema
    assert isinstance(st, StructType)
    table = KeyedTable(spark, str(tmp_path / "table"), ["source", "job_id"], by_order=True)
    stream = capture.file_stream(spark, f"{src}/*", st, maxFilesPerTrigger=1)
    out = capture.run_to_table(stream, table, str(tmp_path / "check"))
    assert {(r.job_id, r.title) for r in out.collect()} == {("1", "new"), ("2", "two")}
    # Nothing new: draining again changes nothing.
    out = capture.run_to_table(capture.file_stream(spark, f"{src}/*", st, maxFilesPerTrigger=1), table, str(tmp_path / "check"))
    assert out.count() == 2


def test_bursts_stream_equals_batch(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    ms = [0, 300, 900, 5000, 5100, 60_000_000]
    rows = [("k", t0 + dt.timedelta(milliseconds=m), n) for n, m in enumerate(ms)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, ord int")
    batch = {(r.n, r.ord) for r in capture.bursts(df, ["key"]).collect()}
    assert batch == {(3, 2), (2, 4), (1, 5)}
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    bursts = capture.bursts(capture.file_stream(spark, str(tmp_path / "in"), df.schema), ["key"], lateness="1 second")
    q = (bursts.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.n, r.ord) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(3, 2), (2, 4)}  # the last burst is still open


def test_capture_merge(spark):
    rows = [("s", "1", 1, "T", "long text", ["a"]), ("s", "1", 2, "", "short", []), ("s", "1", 3, "U", "same long", None), ("s", "", 4, "x", "x", [])]
    df = spark.createDataFrame(rows, "source string, job_id string, ord bigint, title string, description string, requirements array<string>")
    for parts in (1, 4):
        r = capture.merge_captures(df.repartition(parts), ["source", "job_id"], F.col("ord")).collect()
        assert len(r) == 1 and (r[0].title, r[0].description, r[0].requirements) == ("U", "long text", ["a"])


def test_run_with_resume_since_cache_and_export(spark, tmp_path):
    jobs = [
        {"job_id": "1", "title": "Nurse", "company": "Acme", "source": "reed", "location": "Leeds LS1 3AB", "salary_text": "£12.50 per hour",
         "description": "Call 020 7946 0958 or hr@acme.co.uk", "posted_at": "2024-05-30"},
        {"job_id": "2", "title": "Nurse", "company": "Acme Ltd", "source": "indeed", "location": "Leeds LS1 3AB", "posted_at": "2024-05-01"},
        {"job_id": "3", "title": "Cook", "company": "Old Co", "source": "reed", "posted_at": "2020-01-01"},
        {"job_id": "4", "title": "Porter", "company": "Third", "source": "reed", "posted_at": "last week"},
    ]
    (tmp_path / "in.json").write_text(json.dumps({"jobs": jobs}))
    raw, _ = listings.load_listings(spark, str(tmp_path / "in.json"))
    as_of = F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    first = runs.run(raw, runs.RunOptions(since_days=30, as_of=as_of))
    got = {r.job_id: r for r in first.postings.collect()}
    assert sorted(got) == ["1", "4"]
    assert (got["1"].sources, got["1"].location_postcode, got["1"].salary_min) == (["reed", "indeed"], "LS1 3AB", 12.5)
    assert got["1"].field_sources["salary_min"] == ["derived"]
    people = {r.company: r for r in first.contacts.collect()}
    assert people["Acme"].phone_numbers == ["+44 20 7946 0958"] and people["Acme"].confidence_score == 70
    report = first.report()
    assert report["totals"].first().asDict() == {"total_jobs": 2, "total_with_contact": 1, "total_with_phone": 1, "total_with_email": 1}
    assert {r.field: r.coverage for r in report["coverage"].collect()}["phone"] == 0.5

    status = export.export_all(first.postings, first.contacts, str(tmp_path / "out"), ["json", "csv", "parquet", "xls"])
    assert status["json"] == status["csv"] == status["parquet"] == "ok" and status["xls"].startswith("failed")
    objects = spark.read.json(f"{tmp_path}/out/jobs_json")
    assert objects.where("contact.confidence_score = 70").count() == 1

    second = runs.run(raw, runs.RunOptions(), seen=first.postings)
    assert [r.job_id for r in second.postings.collect()] == ["3"]

    cached = first.contacts.withColumn("phone_numbers", F.array(F.lit("+44 1632 960000")))
    third = runs.run(raw, runs.RunOptions(as_of=as_of, enrichers=[]), cached=cached)
    acme = {r.company: r for r in third.contacts.collect()}
    assert sorted(acme) == ["Acme", "Old Co", "Third"]
    assert acme["Acme"].phone_numbers == ["+44 1632 960000", "+44 20 7946 0958"] and acme["Acme"].enrichment_sources[-1] == "cache"
    assert people["Acme"].enriched_at == "2024-06-01T00:00:00Z"
    assert acme["Acme"].changes["phone_numbers"].new == ["+44 20 7946 0958"]


def test_resume_compares_whole_keys(spark):
    """A new posting stays though its hash is that of a stored one; equal contents go whatever their hash says."""
    fields = "title string, company string, location string, job_id string, hash string"
    stored = spark.createDataFrame([("Nurse", "Acme Ltd", "Leeds", "1", "aaaaaaaaaaaa"), (None, None, None, "9", "b")], fields)
    new = spark.createDataFrame(
        [("Cook", "Other", "York", "2", "aaaaaaaaaaaa"), ("NURSE", "Acme", "leeds", "3", "c"), (None, "", None, "9", "d"), (None, None, None, "8", "b")],
        fields,
    )
    for seen in (stored, registers.seen_keys(stored)):
        assert sorted(r.job_id for r in registers.resume(new, seen).collect()) == ["2", "8"]


@pytest.mark.parametrize("name", ["dedup_l2", "jsonld_extract", "merge_contacts", "registry_lev_join", "stream_inbox", "field_coverage"])
def test_checked_queries(spark, name):
    from __spark_entry__ import oracle_sql, queries
    from checks.compare import compare, connect

    sf = "/root/testdata/sf0.001"
    problem, n = compare(queries()[name](spark, sf), connect(sf), oracle_sql()[name])
    assert not problem and n > 0
