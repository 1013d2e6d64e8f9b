"""Whole runs over landed tables: replies applied, lookups asked in order, cache reused, sources plugged in, counts."""

import json
import time

from pyspark.sql import functions as F

from checks import catalog_entities
from checks.fixtures import TABLES, Inputs
from vacancia.operators import contacts, dedup
from vacancia.operators.counts import StageCounts
from vacancia.operators.replies import apply_replies
from vacancia.operators.upsert import KeyedTable
from vacancia.plans import runs
from vacancia.plans.lookups import Landed
from vacancia.schema import POSTINGS, conform
from vacancia.session import cut_lineage
from vacancia.sources import plugin, registers
from vacancia.sources.listings import normalise

SHORT = "ord long, source string, job_id string, title string, company string, description string, requirements array<string>, benefits array<string>"


def postings(spark, rows):
    p = conform(spark.createDataFrame(rows, SHORT), POSTINGS)
    return p.withColumn("field_sources", dedup.origin_map())


def test_replies_fill_only_what_lacks_and_is_printed(spark):
    p = postings(spark, [
        (1, "s", "1", "A", None, "Ring +44 7700 900123 or mail Hr@x.org", [], ["own"]), (2, "s", "2", "B", "Co", "no numbers", ["r"], None),
        (3, "s", "3", "C", "Co", "mail a@co.org", [], []), (4, "s", "4", "D", None, None, [], []),
    ])
    many = [f"b{i}" for i in range(12)]
    bodies = {
        1: {"requirements": ["x", "", "y"], "benefits": many, "company_name": " New ", "phone": "07700 900123", "email": "HR@X.org"},
        2: {"requirements": ["other"], "benefits": many, "company_name": "Else", "phone": "020 7946 0000", "email": "z@z.org"},
        4: {"company_name": "null", "phone": "07700 900123"},
    }
    rows = [(k, "gemini" if k == 1 else None, "Sure: " + json.dumps(v) + " ok") for k, v in bodies.items()] + [(3, "p", "{broken")]
    done, seeds = apply_replies(p, contacts.seed_contacts(p), spark.createDataFrame(rows, "ord long, provider string, raw_response string"))
    got = {r["ord"]: r for r in done.collect()}
    assert (got[1]["company"], got[1]["requirements"], got[1]["benefits"]) == ("New", ["x", "y"], ["own"])
    assert got[1]["field_sources"]["company"] == got[1]["field_sources"]["requirements"] == ["gemini_description"]
    assert got[1]["field_sources"]["benefits"] == ["s"]
    assert (got[2]["company"], got[2]["requirements"], got[2]["benefits"]) == ("Co", ["r"], many[:8])
    assert got[2]["field_sources"]["benefits"] == ["ai_description"]
    assert got[4]["company"] is None and got[3]["requirements"] == []
    found = {r["company"]: (r["phone_numbers"], r["emails"]) for r in seeds.collect()}
    assert found == {"New": (["+44 7700 900123"], ["hr@x.org"]), "Co": ([], ["a@co.org"])}


def test_no_replies_change_nothing(spark):
    p = postings(spark, [(1, "s", "1", "A", "Co", "mail a@co.org", [], [])])
    done, seeds = apply_replies(p, contacts.seed_contacts(p), spark.createDataFrame([], "ord long, provider string, raw_response string"))
    assert [r.asDict() for r in done.collect()] == [r.asDict() for r in p.collect()] and seeds.count() == 1


def lookups(spark, kind="sequence"):
    register = [(1, "Alpha Care Ltd", "N1", "ltd", "active"), (2, "Beta Homes", "N2", "plc", "dissolved")]
    reg = spark.createDataFrame(register, "cand_ord long, title string, company_number string, company_type string, company_status string")
    fields = ("premises", "address_line_1", "address_line_2", "locality", "region", "postal_code", "country")
    reg = reg.withColumn("registered_office_address", F.struct(*[F.lit("1 High St" if f == "premises" else None).cast("string").alias(f) for f in fields]))
    officers = spark.createDataFrame([("N1", 1, "Ann", "director", None)], "company_number string, officer_ord long, name string, officer_role string, resigned_on string")
    charities = spark.createDataFrame([(1, "Gamma Trust", "020 7946 0001", "g@gamma.org")], "cand_ord long, charity_name string, phone string, email string")
    for c in ("address1", "address2", "address3", "postcode"):
        charities = charities.withColumn(f"charity_contact_{c}", F.lit(None).cast("string"))
    pages = spark.createDataFrame([("https://alpha.org/contact", "<p>Call 020 7946 0123</p>")], "url string, html string")
    text = spark.createDataFrame([("Delta Fund", "<p>" + " ".join(f"020 7946 010{i} or<br>" for i in range(5)) + "</p>")], "company string, html string")
    care = spark.createDataFrame([(1, "Epsilon Care", "p1", "01632 960001")], "cand_ord long, name string, providerId string, telephone string")
    for c in ("postalAddressLine1", "postalAddressLine2", "postalAddressTownCity", "postalCode", "website", "type"):
        care = care.withColumn(c, F.lit(None).cast("string"))
    searches = spark.createDataFrame([("Zeta", 1, "https://z.example/x", "Tel 020 7946 0999")], "company string, rank int, link string, snippet string")
    return Landed(pages=pages, register=reg, officers=officers, charities=charities, charity_pages=text, care=care, searches=searches, kind=kind)


def run_rows(spark):
    companies = ["Alpha Care", "Beta Homes", "Gamma Trust", "Delta Fund", "Epsilon Care", "Zeta", "Nobody"]
    p = postings(spark, [(i, "s", str(i), f"T{i}", c, "text only", [], []) for i, c in enumerate(companies)])
    return p.withColumn("company_url", F.when(F.col("company") == "Alpha Care", "https://alpha.org"))


def test_lookups_are_asked_in_order_and_reused(spark):
    asked = []
    landed = lookups(spark)

    def noted(priority, lookup):
        def ask(companies):
            asked.append((priority, sorted(r["company"] for r in companies.select("company").collect())))
            return lookup(companies)
        return priority, ask

    at = F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    options = runs.RunOptions(enrichers=[noted(*e) for e in landed.enrichers()], as_of=at)
    out = cut_lineage(runs.enrich(run_rows(spark), options))
    got = {r["company"]: r for r in out.collect()}
    assert got["Alpha Care"]["phone_numbers"] == ["+44 20 7946 0123"] and got["Alpha Care"]["company_number"] == "N1"
    assert got["Alpha Care"]["enrichment_sources"] == ["website", "companies_house"] and got["Alpha Care"]["contact_person"] == "Ann"
    assert got["Beta Homes"]["company_number"] is None
    assert (got["Gamma Trust"]["phone_numbers"], got["Gamma Trust"]["emails"]) == (["+44 20 7946 0001"], ["g@gamma.org"])
    assert len(got["Delta Fund"]["phone_numbers"]) == 3 and got["Delta Fund"]["company_type"] == "charity"
    assert got["Epsilon Care"]["phone_numbers"] == ["+44 1632 960001"] and got["Zeta"]["enrichment_sources"] == ["duckduckgo"]
    assert got["Nobody"]["enrichment_sources"] == []
    # A company with phone and e-mail is not asked for again.
    assert [p for p, _ in asked] == [1, 2, 3, 4, 5] and "Gamma Trust" in asked[2][1] and "Gamma Trust" not in asked[3][1]
    asked.clear()
    again = runs.enrich(run_rows(spark), options, out)
    kept = {r["company"]: r["phone_numbers"] for r in again.collect()}
    assert kept == {c: r["phone_numbers"] for c, r in got.items()}
    assert asked[0][1] == ["Beta Homes", "Nobody"]


def test_counts_in_passing_feed_the_audit_row(spark, tmp_path):
    rows = [(1, "s", "1", "A", "Co", "x", [], []), (2, "s", "1", "A2", "Co", "x", [], []), (3, "t", "9", "a", "CO", "y", [], []), (4, "t", "8", "B", "Co", "x", [], [])]
    counts = StageCounts()
    cut_lineage(dedup.deduplicate(postings(spark, rows), counts=counts))
    assert [(s, counts.n(s)) for s in counts.stages()] == [("raw", 4), ("level1", 3), ("level2", 2), ("level3", 2)]
    jobs = KeyedTable(spark, str(tmp_path / "jobs"), ["hash"])
    first = runs.run(postings(spark, rows[:2]), runs.RunOptions(levels=2))
    jobs.write_batch(first.postings, 0)
    second = runs.run(postings(spark, rows), runs.RunOptions(levels=2))
    for _ in range(2):
        row = runs.run_audit("r2", "a", "b", second, jobs, 1, rejects=spark.range(3), calls=spark.range(5)).first()
        assert (row["jobs_scraped"], row["jobs_new"], row["jobs_duplicate"], row["ai_calls_made"], row["errors"]) == (2, 1, 2, 5, 3)
        jobs.write_batch(second.postings, 1)
    assert second.report()["dedup"].first()["removed"] == 2


def test_telephone_of_the_care_register(spark):
    row = {c: None for c in ("postalAddressLine1", "postalAddressLine2", "postalAddressTownCity", "postalCode", "website", "type")}
    schema = "company string, providerId string, telephone string, " + ", ".join(f"{c} string" for c in row)
    m = spark.createDataFrame([("A", "1", "01632 960001", *row.values()), ("B", "2", None, *row.values())], schema)
    details = spark.createDataFrame([("2", "01632 960002", [])], "providerId string, telephone string, contacts array<struct<personTitle:string,personGivenName:string,personFamilyName:string>>")
    got = {r["company"]: r["phone_numbers"] for r in registers.care_parts(m, details).collect()}
    assert got == {"A": ["+44 1632 960001"], "B": ["+44 1632 960002"]}


class Board(plugin.ListingSource):
    @classmethod
    def name(cls):
        return "board"

    def searches(self):
        return [(k, l) for k in ("nurse", "carer") for l in self.options["places"].split(",")]

    def postings(self, keyword, location):
        yield {"job_id": f"{keyword}-{location}", "title": keyword.title(), "salary_min": 21, "requirements": ["pin"], "unknown": 1}
        yield {"job_id": None, "title": None}


def test_source_plug_in_reads_each_search_as_a_partition(spark, tmp_path):
    from pyspark import cloudpickle as own

    own.register_pickle_by_value(__import__(__name__, fromlist=["x"]))
    spark.dataSource.register(Board)
    raw = spark.read.format("board").option("places", "Leeds,York").load()
    assert raw.rdd.getNumPartitions() == 4 and raw.count() == 8
    good = normalise(raw.withColumn("ord", F.col("pos"))).where("job_id <> ''").collect()
    assert sorted(r["job_id"] for r in good) == ["carer-Leeds", "carer-York", "nurse-Leeds", "nurse-York"]
    assert {(r["salary_min"], tuple(r["requirements"])) for r in good} == {(21.0, ("pin",))}


def test_landed_searches_are_read_as_a_growing_stream(spark, tmp_path):
    spark.dataSource.register(plugin.LandedSearches)
    land, table = tmp_path / "in", KeyedTable(spark, str(tmp_path / "t"), ["job_id"], order="pos")
    for n, place in enumerate(("Leeds", "New York")):
        folder = land / f"search=nurse@{place}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(f'{{"job_id": "{n}", "title": "T", "requirements": ["é"]}}\n\nnot json\n[1]\n')
        stream = spark.readStream.format("landed_searches").option("path", str(land)).load()
        query = stream.writeStream.foreachBatch(lambda d, b: table.write_batch(d, b)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
    rows = table.batches().select("batch", "job_id", "search_location", "requirements").collect()
    assert sorted((r["batch"], r["job_id"], r["search_location"]) for r in rows) == [(0, "0", "Leeds"), (1, "1", "New York")]
    assert json.loads(rows[0]["requirements"]) == ["é"]


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(n).getName() for n in range(found.size())) if name.startswith("shuffle_")}


def test_a_run_leaves_no_shuffle_files(spark):
    rows = [(n, f"j{n}", f"s{n % 3}", f"Nurse {n % 40}", f"Co {n % 7}", f"Call 020 7946 {n:04d}, mail hr@c{n}.org") for n in range(300)]
    raw = spark.createDataFrame(rows, "ord long, job_id string, source string, title string, company string, description string")
    before = _shuffle_files(spark)
    result = runs.run(raw, runs.RunOptions(levels=2))
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    # Stored once: reading the contacts again mines no text again.
    assert "Exchange" not in result.contacts._jdf.queryExecution().executedPlan().toString() and result.contacts.inputFiles()
    assert result.contacts.count() == 7 and result.counts.n("raw") == 300


def test_history_stores_no_postings_to_count_its_rejects(spark, tmp_path, monkeypatch):
    stored = []
    monkeypatch.setattr(Inputs, "_land", lambda self, names, _old=Inputs._land: (stored.extend(names), _old(self, names))[1])
    for table in TABLES:
        spark.range(0).write.parquet(f"{tmp_path}/{table}.parquet")
    for table, rows, schema in (
        ("documents", [(0, "a b c d e"), (1, "f g h i j")], "doc_id long, text string"), ("nation", [(0, "N")], "n_nationkey int, n_name string"),
        ("customer", [(1, 0)], "c_custkey long, c_nationkey int"), ("conversations", [("assistant",), ("user",)], "role string"),
        ("orders", [(n, 1, 10.5, "2024-01-01") for n in range(100)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string"),
    ):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{table}.parquet")
    found = {r["run_id"]: r for r in catalog_entities.run_history(Inputs(spark, str(tmp_path))).collect()}
    assert set(stored) == {"f_dup"} and found["r2"]["errors"] == 2 and found["r1"]["errors"] == 0
    assert found["r2"]["ai_calls_made"] == 1 and found["r2"]["jobs_scraped"] == found["r2"]["stored"]
