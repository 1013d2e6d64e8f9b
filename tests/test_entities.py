"""De-duplication, similarity joins and merging against plain definitions."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from vacancia.functions.similarity import signatures
from vacancia.operators import contacts, dedup, fuzzy, registry, upsert, waterfall
from vacancia.schema import CONTACT_PARTS, POSTINGS

WORDS = ["staff", "nurse", "senior", "ward", "care", "manager", "night", "lead", "rgn", "band", "five", "six"]


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


def greedy(titles, t=0.85):
    """Leader of every title by the loop definition: first leader in order that is similar enough."""
    leaders, out = [], {}
    for tid, title in titles:
        hit = next((lid for lid, lt in leaders if ratio(lt, title) >= t), None)
        if hit is None:
            leaders.append((tid, title))
        else:
            out[tid] = hit
    return out


def noisy(rng, n):
    seen = {}
    while len(seen) < n:
        base = " ".join(rng.choices(WORDS, k=rng.randint(1, 4)))
        cut = rng.randrange(len(base))
        title = rng.choice([base, base + " " + str(rng.randint(1, 9)), base[:cut] + rng.choice("xyz") + base[cut:], base[:cut] + base[cut + 1:]])
        seen.setdefault(title, len(seen))
    return list(seen)


@pytest.mark.parametrize("window", [1, 16])
def test_leaders_equal_the_greedy_loop(spark, window):
    rng = random.Random(7)
    rows, want = [], {}
    for company in ("a", "b", ""):
        titles = noisy(rng, 120 if company else 250)
        ids = [(1000 * len(rows) + n, title) for n, title in enumerate(titles)]
        rows += [(company, title, tid) for tid, title in ids]
        want |= greedy(ids)
    df = spark.createDataFrame(rows, "company_key string, title string, tid bigint").repartition(5)
    got = {r.tid: r.leader for r in fuzzy.title_leaders(df, window=window).collect()}
    assert want and got == want


def test_many_alike_titles_need_no_pairs(spark):
    """Numbered titles are all alike: one leader, everyone else absorbed by it."""
    df = spark.range(1000).select(
        F.lit("c").alias("company_key"), F.format_string("registered general nurse ward %05d", "id").alias("title"), F.col("id").alias("tid"))
    got = fuzzy.title_leaders(df)
    assert got.count() == 999 and got.where("leader <> 0").count() == 0


@pytest.mark.parametrize("t, kind", [(0.85, "sequence"), (0.70, "sequence"), (0.75, "edit")])
def test_signatures_lose_no_pair(spark, t, kind):
    rng = random.Random(3)
    names = noisy(rng, 150) + ["a", "ab", "b", "abc", "zz"]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    for k in (2, 3):
        keys = {r.v: set(r.k) for r in df.select("v", signatures(t, kind, k)(F.col("v")).alias("k")).collect()}
        pairs = 0
        for n, a in enumerate(names):
            for b in names[:n]:
                near = ratio(a, b) >= t if kind == "sequence" else 1 - _edits(a, b) / max(len(a), len(b)) >= t
                if near:
                    pairs += 1
                    assert keys[a] & keys[b], (a, b)
        assert pairs > 20


def _edits(a, b):
    row = list(range(len(b) + 1))
    for n, x in enumerate(a, 1):
        last, row[0] = row[0], n
        for m, y in enumerate(b, 1):
            last, row[m] = row[m], min(row[m] + 1, row[m - 1] + 1, last + (x != y))
    return row[-1]


def test_registry_join_equals_brute_force(spark):
    rng = random.Random(5)
    companies = noisy(rng, 80)
    names = [n.title() for n in noisy(rng, 160)] + companies[:20]
    left = spark.createDataFrame([(c,) for c in companies], "company string")
    right = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "name string, cand_ord bigint")
    want = {}
    for c in companies:
        best, score = None, 0.0
        for k, n in enumerate(names):
            if set(c.lower().split()) & set(n.lower().split()):
                s = ratio(c.lower(), n.lower())
                if s > score:
                    best, score = k, s
        if score >= 0.75:
            want[c] = (best, round(score, 9))
    got = {r.company: (r.cand_ord, round(r.score, 9)) for r in registry.best_matches(left, right, 0.75).collect()}
    assert len(want) > 30 and got == want


def posting(ord, **kw):
    base = {f.name: None for f in POSTINGS.fields} | {"requirements": [], "benefits": [], "source": "reed", "job_id": str(ord), "title": "Staff Nurse", "company": "Acme", "location": "Leeds"}
    return tuple((base | {"ord": ord} | kw)[f.name] for f in POSTINGS.fields)


def by_ord(df):
    return {r.ord: r for r in df.collect()}


def test_level2_fills_gaps_with_origin(spark):
    df = spark.createDataFrame(
        [
            posting(1, description="short", salary_text="", job_type="full-time"),
            posting(2, source="indeed", company="ACME Ltd", salary_text="£10", salary_min=0.0, salary_max=5.0, company_url="u", description=None, benefits=["x"]),
            posting(3, source="reed", job_id="1", title="repeat of id 1"),
            posting(4, title="Porter"),
        ],
        POSTINGS,
    )
    out = by_ord(dedup.deduplicate(df, levels=2))
    assert sorted(out) == [1, 4]
    r = out[1]
    # The second record is richer: it is the base, the first fills its description and job type.
    assert (r.company, r.description, r.job_type, r.salary_text, r.salary_min) == ("ACME Ltd", "short", "full-time", "£10", 0.0)
    assert r.sources == ["reed", "indeed"] and r.benefits == ["x"]
    assert r.field_sources["description"] == ["reed"] and r.field_sources["salary_min"] == ["indeed"]


def test_tie_keeps_the_earlier_and_empty_text_is_not_filled(spark):
    df = spark.createDataFrame(
        [posting(1, description="", apply_url="a"), posting(2, source="indeed", description="b")], POSTINGS)
    r = by_ord(dedup.deduplicate(df, levels=2))[1]
    assert r.source == "reed" and r.description == "" and r.apply_url == "a"


def test_level3(spark):
    df = spark.createDataFrame(
        [
            posting(1, title="Staff Nurse (Nights)", description="d1"), posting(2, title="Staff Nurse - Night", source="indeed", location="York"),
            posting(3, title="Nurse Staff"), posting(4, company=None, title="Cook"), posting(5, company="", title="Cook!", location="York"),
        ],
        POSTINGS,
    )
    out = by_ord(dedup.deduplicate(df))
    assert sorted(out) == [1, 3, 4] and out[1].sources == ["reed", "indeed"] and out[1].description == "d1"
    assert sorted(by_ord(dedup.deduplicate(df, match_location=True))) == [1, 2, 3, 4, 5]
    assert sorted(by_ord(dedup.deduplicate(df, blank_company="skip"))) == [1, 3, 4, 5]
    again = dedup.deduplicate(dedup.deduplicate(df))
    assert sorted(by_ord(again)) == [1, 3, 4]


def test_dedup_of_a_hot_company_does_not_depend_on_partitioning(spark):
    rng = random.Random(1)
    rows = [
        posting(n, company=rng.choice(["Hot", "Hot", None, f"c{n % 7}"]), title=rng.choice(WORDS) + " " + rng.choice(WORDS), location=rng.choice(["A", "B", None]))
        for n in range(600)
    ]
    df = spark.createDataFrame(rows, POSTINGS)
    a = [tuple(map(str, r)) for r in dedup.deduplicate(df.repartition(1)).orderBy("ord").collect()]
    b = [tuple(map(str, r)) for r in dedup.deduplicate(df.repartition(7)).orderBy("ord").collect()]
    assert a == b and 0 < len(a) < 600


def part(company, priority, label, **kw):
    base = {f.name: None for f in CONTACT_PARTS.fields} | {
        "company": company, "priority": priority, "part_ord": 0, "phone_numbers": [], "emails": [], "enrichment_sources": [label], "ai_used": False}
    return tuple((base | kw)[f.name] for f in CONTACT_PARTS.fields)


def test_merge_contacts(spark):
    df = spark.createDataFrame(
        [
            part("a", 0, "job_description", phone_numbers=["1", "2"], emails=["Info@x"], enriched_at="2024-01-02"),
            part("a", 1, "website", phone_numbers=["2", "3"], emails=["info@X", "HR@x"], company_website="http://w", contact_person="W"),
            part("a", 2, "website", company_website="https://w2", contact_person="", address="web"),
            part("a", 3, "other", contact_person="O", company_number="7", address="o"),
            part("b", 7, "gemini", ai_used=True, contact_person="P"),
        ],
        CONTACT_PARTS,
    )
    out = {r.company: r for r in contacts.merge_contacts(df).collect()}
    a = out["a"]
    assert a.phone_numbers == ["1", "2", "3"] and a.emails == ["HR@x", "Info@x"]
    # The last part under a label speaks for it, unlisted labels never name a person.
    assert a.contact_person is None and a.address == "web" and a.company_website == "https://w2"
    assert a.field_sources["phone_numbers"] == ["job_description", "website"] and a.company_number == "7"
    assert a.enrichment_sources == ["job_description", "website", "other"] and a.confidence_score == 100
    assert out["b"].confidence_score == 0


def test_gate(spark):
    df = spark.createDataFrame(
        [
            part("a", 1, "website", phone_numbers=["1"]), part("a", 3, "charities", emails=["e"]), part("a", 4, "cqc", phone_numbers=["9"]),
            part("b", 1, "website", phone_numbers=["1"]), part("b", 5, "duckduckgo", phone_numbers=["2"]),
        ],
        CONTACT_PARTS,
    )
    kept = {(r.company, r.priority) for r in waterfall.gate_parts(df).collect()}
    assert kept == {("a", 1), ("a", 3), ("b", 1), ("b", 5)}


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3, "x"), ("c", 4, "y")], "k string, v int, extra string")
    once = upsert.upsert(old, new, ["k"])
    twice = upsert.upsert(once, new, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 1, None), ("b", 3, "x"), ("c", 4, "y")]


def test_register_names_meet_in_blocks(spark, monkeypatch):
    rng = random.Random(11)
    monkeypatch.setattr(registry, "BLOCK_COMPANIES", 7)
    monkeypatch.setattr(registry, "BLOCK_NAMES", 5)
    # One word that all share, names longer than a machine word, and many ties.
    companies = ["the " + n for n in noisy(rng, 40)] + ["the " + "very long name of a care home " * 3 + n for n in noisy(rng, 6)]
    names = ["THE " + n for n in noisy(rng, 60)] + [companies[-1] + " s", companies[-2][:-3], companies[0].upper()]
    left = spark.createDataFrame([(c,) for c in companies], "company string")
    right = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "name string, cand_ord bigint")

    def edit(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return 1 - row[-1] / max(len(a), len(b))

    for kind, measure in (("sequence", ratio), ("edit", edit)):
        want = {}
        for c in companies:
            score, k = max((measure(c, n.lower()), -k) for k, n in enumerate(names))
            if score >= 0.75:
                want[c] = (-k, round(score, 9))
        got = {r.company: (r.cand_ord, round(r.score, 9)) for r in registry.best_matches(left, right, 0.75, kind).collect()}
        assert len(want) > 10 and got == want


def test_register_blocks_are_compared_in_many_tasks(spark):
    names = [(f"common word{n}", n) for n in range(40)]
    left, right = spark.createDataFrame([(n,) for n, _ in names], "company string"), spark.createDataFrame(names, "name string, cand_ord long")
    before = registry.BLOCK_COMPANIES, registry.BLOCK_NAMES
    registry.BLOCK_COMPANIES, registry.BLOCK_NAMES = 8, 8
    try:
        for kind in ("edit", "sequence"):
            hits = registry.best_matches(left, right, 0.75, kind)
            assert {r.company: r.cand_ord for r in hits.collect()} == dict(names)
            plan = hits._jdf.queryExecution().optimizedPlan().toString()
            assert "RepartitionByExpression" in plan and "MapInPandas" in plan
    finally:
        registry.BLOCK_COMPANIES, registry.BLOCK_NAMES = before
