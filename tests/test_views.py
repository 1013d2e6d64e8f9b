"""Input views that Spark builds in a way of its own."""

import re

from checks.fixtures import view_sql


def test_words_of_documents(spark):
    texts = ["", None, "  one", "12 Straße, ÉTÉ x÷y", "a b c d e f g", "\n1 ab\tcd-EF 9gh ij? kl" + " zz" * 50_000, "İstanbul ŒUVRE naïve"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").createOrReplaceTempView("documents")
    want = {}
    for n, text in enumerate(texts):
        words = [w.lower().replace("ß", "ss") for w in re.findall("[A-Za-zÀ-ÿ]+", text or "")] + [""] * 5
        got = [w or other for w, other in zip(words, ["alpha", "beta", "nurse", "ward", "team"])]
        want[n] = (None, None) if text is None else (" ".join(got[:2]), " ".join(got[2:]))
    found = spark.sql(view_sql(False)["f_docs"])
    assert {r.dk: (r.name, r.title) for r in found.collect()} == want
    # No text is rewritten as a whole.
    assert "regexp_replace" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_copies_of_postings_come_from_one_reading(spark):
    columns = {"ord": "long", "dk": "long", "salary_min": "double", "salary_max": "double", "requirements": "array<string>", "benefits": "array<string>"}
    names = ("ord job_id source title company company_url location location_city location_postcode salary_text salary_min salary_max salary_period job_type "
             "description requirements benefits posted_at expires_at apply_url scraped_at dk").split()
    rows = [tuple({"ord": n, "dk": n, "salary_min": 1.0, "salary_max": None, "requirements": ["r"], "benefits": [], "job_type": None if n else "full",
                   "expires_at": None}.get(c, f"{c}{n}") for c in names) for n in (0, 1, 5, 7, 11, 35, 77, 385)]
    rows.append(tuple(None if c == "ord" else rows[1][k] for k, c in enumerate(names)))
    spark.createDataFrame(rows, ", ".join(f"{c} {columns.get(c, 'string')}" for c in names)).createOrReplaceTempView("f_postings")
    found = spark.sql(view_sql(False)["f_dup"])
    assert sorted(r.ord for r in found.collect() if r.ord is not None) == sorted(
        4 * n + c for n in (0, 1, 5, 7, 11, 35, 77, 385) for c, every in ((0, 1), (1, 7), (2, 5), (3, 11)) if n % every == 0)
    by = {r.ord: r for r in found.collect()}
    assert by[None].title == "title1" and by[0].title == "title0" and by[1].title == "copy title0" and by[3].title == "title0 x" and by[3].job_id == "N0"
    mirror = by[4 * 5 + 2]
    assert (mirror.source, mirror.job_id, mirror.salary_text, mirror.salary_min, mirror.salary_period, mirror.job_type, mirror.expires_at, mirror.apply_url, mirror.benefits) == (
        "mirror", "M5", None, 21.0, "annual", "contract", "2030-01-01", None, ["mirror benefit"])
    assert by[2].job_type == "full" and by[4 * 5].benefits == [] and found.columns == [c for c in names]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
