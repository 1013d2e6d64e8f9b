"""Markup: character references, balanced elements, cards; and the repository without its optional part."""

import html
import shutil
import subprocess
import sys
from html.entities import html5
from pathlib import Path

from pyspark.sql import functions as F

from vacancia.functions import text
from vacancia.functions.similarity import may_reach, ratio_at_least
from vacancia.sources import web_pages

CARDS = {
    '<div data-jk="1"><h2 class=jobTitle><a>Staff Nurse</a></h2><span title="Urgently hiring">x</span></div>': ("Staff Nurse", None),
    '<div data-jk="2"><h2 class="x jobTitle"><a>Staff <b>Nurse</b></a></h2><div class="companyName"><div>A</div> and <div><div>C</div></div>B</div> tail</div>': ("Staff Nurse", "A and C B"),
    '<div data-jk="3"><h2 class="jobTitle"><span>new</span><a id="job_3"><span title="Nurse &amp; Co">short</span></a></h2><span data-testid="company-name">&nbsp;</span><span class="company-name">Z</span>': ("Nurse & Co", "Z"),
    '<div data-jk="4"><span title="Only">o</span><br></div>': ("Only", None),
    '<div data-jk="5"><h2 class="jobTitle"> <!-- none --> </h2><div data-testid="jobTitle">T<div>wo</div></div></div>': ("T wo", None),
    '<div data-jk="6"></div>': ("Unknown", None),
}


def test_every_named_reference_decodes(spark):
    cases = [p + n + s for n in html5 for p, s in (("&", ""), ("x&", "y"))]
    cases += ["&notit;", "&amp;lt;", "&#65;&#x41;&#X41 &#128;&#55296;&#99999999999;&#1114112;", "a & b && c &;", "&unknown;", "&#;", "&#x;", ""]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    for r in df.select("c", text.decode_entities(F.col("c")).alias("d")).collect():
        assert r["d"] == html.unescape(r["c"])


def test_cards_are_bound_to_their_heading_and_elements_are_balanced(spark):
    rows = web_pages.project_cards(spark.createDataFrame([(c,) for c in CARDS], "card string")).collect()
    assert sorted(str((r["title"], r["company"])) for r in rows if r["scraped_at"]) == sorted(map(str, CARDS.values()))


def test_balanced_div(spark):
    pages = ['<p><div id="d"><div>a<div>b</div></div>c</div>e</p>', '<div id="d">open <b>end', "none", ""]
    df = spark.createDataFrame([(p,) for p in pages], "h string")
    got = [r[0] for r in df.select(web_pages.inner_of_div(F.col("h"), "d").alias("x")).collect()]
    assert got == ["<div>a<div>b</div></div>c", "open <b>end", "", ""]


def test_edit_bound_loses_no_pair(spark):
    import random

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 12)))
    pairs = [(a, a[: rng.randrange(len(a) + 1)] + word() if rng.random() < 0.5 else word()) for a in (word() for _ in range(1500))]
    df = spark.createDataFrame(pairs, "a string, b string")
    for t in (0.7, 0.85):
        rows = df.select(may_reach(F.col("a"), F.col("b"), t).alias("may"), ratio_at_least(t)(F.col("a"), F.col("b")).alias("r"))
        assert rows.where("r IS NOT NULL AND NOT may").count() == 0 < rows.where("NOT may").count()


def test_repository_works_without_its_optional_part(tmp_path):
    root = Path(__file__).resolve().parents[1]
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__")
    shutil.copytree(root, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 108 and out[1:] == ["0", "False", "True"]


def test_selectors_behind_the_first_good_one_are_not_looked_for(spark):
    selectors = web_pages.CARD_SELECTORS | {"title": [(("h2",),), (("h2", "class", "("),)]}
    cards = spark.createDataFrame([('<div data-jk="1"><h2 class="x">Nurse</h2><h2 class="(">no</h2></div>',)], "card string")
    assert web_pages.project_cards(cards, selectors).first()["title"] == "Nurse"


def test_queries_of_few_columns_store_no_whole_postings(spark, tmp_path):
    from checks.fixtures import Inputs

    spark.createDataFrame([(k, k % 2, 100.0 + k) for k in range(40)], "o_orderkey bigint, o_custkey bigint, o_totalprice double").selectExpr(
        "*", "TIMESTAMP '2024-01-01 00:00:00' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    rows = {
        "customer": spark.sql("SELECT explode(array(0L, 1L)) AS c_custkey, 0 AS c_nationkey"),
        "nation": spark.sql("SELECT 0 AS n_nationkey, 'N' AS n_name"),
        "documents": spark.sql("SELECT id AS doc_id, 'Acme care staff nurse ' || id AS text FROM range(3)"),
    }
    for t in "region supplier part lineitem events embeddings pages benchmark labels conversations".split():
        rows[t] = spark.sql("SELECT 1 AS x")
    for t, df in rows.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    i = Inputs(spark, str(tmp_path))
    few = i.columns("f_postings", "ord", "price", "description", "dk")
    n_parts = i.view("f_parts").count()
    assert not i.landed & {"f_postings"} and n_parts > 0
    got = sorted(map(str, few.collect()))
    assert len(got) == 40 and got == sorted(map(str, i.view("f_postings").select("ord", "price", "description", "dk").collect()))
    assert "f_postings" in i.landed
