"""Scalar rules, case by case."""

import pytest
from pyspark.sql import functions as F

from vacancia.functions import dates, money, phones, text


def values(spark, rows, fn):
    df = spark.createDataFrame([(n, r) for n, r in enumerate(rows)], "n int, v string")
    return [r[0] for r in df.orderBy("n").select(fn(F.col("v"))).collect()]


def test_norm_name(spark):
    cases = {
        "Café Ltd²": "café ltd²", "acme ltd uk": "acme  uk", "\tStaff_Nurse! ": "staff_nurse",
        "St Mary's NHS Foundation Trust": "st mary s", "Foo Limited PLC": "foo", None: "", "ltd": "",
        "nhs ltd trust": "nhs  trust",
    }
    assert values(spark, list(cases), text.norm_name) == list(cases.values())


def test_content_hash_falls_back_to_the_id(spark):
    none = F.lit(None).cast("string")
    row = spark.range(1).select(
        text.content_hash(none, none, none, F.lit("a")).alias("a"), text.content_hash(none, none, none, F.lit("b")).alias("b"),
        text.content_hash(F.lit("Nurse"), F.lit("Acme Ltd"), F.lit("Leeds"), F.lit("a")).alias("c"),
        text.content_hash(F.lit("nurse!"), F.lit("ACME Limited"), F.lit("leeds"), F.lit("b")).alias("d"),
    ).first()
    assert row.a != row.b and row.c == row.d and len(row.c) == 12


def test_phones(spark):
    cases = {
        "call 020 7946 0958.": ["+44 20 7946 0958"], "+44 20 7946 0958": ["+44 20 7946 0958"], "0044 1632 960001": ["+44 1632 960001"],
        "+44 (0)20 7946 0958": [], "10203456789012": ["+44 20 3456 7890"][:0], "012.345678901": [],
        "01202 345678": [], "07700 900123 and 07700-900123": ["+44 7700 900123"], "": [], None: [],
    }
    got = values(spark, list(cases), phones.extract_phones)
    # Twelve digits are taken from the long run, which is no valid number.
    assert got == list(cases.values())
    kept = values(spark, ["01202 345678"], lambda c: phones.extract_phones(c, year_filter=False))
    assert kept == [["+44 1202 345678"]]


def test_emails(spark):
    cases = {
        "logo@2x.png and no-reply@x.org, HR@Acme.co.uk; hr@acme.co.uk": ["hr@acme.co.uk"],
        "a@b.co_m@x.yy": ["a@b.co", "_m@x.yy"], "nothing": [], None: [], "x" * 50000 + " a@b.org": ["a@b.org"],
    }
    assert values(spark, list(cases), text.extract_emails) == list(cases.values())
    assert values(spark, ["  A@B.org trailing", "bad"], text.clean_email) == ["a@b.org trailing", None]


def test_email_order_is_stable(spark):
    df = spark.createDataFrame([(["b@x.org", "HR@x.org", "a@x.org", "jobs@x.org"],)], "e array<string>")
    assert df.select(text.emails_by_priority(F.col("e"))).first()[0] == ["HR@x.org", "jobs@x.org", "b@x.org", "a@x.org"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("£30,000 - £35,000 a year", (30000.0, 35000.0, "annual")), ("up to £18.50 per hour", (None, 18.5, "hourly")),
        ("£30k", (30.0, 30.0, None)), ("Competitive", (None, None, None)), ("£25,000 does apply", (None, None, None)),
        ("£,", (None, None, None)), ("per annum", (None, None, "annual")), ("£40,000 to £35,000", (35000.0, 40000.0, None)),
        (None, (None, None, None)),
    ],
)
def test_salary(spark, raw, want):
    s = spark.createDataFrame([(raw,)], "v string").select(money.parse_salary(F.col("v")).alias("s")).first().s
    assert (s.min, s.max, s.period) == want


def test_locations(spark):
    got = values(spark, ["Leeds LS1 3AB", "X, UK", ", London", "York, yo1 7hh, United Kingdom", None], text.parse_location)
    assert [(g.city, g.postcode) for g in got] == [
        ("Leeds LS1 3AB", "LS1 3AB"), (None, None), (None, None), ("York", "YO1 7HH"), (None, None)]


def test_html(spark):
    html = (
        "<!DOCTYPE html><title>T &amp; U</title><style>p{}</style><script>var t='</p>';</script><!-- <b>no</b> -->"
        "<p> a&nbsp; </p>\n <p>5 &lt; 6 &#163;7 &#x20AC;8 &amp;lt;</p> x < y <template>z</template>"
    )
    assert values(spark, [html, None], text.html_to_text) == ["T & U a 5 < 6 £7 €8 &lt; x < y", ""]


def test_dates(spark):
    assert values(spark, ["03/04/2024", "31/02/2024", "soon", "", None], dates.dmy_to_iso) == ["2024-04-03", "31/02/2024", "soon", None, None]
    as_of = F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    rows = ["2024-05-31", "2024-05-30", None, "2 days ago", "2024-05-30T23:59:59Z", "2024-05-31T00:00:00"]
    assert values(spark, rows, lambda c: dates.since(c, 1, as_of)) == [True, False, True, True, False, True]
    assert values(spark, rows, lambda c: dates.fresh_until(c, 1, as_of)) == [True, False, False, False, False, True]


def test_address_near_postcode(spark):
    long = "x" * 300 + " 1 High St,\n Leeds LS1 3AB, open daily and much more text follows"
    got = values(spark, [long, "no code"], text.address_near_postcode)
    at = long.index("LS1 3AB")
    want = " ".join(long[max(0, at - 100): at + 7 + 20].split())[:200]
    assert got == [want, None]


def test_names_are_normalised_in_one_pass_over_punctuation_and_space(spark):
    names = {"  A.B -  Ltd.\x1c": "a b", "Ward 　Lead (NHS Trust)": "ward lead", "x ltd y": "x  y", "_a\x85": "_a", "É!ltd": "é", "ltdx plc1": "ltdx plc1", "": "", None: ""}
    df = spark.createDataFrame([(n,) for n in names], "name string").select("name", text.norm_name(F.col("name")).alias("norm"))
    assert {r.name: r.norm for r in df.collect()} == names
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 2
