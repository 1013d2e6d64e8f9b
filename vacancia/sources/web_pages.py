"""Postings inside web pages: embedded page JSON, JSON-LD, result cards, single job pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_ms_to_date, time_stamp
from ..functions.money import period_of_unit, render_salary
from ..functions.text import (
    MARKUP, WS, absolute_link, bound, cut, html_to_text, is_json, join_parts, strip, url_query_value, url_tail,
)
from ..schema import blank_to_null, first_filled

# ---------------------------------------------------------------- embedded page JSON

# Fixed value: where the page keeps its result list.
EMBEDDED = (
    r'(?s)window\.mosaic\.providerData\["mosaic-provider-jobcards"\]\s*=\s*(\{.+?\});'
)
# Link prefixes of this source.
LINK_HOST = "https://uk.indeed.com"
LINK_BY_ID = "https://uk.indeed.com/viewjob?jk="

_ITEM = (
    "struct<jobkey:string,displayTitle:string,title:string,company:string,"
    "formattedLocation:string,jobLocationCity:string,jobLocationPostal:string,"
    "salarySnippet:struct<text:string>,"
    "extractedSalary:struct<min:string,max:string,type:string>,"
    "estimatedSalary:struct<min:string,max:string,type:string>,"
    "pubDate:string,jobTypes:array<string>,snippet:string,viewJobLink:string>"
)
_EMBEDDED = (
    f"struct<metaData:struct<mosaicProviderJobCardsModel:struct<results:array<{_ITEM}>>>>"
)


def embedded_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """Result items of each page, with their position; pages without the blob give none."""
    blob = F.regexp_extract(html, EMBEDDED, 1)
    items = F.from_json(blob, _EMBEDDED)["metaData"]["mosaicProviderJobCardsModel"]["results"]
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(items).alias("pos", "item")).select(*keep, "pos", "item.*")


def _amount(c: Column) -> Column:
    v = c.try_cast("double")
    return F.when(v != 0, v)


def project_embedded(items: DataFrame, source: str = "indeed", now: Column | None = None) -> DataFrame:
    extracted, estimated = F.col("extractedSalary"), F.col("estimatedSalary")
    # The first salary block with any amount counts, as a whole.
    use_first = _amount(extracted["min"]).isNotNull() | _amount(extracted["max"]).isNotNull()
    use_second = _amount(estimated["min"]).isNotNull() | _amount(estimated["max"]).isNotNull()

    def pick(name: str) -> Column:
        return F.when(use_first, extracted[name]).when(use_second, estimated[name])

    kind = F.lower(pick("type"))
    job_id = F.coalesce("jobkey", F.lit(""))
    by_id = F.when(job_id != "", F.concat(F.lit(LINK_BY_ID), job_id))
    types = F.transform("jobTypes", F.lower)
    extra = [c for c in ("ord", "page_id", "pos") if c in items.columns]
    return items.select(
        *extra,
        job_id.alias("job_id"),
        F.lit(source).alias("source"),
        first_filled("displayTitle", "title", F.lit("Unknown")).alias("title"),
        blank_to_null("company").alias("company"),
        first_filled("formattedLocation", "jobLocationCity").alias("location"),
        blank_to_null("jobLocationCity").alias("location_city"),
        blank_to_null("jobLocationPostal").alias("location_postcode"),
        blank_to_null(F.col("salarySnippet")["text"]).alias("salary_text"),
        _amount(pick("min")).alias("salary_min"),
        _amount(pick("max")).alias("salary_max"),
        F.when(kind.contains("hour"), "hourly").when(kind.rlike("year|annual"), "annual").alias("salary_period"),
        blank_to_null(F.array_join(types, ", ")).alias("job_type"),
        epoch_ms_to_date(F.col("pubDate")).alias("posted_at"),
        absolute_link(F.col("viewJobLink"), LINK_HOST, by_id).alias("apply_url"),
        blank_to_null(html_to_text(F.col("snippet"))).alias("description"),
        time_stamp(now).alias("scraped_at"),
    )


# ---------------------------------------------------------------- JSON-LD

_LD_SCRIPT = (
    r"""(?is)<script\b[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""
)
_LD_ITEM = "`@type` string, itemListElement array<string>, `@graph` array<string>, item string"


def _ld_documents(html: Column) -> Column:
    """Parsed top-level items of every JSON-LD script, as JSON text; broken scripts are skipped."""
    scripts = F.filter(
        F.regexp_extract_all(html, F.lit(_LD_SCRIPT), F.lit(1)),
        is_json,
    )
    return F.flatten(
        F.transform(
            scripts,
            lambda s: F.when(
                F.startswith(strip(s), F.lit("[")), F.from_json(s, "array<string>")
            ).otherwise(F.array(s)),
        )
    )


def _ld_type(item: Column) -> Column:
    return F.get_json_object(item, "$['@type']")


def find_jobpostings(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per schema.org JobPosting: bare, in an array, in an ItemList or in a @graph."""
    keep = [c for c in pages.columns if c != html]
    docs = pages.select(*keep, F.posexplode(_ld_documents(F.col(html))).alias("doc", "text"))
    parsed = docs.withColumn("d", F.from_json("text", _LD_ITEM))

    def inner(element: Column) -> Column:
        wrapped = F.get_json_object(element, "$.item")
        return F.coalesce(wrapped, element)

    candidates = (
        F.when(F.col("d.@type") == "JobPosting", F.array("text"))
        .when(F.col("d.@type") == "ItemList", F.transform("d.itemListElement", inner))
        .otherwise(F.col("d.@graph"))
    )
    rows = parsed.select(*keep, "doc", F.posexplode(candidates).alias("pos", "posting"))
    return rows.where(_ld_type(F.col("posting")) == "JobPosting")


_POSTING = (
    "identifier string, url string, title string, hiringOrganization string, jobLocation string, "
    "baseSalary string, salaryCurrency string, employmentType string, description string, "
    "qualifications string, experienceRequirements string, skills string, jobBenefits string, "
    "datePosted string, validThrough string"
)


def _is_object(c: Column) -> Column:
    return F.coalesce(F.startswith(c, F.lit("{")), F.lit(False))


def _is_array(c: Column) -> Column:
    return F.coalesce(F.startswith(c, F.lit("[")), F.lit(False))


def _list_or_lines(c: Column) -> Column:
    """A JSON array as it is, a text split into its non-blank lines."""
    lines = F.transform(F.split(c, r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"), strip)
    values = F.when(_is_array(c), F.from_json(c, "array<string>")).otherwise(lines)
    return F.coalesce(
        F.filter(values, lambda v: v.isNotNull() & (v != "")), F.array().cast("array<string>")
    )


def salary_of(obj: Column) -> Column:
    """struct(min, max, period) of a ``baseSalary`` value given as JSON text."""
    value = F.get_json_object(obj, "$.value")
    nested = _is_object(value)
    low = F.when(nested, F.get_json_object(value, "$.minValue")).otherwise(value)
    high = F.when(nested, F.get_json_object(value, "$.maxValue")).otherwise(value)
    unit = F.when(nested, F.get_json_object(value, "$.unitText")).otherwise(
        F.get_json_object(obj, "$.unitText")
    )
    bad = (low.isNotNull() & (low != "") & low.try_cast("double").isNull()) | (
        high.isNotNull() & (high != "") & high.try_cast("double").isNull()
    )
    ok = ~F.coalesce(bad, F.lit(False))
    return F.struct(
        F.when(ok, _amount(low)).alias("min"),
        F.when(ok, _amount(high)).alias("max"),
        period_of_unit(unit).alias("period"),
    )


def project_jobposting(
    postings: DataFrame, source: str, description_chars: int | None = None, now: Column | None = None,
) -> DataFrame:
    """JobPosting JSON (column ``posting``) to posting columns."""
    keep = [c for c in postings.columns if c != "posting"]
    p = postings.select(*keep, F.from_json("posting", _POSTING).alias("p")).select(*keep, "p.*")
    p = p.withColumn("_salary", salary_of(F.col("baseSalary")))
    place = F.when(
        _is_array(F.col("jobLocation")), F.get_json_object("jobLocation", "$[0]")
    ).otherwise(F.col("jobLocation"))
    p = p.withColumn("_address", F.get_json_object(place, "$.address"))

    ident = F.when(
        _is_object(F.col("identifier")), F.get_json_object("identifier", "$.value")
    ).otherwise(F.col("identifier"))
    fallback_id = F.abs(F.xxhash64(F.coalesce("title", F.lit("")))).cast("string")
    job_id = first_filled(ident, url_tail(F.col("url")), fallback_id)
    org = F.when(_is_object(F.col("hiringOrganization")), F.col("hiringOrganization"))
    town = F.get_json_object("_address", "$.addressLocality")
    region = F.get_json_object("_address", "$.addressRegion")
    code = F.get_json_object("_address", "$.postalCode")
    low, high, period = (F.col("_salary")[k] for k in ("min", "max", "period"))
    currency = F.coalesce("salaryCurrency", F.lit("GBP"))
    symbol = F.when(currency.isin("GBP", ""), "£").otherwise(F.concat(currency, F.lit(" ")))
    kinds = F.when(
        _is_array(F.col("employmentType")),
        F.array_join(F.from_json("employmentType", "array<string>"), ", "),
    ).otherwise(F.col("employmentType"))
    return p.select(
        *keep,
        job_id.alias("job_id"),
        F.lit(source).alias("source"),
        F.coalesce("title", F.lit("Unknown")).alias("title"),
        F.get_json_object(org, "$.name").alias("company"),
        F.get_json_object(org, "$.sameAs").alias("company_url"),
        join_parts(town, region, code).alias("location"),
        town.alias("location_city"),
        code.alias("location_postcode"),
        F.when(low.isNotNull() & high.isNotNull(), render_salary(low, high, period, symbol)).alias("salary_text"),
        low.alias("salary_min"),
        high.alias("salary_max"),
        period.alias("salary_period"),
        F.lower(blank_to_null(kinds)).alias("job_type"),
        cut(blank_to_null(html_to_text(F.col("description"))), description_chars).alias("description"),
        F.concat(
            _list_or_lines(F.col("qualifications")),
            _list_or_lines(F.col("experienceRequirements")),
            _list_or_lines(F.col("skills")),
        ).alias("requirements"),
        _list_or_lines(F.col("jobBenefits")).alias("benefits"),
        F.col("datePosted").alias("posted_at"),
        F.col("validThrough").alias("expires_at"),
        F.col("url").alias("apply_url"),
        time_stamp(now).alias("scraped_at"),
    )


def ld_address(html: Column) -> Column:
    """Postal address of the first JSON-LD item that carries one."""

    def address(item: Column) -> Column:
        own = F.get_json_object(item, "$.address")
        a = F.when(_is_object(own), own).otherwise(F.get_json_object(item, "$.location.address"))
        return F.when(
            _is_object(a),
            join_parts(
                *[
                    F.get_json_object(a, f"$.{k}")
                    for k in (
                        "streetAddress", "addressLocality", "addressRegion", "postalCode",
                        "addressCountry",
                    )
                ]
            ),
        )

    found = F.filter(F.transform(_ld_documents(html), address), lambda a: a.isNotNull())
    return F.get(found, F.lit(0))


# ---------------------------------------------------------------- cards and single pages


def _opening(tag: str, attribute: str | None = None, value: str = "", starts: bool = False) -> str:
    """Pattern of an opening tag, with an attribute that contains, or starts with, a value."""
    if attribute is None:
        return rf"<{tag}\b[^>]*>"
    quoted, bare = ("", "") if starts else ("[^\"']*", "[^\\s\"'>]*")
    return rf"""<{tag}\b[^>]*\b{attribute}\s*=\s*(?:["']{quoted}{value}[^"']*["']|{bare}{value}[^\s"'>]*)[^>]*>"""


_ANY = "[a-z][a-z0-9]*"
_HEADING, _TEST_ID = ("h2", "class", "jobTitle"), (_ANY, "data-testid", "jobTitle")
_LINK, _NAMED = ("a",), ("span", "title")

# Selectors per field, tried in order; each is a chain of elements, one inside the other.
CARD_SELECTORS = {
    "title": [
        (_HEADING, _LINK, _NAMED), (_HEADING, _NAMED), (_HEADING, _LINK), (_HEADING,),
        (_TEST_ID, _LINK, _NAMED), (_TEST_ID, _LINK), (_TEST_ID,),
        (("a", "id", "job_", True), _NAMED), (_NAMED,),
    ],
    "company": [
        ((_ANY, "data-testid", "company-name"),), ((_ANY, "class", "companyName"),), ((_ANY, "class", "company-name"),),
        (("a", "data-tn-element", "companyName"),),
    ],
    "location": [
        ((_ANY, "data-testid", "text-location"),), ((_ANY, "class", "companyLocation"),), ((_ANY, "class", "job-location"),),
        ((_ANY, "class", "resultContent"), (_ANY, "class", "location")), ((_ANY, "class", "location"),),
    ],
    "salary_text": [
        ((_ANY, "data-testid", "attribute_snippet_testid"),), ((_ANY, "class", "salary-snippet"),), ((_ANY, "class", "salaryText"),),
    ],
    "posted_at": [((_ANY, "data-testid", "myJobsStateDate"),), (("span", "class", "date"),), ((_ANY, "class", "date"),)],
}


# Markup and white space: what is left of an element without them is text.
_BLANK = rf"{MARKUP}|{WS}|&(?:nbsp|#160|#[xX][aA]0)(?:;|\b)"


def tag_pieces(html: Column) -> Column:
    """Markup cut before every tag: array of (text, the same in lower case, name of the tag, whether it closes)."""
    pieces = F.filter(F.split(html, r"(?=<[a-zA-Z/])"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            p.alias("text"), F.lower(p).alias("low"),
            F.lower(F.regexp_extract(p, r"^</?([a-zA-Z][a-zA-Z0-9]*)", 1)).alias("tag"), F.startswith(p, F.lit("</")).alias("closing"),
        ),
    )


def outer_pieces(pieces: Column, opening: Column, needle: Column) -> Column:
    """Pieces of the first element whose opening tag matches, up to the closing tag that balances it.

    Null without such an element; one that is never closed reaches to the end. One fold carries a depth and a
    number over the pieces and copies no text. A tag without ``needle`` in it is not matched.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"))

    def balanced(rest: Column) -> Column:
        def step(acc: Column, piece: Column) -> Column:
            own = piece["tag"] == F.get(rest, F.lit(0))["tag"]
            turn = F.when(own & piece["closing"], -1).when(own, 1).otherwise(0)
            going = (acc["n"] == 0) | (acc["depth"] > 0)
            depth = F.when(going, acc["depth"] + turn).otherwise(0)
            return F.struct(depth.alias("depth"), (acc["n"] + (depth > 0).cast("int")).alias("n"))

        return F.slice(rest, F.lit(1), F.aggregate(rest, start, step)["n"])

    def hit(p: Column) -> Column:
        return F.contains(p["low"], needle) & F.rlike(p["text"], opening)

    place = F.array_position(F.transform(pieces, hit), F.lit(True)).cast("int")
    return bound(place, lambda at: F.when(at > 0, bound(F.slice(pieces, at, F.size(pieces)), balanced)))


def markup_of(pieces: Column) -> Column:
    """Markup inside the element that the pieces make up."""
    return F.regexp_replace(F.array_join(F.transform(pieces, lambda p: p["text"]), ""), r"^<[^>]*>", "")


def _parts(selector: tuple) -> Column:
    """A selector's opening tags as data: (pattern, what the tag must contain at least)."""
    return F.array(*[
        F.struct(F.lit(f"(?is)^{_opening(*p)}").alias("opening"), F.lit(p[2].lower() if len(p) > 2 else p[1] if len(p) > 1 else f"<{p[0]}").alias("needle")) for p in selector
    ])


def first_selected(pieces: Column, selectors: list[tuple], read: Callable[[Column], Column], good: Callable[[Column], Column]) -> Column:
    """What is read from the element of the first selector for which it is good; later ones are not looked for. Null if there is none.

    Selectors are data of one expression, so that a plan does not grow with them.
    """
    # Every step looks behind the first piece, the opening tag of the element found before.
    whole = F.concat(F.slice(pieces, F.lit(1), F.lit(1)), pieces)

    def step(found: Column, part: Column) -> Column:
        return outer_pieces(F.slice(found, F.lit(2), F.greatest(F.size(found), F.lit(0))), part["opening"], part["needle"])

    def read_one(element: Column) -> Column:
        text = F.when(element.isNotNull(), read(element))
        return bound(text, lambda t: F.when(good(t), t))

    def next_one(found: Column, selector: Column, w: Column) -> Column:
        return F.when(found.isNotNull(), found).otherwise(bound(F.aggregate(selector, w, step), read_one))

    every = F.array(*map(_parts, selectors))
    return bound(whole, lambda w: F.aggregate(every, F.lit(None).cast("string"), lambda found, s: next_one(found, s, w)))


def card_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per result card: page markup cut at every element that carries ``data-jk``."""
    keep = [c for c in pages.columns if c != html]
    pieces = F.split(F.col(html), r"(?i)(?=<[a-z0-9]+\b[^>]*\bdata-jk\s*=)")
    cards = pages.select(*keep, F.posexplode(pieces).alias("pos", "card"))
    return cards.where(F.col("card").rlike(r"(?i)^<[a-z0-9]+\b[^>]*\bdata-jk\s*="))


def project_cards(
    cards: DataFrame, selectors: dict[str, list[tuple]] | None = None, source: str = "indeed", now: Column | None = None,
) -> DataFrame:
    """Per field, the first selector with a non-empty value wins.

    A title is taken from the element's ``title`` attribute before its text.
    """
    selectors = selectors or CARD_SELECTORS
    keep = [c for c in cards.columns if c != "card"]
    job_id = F.regexp_extract("card", r"""(?i)\bdata-jk\s*=\s*["']([^"']*)["']""", 1)

    rows = cards.withColumn("_pieces", tag_pieces(F.col("card")))

    def attribute(element: Column) -> Column:
        return F.regexp_extract(F.get(element, F.lit(0))["text"], r"""(?is)^<[^>]*?\btitle\s*=\s*(["'])(.*?)\1""", 2)

    def says(text: Column) -> Column:
        return F.regexp_replace(text, _BLANK, "") != ""

    def first(name: str, read) -> Column:
        """What is read from the first element that says something."""
        found = first_selected(F.col("_pieces"), selectors[name], read, says)
        return blank_to_null(bound(found, lambda t: F.when(t.isNotNull(), html_to_text(t))))

    def named(element: Column) -> Column:
        return F.when(says(attribute(element)), attribute(element)).otherwise(markup_of(element))

    return rows.select(
        *keep,
        job_id.alias("job_id"),
        F.lit(source).alias("source"),
        F.coalesce(first("title", named), F.lit("Unknown")).alias("title"),
        *[first(n, markup_of).alias(n) for n in ("company", "location", "salary_text", "posted_at")],
        F.when(job_id != "", F.concat(F.lit(LINK_BY_ID), job_id)).alias("apply_url"),
        time_stamp(now).alias("scraped_at"),
    )


def inner_of_div(html: Column, div_id: str) -> Column:
    """Markup inside the div with the given id, up to the closing tag that balances it; empty without one."""
    element = outer_pieces(tag_pieces(html), F.lit(f"(?is)^{_opening('div', 'id', div_id)}"), F.lit(div_id.lower()))
    return F.coalesce(bound(element, lambda e: F.when(e.isNotNull(), markup_of(e))), F.lit(""))


def project_job_page(pages: DataFrame, description_chars: int | None = None) -> DataFrame:
    """Single job page: id from the link, text of the description block."""
    return pages.select(
        *[c for c in pages.columns if c != "html"],
        url_query_value(F.col("url"), "jk").alias("job_id"),
        cut(
            blank_to_null(html_to_text(inner_of_div(F.col("html"), "jobDescriptionText"))),
            description_chars,
        ).alias("description"),
    )
