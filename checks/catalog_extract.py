"""Checked queries: reading, normalising and text extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancia.functions import dates, money, phones, text
from vacancia.operators.clean import clean, filter_since
from vacancia.operators.contacts import first_company_rep, seed_contacts
from vacancia.operators.dedup import with_hash
from vacancia.operators.export import page, preview
from vacancia.operators.registry import guess_sites
from vacancia.operators.websites import candidate_pages, page_facts, website_contacts
from vacancia.schema import POSTINGS, conform
from vacancia.sources import listings, registers, result_pages, web_pages

from . import duck
from .fixtures import Inputs, with_views

QUERIES: dict = {}
AS_OF = "1998-06-01"


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``sql`` is its DuckDB counterpart over the named views."""
    def add(fn):
        QUERIES[name] = (fn, None if sql is None else (with_views(*views) + " " if views else "") + sql)
        return fn
    return add


POST = ("f_postings",)


def _packed(i: Inputs, shape) -> object:
    """One JSON message per customer holding its postings, as a landed capture would."""
    p = i.view("f_postings")
    item = F.struct(
        "job_id", "source", "title", "company", "location", F.col("salary_text"),
        F.concat(F.lit(" "), F.col("salary_min").cast("string")).alias("salary_min"),
        "requirements", F.col("ord").cast("string").alias("apply_url"), "scraped_at",
        F.struct(F.lit("ignored").alias("phone")).alias("contact"),
    )
    return p.groupBy("custkey").agg(F.collect_list(item).alias("jobs")).select("custkey", shape.alias("body"))


@query(
    "json_import",
    f"""SELECT CAST(ord AS VARCHAR) AS ref, job_id, source, {duck.strip('title')} AS title, company, salary_text, salary_min,
        CAST(len(requirements) AS INTEGER) AS n_requirements, scraped_at
        FROM f_postings WHERE job_id <> '' AND custkey % 5 <> 4""", POST)
def json_import(i):
    wrapped = F.to_json(F.struct("jobs"))
    bare = F.to_json(F.col("jobs"))
    broken = F.substring(wrapped, 1, 40)
    key = F.col("custkey") % 5
    body = F.when(key == 4, broken).when(key % 2 == 0, wrapped).otherwise(bare)
    rows = listings.parse_listing_text(_packed(i, body)).withColumn("ord", F.lit(0).cast("bigint"))
    good, _ = listings.split_rejects(listings.normalise(rows))
    return good.select(
        F.col("apply_url").alias("ref"), "job_id", "source", "title", "company", "salary_text", "salary_min",
        F.size("requirements").alias("n_requirements"), "scraped_at",
    )


@query(
    "normalise_import",
    f"""SELECT ord, 'J' || CAST(ord AS VARCHAR) AS job_id, CASE WHEN ord % 3 = 0 THEN 'extension' ELSE source END AS source,
        {duck.strip('title')} AS title, TRY_CAST(CASE WHEN ord % 9 = 0 THEN 'n/a' WHEN ord % 9 = 1 THEN '' ELSE CAST(price AS VARCHAR) END AS DOUBLE) AS salary_min,
        array_to_string(CASE WHEN ord % 2 = 0 THEN requirements ELSE [] END, '|') AS requirements,
        CASE WHEN ord % 5 = 0 THEN '2024-01-01T00:00:00Z' ELSE scraped_at END AS scraped_at FROM f_postings""", POST)
def normalise_import(i):
    p = i.view("f_postings")
    raw = p.select(
        "ord", F.concat(F.lit(" J"), F.col("ord").cast("string"), F.lit("\t")).alias("job_id"),
        F.when(F.col("ord") % 3 == 0, "").otherwise(F.col("source")).alias("source"), "title", "company",
        F.when(F.col("ord") % 9 == 0, "n/a").when(F.col("ord") % 9 == 1, "").otherwise(F.col("price").cast("string")).alias("salary_min"),
        F.when(F.col("ord") % 2 == 0, F.to_json("requirements")).otherwise(F.lit("not a list")).alias("requirements"),
        F.when(F.col("ord") % 5 != 0, F.col("scraped_at")).alias("scraped_at"),
        F.lit("x").alias("unknown_field"),
    )
    out = listings.normalise(raw, now=F.lit("2024-01-01T00:00:00Z"))
    return out.select(
        "ord", "job_id", "source", "title", "salary_min", F.array_join("requirements", "|").alias("requirements"), "scraped_at"
    )


@query(
    "reject_rows",
    """SELECT ord, CASE WHEN ord % 101 = 0 THEN 'missing_title' ELSE 'missing_job_id' END AS reject_reason
       FROM f_postings WHERE ord % 101 = 0 OR job_id = ''""", POST)
def reject_rows(i):
    p = i.view("f_postings").withColumn("title", F.when(F.col("ord") % 101 == 0, "  ").otherwise(F.col("title")))
    _, rejects = listings.split_rejects(listings.normalise(p))
    return rejects.select("ord", "reject_reason")


_LOW = "CASE ord % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(price % 40 + 9 AS DOUBLE) ELSE CAST(price AS DOUBLE) END"
_HIGH = "CASE ord % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(price % 40 + 9 AS DOUBLE) WHEN 2 THEN CAST(price AS DOUBLE) + 1500.5 END"
_PERIOD = f"CASE WHEN coalesce({_HIGH}, {_LOW}) < 1000 THEN 'hourly' WHEN coalesce({_HIGH}, {_LOW}) >= 1000 THEN 'annual' END"


def _api_pages(i):
    p = i.view("f_postings").withColumn("low", F.expr(_LOW)).withColumn("high", F.expr(_HIGH))
    item = F.struct(
        F.col("ord").alias("jobId"), F.trim("title").alias("jobTitle"), F.col("company").alias("employerName"),
        F.col("location").alias("locationName"), F.col("low").alias("minimumSalary"), F.col("high").alias("maximumSalary"),
        F.concat(F.lit("<p>About <b>"), F.col("name"), F.lit("</b> &amp; more</p><br/>")).alias("jobDescription"),
        F.when(F.col("ord") % 5 == 0, "soon").otherwise(
            F.date_format(F.to_date(F.substring("scraped_at", 1, 10)), "dd/MM/yyyy")).alias("date"),
        F.col("apply_url").alias("jobUrl"),
    )
    pages = p.groupBy("custkey").agg(F.collect_list(item).alias("results"))
    return pages.select(
        F.lit("nurse").alias("keyword"), F.lit("UK").alias("location"), F.col("custkey").alias("page_ord"),
        F.to_json(F.struct(F.size("results").alias("totalResults"), "results")).alias("body"),
    )


@query(
    "api_page_project",
    f"""SELECT CAST(ord AS VARCHAR) AS job_id, 'reed' AS source, trim(title) AS title, company, location,
        {duck.money_text(_LOW, _HIGH, _PERIOD)} AS salary_text, {_LOW} AS salary_min, {_HIGH} AS salary_max, {_PERIOD} AS salary_period,
        'About ' || name || ' & more' AS description,
        CASE WHEN ord % 5 = 0 THEN 'soon' ELSE substr(scraped_at, 1, 10) END AS posted_at, apply_url FROM f_postings""", POST)
def api_page_project(i):
    items = result_pages.explode_results(result_pages.parse_pages(_api_pages(i)))
    out = result_pages.project_items(items)
    return out.select(
        "job_id", "source", "title", "company", "location", "salary_text", "salary_min", "salary_max",
        "salary_period", "description", "posted_at", "apply_url",
    )


@query(
    "embedded_json_extract",
    """SELECT 'K' || CAST(ord AS VARCHAR) AS job_id, CASE WHEN ord % 2 = 0 THEN trim(title) ELSE 'Plain ' || name END AS title, company,
       coalesce(location, 'Town') AS location, nullif(salary_text, '') AS salary_text,
       CASE WHEN ord % 3 = 0 THEN CAST(price AS DOUBLE) WHEN ord % 3 = 1 THEN 12.5 END AS salary_min,
       CASE WHEN ord % 3 = 0 THEN CAST(price + 10 AS DOUBLE) END AS salary_max,
       CASE ord % 3 WHEN 0 THEN 'annual' WHEN 1 THEN 'hourly' END AS salary_period,
       CASE WHEN ord % 2 = 0 THEN 'full-time, permanent' END AS job_type, substr(scraped_at, 1, 10) AS posted_at,
       CASE WHEN ord % 2 = 0 THEN 'https://uk.indeed.com/rc/clk?jk=' || CAST(ord AS VARCHAR) ELSE 'https://uk.indeed.com/viewjob?jk=K' || CAST(ord AS VARCHAR) END AS apply_url,
       'Work at ' || name AS description FROM f_postings""", POST)
def embedded_json_extract(i):
    p = i.view("f_postings")
    even, third = F.col("ord") % 2 == 0, F.col("ord") % 3
    nothing = F.lit(None)
    item = F.struct(
        F.concat(F.lit("K"), F.col("ord").cast("string")).alias("jobkey"),
        F.when(even, F.trim("title")).alias("displayTitle"),
        F.concat(F.lit("Plain "), F.col("name")).alias("title"), "company",
        F.col("location").alias("formattedLocation"), F.lit("Town").alias("jobLocationCity"),
        F.struct(F.col("salary_text").alias("text")).alias("salarySnippet"),
        F.when(third == 0, F.struct(F.col("price").alias("min"), (F.col("price") + 10).alias("max"), F.lit("YEARLY").alias("type"))).alias("extractedSalary"),
        F.when(third == 1, F.struct(F.lit(12.5).alias("min"), nothing.cast("double").alias("max"), F.lit("HOURLY").alias("type"))).alias("estimatedSalary"),
        (F.unix_timestamp(F.to_timestamp("scraped_at")) * 1000 + 3600000).alias("pubDate"),
        F.when(even, F.array(F.lit("Full-Time"), F.lit("Permanent"))).alias("jobTypes"),
        F.concat(F.lit("<ul><li>Work at</li> <li>"), F.col("name"), F.lit("</li></ul>")).alias("snippet"),
        F.when(even, F.concat(F.lit("/rc/clk?jk="), F.col("ord").cast("string"))).alias("viewJobLink"),
    )
    grouped = p.groupBy("custkey").agg(F.collect_list(item).alias("results"))
    blob = F.to_json(F.struct(F.struct(F.struct("results").alias("mosaicProviderJobCardsModel")).alias("metaData")))
    html = F.concat(
        F.lit('<html><script>window.mosaic.providerData["mosaic-provider-jobcards"]='), blob,
        F.lit(";</script><body>x</body></html>"),
    )
    pages = grouped.select(F.col("custkey").alias("page_id"), html.alias("html"))
    out = web_pages.project_embedded(web_pages.embedded_items(pages))
    return out.select(
        "job_id", "title", "company", "location", "salary_text", "salary_min", "salary_max", "salary_period",
        "job_type", "posted_at", "apply_url", "description",
    )


def _ld_pages(i):
    """The supplied pages, each with a JSON-LD block of one of the four shapes, or a broken one."""
    def posting(tag):
        return F.struct(
            F.lit("JobPosting").alias("@type"),
            F.struct(F.concat(F.lit(tag), F.col("page_id").cast("string")).alias("value")).alias("identifier"),
            F.col("url").alias("url"),
        )

    one, two = posting("a"), posting("b")
    shape = F.col("page_id") % 5
    org = F.struct(F.lit("Organization").alias("@type"), F.lit("x").alias("name"))
    block = (
        F.when(shape == 0, F.to_json(one))
        .when(shape == 1, F.to_json(F.array(one, two)))
        .when(shape == 2, F.to_json(F.struct(
            F.lit("ItemList").alias("@type"),
            F.array(F.struct(F.lit(1).alias("position"), one.alias("item")), F.struct(F.lit(2).alias("position"), two.alias("item"))).alias("itemListElement"))))
        .when(shape == 3, F.to_json(F.struct(F.array(F.to_json(org), F.to_json(one)).alias("@graph"))))
        .otherwise(F.concat(F.to_json(one), F.lit("}{")))
    )
    # @graph holds unlike objects, so its text is put together rather than built as one struct.
    graph = F.concat(F.lit('{"@graph":['), F.to_json(org), F.lit(","), F.to_json(one), F.lit("]}"))
    block = F.when(shape == 3, graph).otherwise(block)
    script = F.concat(F.lit('<script type="application/ld+json">'), block, F.lit("</script></head>"))
    return i.table("pages").withColumn("html", F.replace("html", F.lit("</head>"), script))


@query(
    "jsonld_extract",
    """SELECT page_id, t || CAST(page_id AS VARCHAR) AS job_id, url AS apply_url FROM pages,
       (SELECT unnest(['a', 'b']) AS t) x WHERE page_id % 5 <> 4 AND (t = 'a' OR page_id % 5 IN (1, 2))""")
def jsonld_extract(i):
    found = web_pages.find_jobpostings(_ld_pages(i).select("page_id", "html"))
    out = web_pages.project_jobposting(found, "ld")
    return out.select("page_id", "job_id", "apply_url")


_POSTING_LOW = "CASE ord % 3 WHEN 0 THEN CAST(price AS DOUBLE) WHEN 1 THEN 12.5 END"
_POSTING_HIGH = "CASE ord % 3 WHEN 0 THEN CAST(price + 100 AS DOUBLE) WHEN 1 THEN 12.5 END"
_POSTING_PERIOD = "CASE ord % 3 WHEN 0 THEN 'annual' WHEN 1 THEN 'hourly' END"


@query(
    "jobposting_project",
    f"""SELECT ord, CASE ord % 3 WHEN 0 THEN 'V' || CAST(ord AS VARCHAR) WHEN 1 THEN 'S' || CAST(ord AS VARCHAR) ELSE CAST(ord AS VARCHAR) END AS job_id,
        trim(title) AS title, company, CASE WHEN ord % 2 = 0 THEN 'https://c.example.org' END AS company_url,
        CASE WHEN ord % 2 = 0 THEN name || ', LS1 3AB' ELSE name || ', West, LS1 3AB' END AS location, name AS location_city,
        CASE WHEN ord % 3 < 2 THEN {duck.money_text(_POSTING_LOW, _POSTING_HIGH, _POSTING_PERIOD, "CASE WHEN ord % 4 = 3 THEN 'EUR ' ELSE '£' END")} END AS salary_text,
        {_POSTING_LOW} AS salary_min, {_POSTING_HIGH} AS salary_max, {_POSTING_PERIOD} AS salary_period,
        CASE WHEN ord % 2 = 0 THEN 'full_time, contractor' ELSE 'part_time' END AS job_type, 'Role at ' || name AS description,
        CASE WHEN ord % 2 = 0 THEN 'degree|driving|tact' ELSE 'first line|second line' END AS requirements,
        CASE WHEN ord % 2 = 0 THEN 'pension' ELSE '' END AS benefits,
        scraped_at AS posted_at, 'https://x.example.org/jobs/' || CAST(ord AS VARCHAR) || '/' AS apply_url FROM f_postings""", POST)
def jobposting_project(i):
    p = i.view("f_postings").withColumn("low", F.expr(_POSTING_LOW)).withColumn("high", F.expr(_POSTING_HIGH))
    key = F.col("ord").cast("string")
    even, third = F.col("ord") % 2 == 0, F.col("ord") % 3

    def js(*cols):
        return F.to_json(F.struct(*cols))

    town, code = F.col("name").alias("addressLocality"), F.lit("LS1 3AB").alias("postalCode")
    region = F.when(~even, "West").alias("addressRegion")
    address = F.struct(F.struct(town, region, code).alias("address"))
    common = js(
        F.trim("title").alias("title"), F.concat(F.lit("https://x.example.org/jobs/"), key, F.lit("/")).alias("url"),
        F.struct(F.col("company").alias("name"), F.when(even, "https://c.example.org").alias("sameAs")).alias("hiringOrganization"),
        F.when(F.col("ord") % 4 == 3, "EUR").alias("salaryCurrency"),
        F.concat(F.lit("<p>Role at</p>\n<p>"), F.col("name"), F.lit("</p>")).alias("description"),
        F.col("scraped_at").alias("datePosted"),
    )
    # Fields whose JSON type differs between rows are appended as text.
    parts = F.concat_ws(
        ",",
        F.regexp_replace(common, r"\}$", ""),
        F.when(third == 0, F.concat(F.lit('"identifier":{"value":"V'), key, F.lit('"}')))
        .when(third == 1, F.concat(F.lit('"identifier":"S'), key, F.lit('"'))),
        F.concat(F.lit('"jobLocation":'), F.when(even, F.to_json(F.array(address))).otherwise(F.to_json(address))),
        F.when(third == 0, F.concat(F.lit('"baseSalary":{"value":{"minValue":'), F.col("low").cast("string"),
               F.lit(',"maxValue":"'), F.col("high").cast("string"), F.lit('","unitText":"MONTH"}}')))
        .when(third == 1, F.lit('"baseSalary":{"value":12.5,"unitText":"per HOUR"}')),
        F.when(even, F.lit('"employmentType":["FULL_TIME","CONTRACTOR"]')).otherwise(F.lit('"employmentType":"PART_TIME"')),
        F.when(even, F.lit('"qualifications":["degree","",null],"skills":" driving \\n\\ntact"'))
        .otherwise(F.lit('"experienceRequirements":"first line\\r\\n second line"')),
        F.when(even, F.lit('"jobBenefits":["pension",""]')),
    )
    rows = p.select("ord", F.concat(parts, F.lit("}")).alias("posting"))
    out = web_pages.project_jobposting(rows, "ld")
    return out.select(
        "ord", "job_id", "title", "company", "company_url", "location", "location_city", "salary_text", "salary_min",
        "salary_max", "salary_period", "job_type", "description", F.array_join("requirements", "|").alias("requirements"),
        F.array_join("benefits", "|").alias("benefits"), "posted_at", "apply_url",
    )


@query(
    "card_extract",
    f"""SELECT 'J' || CAST(ord AS VARCHAR) AS job_id, {duck.squeeze("CASE WHEN ord % 7 = 0 THEN 'Unknown' ELSE title END")} AS title, company,
        location, CASE WHEN ord % 2 = 0 THEN nullif(salary_text, '') END AS salary_text,
        'https://uk.indeed.com/viewjob?jk=J' || CAST(ord AS VARCHAR) AS apply_url FROM f_postings""", POST)
def card_extract(i):
    p = i.columns("f_postings", "ord", "custkey", "title", "company", "location", "salary_text")
    third = F.col("ord") % 3
    heading = (
        F.when(F.col("ord") % 7 == 0, F.lit(""))
        .when(third == 0, F.concat(F.lit('<h2 class="jobTitle"><a><span title="'), F.trim("title"), F.lit('">short</span></a></h2>')))
        .when(third == 1, F.concat(F.lit('<h2 class="x jobTitle y">'), F.col("title"), F.lit("</h2>")))
        .otherwise(F.concat(F.lit('<div data-testid="jobTitle">'), F.col("title"), F.lit("</div>")))
    )
    def tag(attrs, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"<span {attrs}>"), value, F.lit("</span>"))).otherwise(F.lit(""))

    employer = F.when(third == 0, tag('data-testid="company-name"', F.col("company"))).when(
        third == 1, tag('class="companyName"', F.col("company"))
    ).otherwise(F.concat(F.lit('<span data-testid="company-name"> </span>'), tag('class="zz company-name"', F.col("company"))))
    pay = F.when(F.col("ord") % 2 == 0, tag('class="salary-snippet-container"', F.col("salary_text"))).otherwise(F.lit(""))
    card = F.concat(
        F.lit('<div class="card" data-jk="J'), F.col("ord").cast("string"), F.lit('">'), heading, employer,
        tag('data-testid="text-location"', F.col("location")), pay, F.lit("</div>"),
    )
    pages = p.groupBy("custkey").agg(
        F.concat(F.lit("<html><body>"), F.array_join(F.collect_list(card), "\n"), F.lit("</body></html>")).alias("html")
    )
    out = web_pages.project_cards(web_pages.card_rows(pages))
    return out.select(
        "job_id", text.squeeze(F.col("title")).alias("title"), "company", "location", "salary_text", "apply_url"
    )


@query(
    "job_page_extract",
    f"""SELECT page_id, 'P' || CAST(page_id AS VARCHAR) AS job_id,
        nullif({duck.text_of("regexp_extract(html, '(?is)<article>(.*?)</article>', 1)")}, '') AS description FROM pages""")
def job_page_extract(i):
    body = F.regexp_extract("html", r"(?is)<article>(.*?)</article>", 1)
    nested = F.concat(F.lit('<body><div id="jobDescriptionText"><div>'), body, F.lit("</div></div><div>apply</div></body>"))
    pages = i.table("pages").select(
        "page_id", F.concat(F.lit("https://uk.indeed.com/viewjob?from=x&jk=P"), F.col("page_id").cast("string"), F.lit("#top")).alias("url"),
        nested.alias("html"),
    )
    return web_pages.project_job_page(pages).select("page_id", "job_id", "description")


@query(
    "search_sweep",
    """WITH landed AS (SELECT p_type AS keyword, r_name AS location, l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey
         JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
       k AS (SELECT DISTINCT p_type AS keyword FROM part UNION SELECT 'never landed'), l AS (SELECT r_name AS location FROM region)
       SELECT k.keyword, l.location, count(l_orderkey) AS n FROM k CROSS JOIN l
       LEFT JOIN landed ON landed.keyword = k.keyword AND landed.location = l.location GROUP BY ALL""")
def search_sweep(i):
    landed = i.sql("""SELECT p_type AS keyword, r_name AS location, l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey
        JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
    keywords = i.sql("SELECT DISTINCT p_type AS keyword FROM part UNION SELECT 'never landed'")
    swept = registers.search_sweep(keywords, i.table("region").select(F.col("r_name").alias("location")), landed)
    return swept.groupBy("keyword", "location").agg(F.count("l_orderkey").alias("n"))


@query("source_filter", "SELECT ord, source FROM f_postings WHERE source IN ('job_feed', 'reed')", POST)
def source_filter(i):
    return i.view("f_postings").where(registers.source_filter(F.col("source"), ["jobfeed", "reed"])).select("ord", "source")


@query(
    "topn_per_keyword",
    """SELECT ord, source, location FROM f_postings
       QUALIFY row_number() OVER (PARTITION BY source, location ORDER BY ord) <= 50""", POST)
def topn_per_keyword(i):
    return result_pages.top_n(i.view("f_postings"), 50, ["source", "location"]).select("ord", "source", "location")


@query(
    "newest_per_source",
    """SELECT ord, source, posted_at FROM f_postings WHERE posted_at LIKE '____-%'
       QUALIFY row_number() OVER (PARTITION BY source ORDER BY CAST(posted_at AS TIMESTAMPTZ) DESC, ord) <= 20""", POST)
def newest_per_source(i):
    p = i.view("f_postings").withColumn("ts", dates.parse_iso(F.col("posted_at"))).where("ts IS NOT NULL")
    ranked = p.withColumn("age", F.struct((-F.unix_micros("ts")).alias("t"), "ord"))
    return result_pages.top_n(ranked, 20, ["source"], "age").select("ord", "source", "posted_at")


@query(
    "detail_upgrade",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY source, location ORDER BY ord) AS rn FROM f_postings)
       SELECT ord, job_id,
         CASE WHEN rn <= 20 AND job_id <> '' AND ord % 3 = 0 THEN 'Full text for ' || name ELSE description END AS description,
         CASE WHEN rn <= 20 AND job_id <> '' AND ord % 3 = 0 THEN CASE ord % 4 WHEN 0 THEN 'full-time' WHEN 1 THEN 'part-time, contract' WHEN 2 THEN 'full-time, temporary' ELSE 'part-time, permanent' END ELSE job_type END AS job_type,
         CASE WHEN rn <= 20 AND job_id <> '' AND ord % 3 = 0 THEN CASE WHEN ord % 2 = 0 THEN 'hourly' ELSE 'annual' END ELSE salary_period END AS salary_period,
         CASE WHEN company_url IS NULL AND rn <= 20 AND job_id <> '' AND ord % 3 = 0 THEN 'https://ext/' || CAST(ord AS VARCHAR) ELSE company_url END AS company_url
       FROM r""".replace("WITH r", ", r"), POST)
def detail_upgrade(i):
    p = i.view("f_postings")
    m = F.col("ord") % 4
    details = p.where((F.col("ord") % 3 == 0) & (F.col("job_id") != "")).select(
        F.col("job_id").alias("jobId"),
        F.concat(F.lit("<b>Full text</b> for <i>"), F.col("name"), F.lit("</i>")).alias("jobDescription"),
        F.when(m == 0, "Full-time").when(m == 1, "Contract").when(m == 2, "Temporary").otherwise("Permanent").alias("contractType"),
        (m % 2 == 0).alias("fullTime"), (m % 2 == 1).alias("partTime"),
        F.when(m % 2 == 0, "per hour").otherwise("per annum").alias("salaryType"),
        F.concat(F.lit("https://ext/"), F.col("ord").cast("string")).alias("externalUrl"),
    )
    out = result_pages.upgrade_details(p, details, 20, ["source", "location"])
    return out.select("ord", "job_id", "description", "job_type", "salary_period", "company_url")


@query(
    "norm_name",
    f"""SELECT doc_id, md5({duck.norm('text')}) AS norm_text, {duck.norm("x.name || ' ltd uk Limited'")} AS norm_company
        FROM documents JOIN f_docs x ON dk = doc_id""", ("f_docs",))
def norm_name(i):
    j = i.table("documents").join(i.view("f_docs"), F.col("dk") == F.col("doc_id"))
    return j.select(
        "doc_id", F.md5(text.norm_name(F.col("text"))).alias("norm_text"),
        text.norm_name(F.concat("name", F.lit(" ltd uk Limited"))).alias("norm_company"),
    )


@query("content_hash", f"SELECT ord, {duck.content_hash()} AS hash FROM f_postings", POST)
def content_hash(i):
    return with_hash(i.view("f_postings")).select("ord", "hash")


@query(
    "since_filter",
    f"""SELECT ord, posted_at FROM f_postings WHERE posted_at IS NULL OR posted_at NOT LIKE '____-%'
        OR CAST(posted_at AS TIMESTAMPTZ) >= TIMESTAMPTZ '{AS_OF} 00:00:00+00' - INTERVAL 400 DAY""", POST)
def since_filter(i):
    as_of = F.to_timestamp(F.lit(f"{AS_OF} 00:00:00"))
    return filter_since(i.view("f_postings"), 400, as_of).select("ord", "posted_at")


@query(
    "resume_anti",
    f"""SELECT ord FROM f_postings WHERE {duck.content_hash()} NOT IN (SELECT {duck.content_hash()} FROM f_postings WHERE source = 'reed')""", POST)
def resume_anti(i):
    p = with_hash(i.view("f_postings"))
    return registers.resume(p, registers.seen_keys(p.where(F.col("source") == "reed"))).select("ord")


@query("seen_hashes", f"SELECT DISTINCT {duck.content_hash()} AS hash FROM f_postings", POST)
def seen_hashes(i):
    return registers.seen_hashes(with_hash(i.view("f_postings")))


_CITY = f"CASE WHEN coalesce(location_city, '') <> '' THEN location_city ELSE {duck.city('location')} END"


@query(
    "clean_location",
    f"""SELECT ord, {_CITY} AS location_city, coalesce(location_postcode, {duck.postcode('location')}) AS location_postcode,
        CASE WHEN coalesce(location_city, '') = '' AND {duck.city('location')} IS NOT NULL THEN 'derived' END AS city_origin
        FROM f_postings""", POST)
def clean_location(i):
    out = clean(conform(i.view("f_postings"), POSTINGS))
    return out.select(
        "ord", "location_city", "location_postcode", F.array_join(F.col("field_sources")["location_city"], "|").alias("city_origin")
    )


_S = duck.salary()
_RE = "(coalesce(salary_text, '') <> '' AND coalesce(salary_min, 0) = 0)"


@query(
    "clean_salary",
    f"""SELECT ord, CASE WHEN {_RE} THEN coalesce({_S['min']}, salary_min) ELSE salary_min END AS salary_min,
        CASE WHEN {_RE} THEN coalesce({_S['max']}, salary_max) ELSE salary_max END AS salary_max,
        CASE WHEN coalesce(salary_period, '') = '' AND {_RE} THEN {_S['period']} ELSE salary_period END AS salary_period FROM f_postings""", POST)
def clean_salary(i):
    return clean(conform(i.view("f_postings"), POSTINGS)).select("ord", "salary_min", "salary_max", "salary_period")


@query(
    "salary_ld",
    """SELECT ord, CASE ord % 5 WHEN 0 THEN CAST(price AS DOUBLE) WHEN 1 THEN 12.5 END AS lo,
       CASE ord % 5 WHEN 0 THEN CAST(price + 5 AS DOUBLE) WHEN 1 THEN 12.5 END AS hi,
       CASE ord % 5 WHEN 0 THEN 'annual' WHEN 1 THEN 'hourly' WHEN 2 THEN 'annual' END AS period FROM f_postings""", POST)
def salary_ld(i):
    m, price = F.col("ord") % 5, F.col("price").cast("string")
    obj = (
        F.when(m == 0, F.concat(F.lit('{"value":{"minValue":'), price, F.lit(',"maxValue":"'), (F.col("price") + 5).cast("string"), F.lit('","unitText":"Year"}}')))
        .when(m == 1, F.lit('{"value":12.5,"unitText":"HOUR"}'))
        .when(m == 2, F.lit('{"value":{"minValue":"lots","maxValue":5,"unitText":"MONTHLY"}}'))
        .when(m == 3, F.lit('{"value":{"minValue":0}}'))
    )
    s = i.columns("f_postings", "ord", "price").select("ord", web_pages.salary_of(obj).alias("s"))
    return s.select("ord", F.col("s.min").alias("lo"), F.col("s.max").alias("hi"), F.col("s.period").alias("period"))


@query(
    "salary_render",
    f"SELECT ord, {duck.money_text(_LOW, _HIGH, _PERIOD)} AS salary_text FROM f_postings", POST)
def salary_render(i):
    return i.view("f_postings").select(
        "ord", money.render_salary(F.expr(_LOW), F.expr(_HIGH), F.expr(_PERIOD)).alias("salary_text")
    )


@query(
    "date_normalise",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN '31/02/2024' WHEN 2 THEN 'today' END AS iso_day,
       strftime(o_orderdate, '%Y-%m-%d') AS from_epoch,
       CASE o_orderkey % 4 WHEN 0 THEN epoch_ms(o_orderdate) WHEN 1 THEN epoch_ms(o_orderdate) + 34200000 WHEN 2 THEN epoch_ms(o_orderdate) - 3600000 END AS parsed_ms FROM orders""")
def date_normalise(i):
    m, day = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(m == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(m == 1, "31/02/2024").when(m == 2, "today").otherwise("")
    iso = F.when(m == 0, day).when(m == 1, F.concat(day, F.lit("T09:30:00Z"))).when(
        m == 2, F.concat(day, F.lit("T00:00:00+01:00"))).otherwise("3 days ago")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return i.table("orders").select(
        "o_orderkey", dates.dmy_to_iso(raw).alias("iso_day"), dates.epoch_ms_to_date(ms.cast("string")).alias("from_epoch"),
        F.unix_millis(dates.parse_iso(iso)).alias("parsed_ms"),
    )


@query(
    "job_type",
    """SELECT o_orderkey, nullif(concat_ws(', ', CASE WHEN o_orderkey % 2 = 0 THEN 'full-time' END, CASE WHEN o_orderkey % 3 = 0 THEN 'part-time' END,
       CASE o_orderkey % 5 WHEN 0 THEN 'permanent' WHEN 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'full-time' END END), '') AS job_type FROM orders""")
def job_type(i):
    k = F.col("o_orderkey")
    contract = F.when(k % 5 == 0, "Permanent").when(k % 5 == 1, "Full-Time").when(k % 5 == 2, "")
    return i.table("orders").select(
        "o_orderkey", result_pages.compose_job_type(k % 2 == 0, F.when(k % 3 == 0, True), contract).alias("job_type")
    )


@query(
    "extract_emails",
    f"""SELECT ord, string_agg(v, '|' ORDER BY pos) AS emails FROM (SELECT ord, v, min(pos) AS pos FROM
        ({duck.mined('f_ads', 'ord', 'description', 'email')}) m GROUP BY ord, v) g GROUP BY ord""", ("f_ads",))
def extract_emails(i):
    found = i.view("f_ads").select("ord", text.extract_emails(F.col("description")).alias("e"))
    return found.where(F.size("e") > 0).select("ord", F.array_join("e", "|").alias("emails"))


@query(
    "extract_phones",
    f"""SELECT ord, string_agg(v, '|' ORDER BY pos) AS phones FROM (SELECT ord, v, min(pos) AS pos FROM
        ({duck.mined('f_ads', 'ord', 'description', 'phone')}) m GROUP BY ord, v) g GROUP BY ord""", ("f_ads",))
def extract_phones(i):
    found = i.view("f_ads").select("ord", phones.extract_phones(F.col("description")).alias("p"))
    return found.where(F.size("p") > 0).select("ord", F.array_join("p", "|").alias("phones"))


_RAW_MAIL = "CASE ord % 6 WHEN 0 THEN '  HR@D' || CAST(dk AS string) || '.Org ' WHEN 1 THEN 'logo@2x.PNG' WHEN 2 THEN 'No-Reply@x.org' WHEN 3 THEN 'a@b.co trailing words' WHEN 4 THEN 'not mail' END"


@query("clean_email", f"SELECT ord, {duck.clean_email('(' + _RAW_MAIL + ')')} AS email FROM f_postings", POST)
def clean_email(i):
    return i.view("f_postings").select("ord", text.clean_email(F.expr(_RAW_MAIL)).alias("email"))


_RAW_PHONE = (
    "CASE ord % 8 WHEN 0 THEN '020 7946 ' || lpad(CAST(ord % 10000 AS string), 4, '0') WHEN 1 THEN '0044 7700 900' || lpad(CAST(ord % 1000 AS string), 3, '0') "
    "WHEN 2 THEN '01632-9' || lpad(CAST(ord % 100000 AS string), 5, '0') WHEN 3 THEN '012.345678901' WHEN 4 THEN '0121 496 ' || lpad(CAST(ord % 10000 AS string), 4, '0') "
    "WHEN 5 THEN '0800 ' || lpad(CAST(ord % 1000000 AS string), 6, '0') WHEN 6 THEN '0999' END"
)


@query("clean_phone", f"SELECT ord, {duck.clean_phone('(' + _RAW_PHONE + ')')} AS phone FROM f_postings", POST)
def clean_phone(i):
    return i.view("f_postings").select("ord", phones.clean_phone(F.expr(_RAW_PHONE)).alias("phone"))


@query(
    "html_to_text",
    f"SELECT page_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5 FROM (SELECT page_id, {duck.text_of('html')} AS t FROM pages) q")
def html_to_text(i):
    t = i.table("pages").select("page_id", text.html_to_text(F.col("html")).alias("t"))
    return t.select("page_id", F.length("t").alias("n_chars"), F.md5("t").alias("text_md5"))


@query(
    "blocked_pages",
    """SELECT page_id, url FROM pages WHERE regexp_matches(lower(regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1)),
       'captcha|robot|blocked|verify|security|access denied|just a moment|attention required') OR page_id % 9 = 0""")
def blocked_pages(i):
    marked = F.when(F.col("page_id") % 9 == 0, F.replace("html", F.lit("<title>"), F.lit("<title>Just a moment... "))).otherwise(F.col("html"))
    return i.table("pages").where(text.is_blocked(marked)).select("page_id", "url")


@query(
    "address_compose",
    """SELECT cand_ord, concat_ws(', ', nullif(premises, ''), nullif(line1, ''), nullif(town, ''), nullif(code, ''), 'UK') AS address FROM f_register""",
    ("f_register",))
def address_compose(i):
    from vacancia.operators.registry import register_address
    none = F.lit(None).cast("string")
    addr = F.struct(
        "premises", F.col("line1").alias("address_line_1"), none.alias("address_line_2"), F.col("town").alias("locality"),
        F.lit("").alias("region"), F.col("code").alias("postal_code"), F.lit("UK").alias("country"))
    return i.view("f_register").withColumn("a", addr).select("cand_ord", register_address(F.col("a")).alias("address"))


_AT = f"strpos(description, regexp_extract(description, '{duck.POSTCODE}'))"


@query(
    "address_context",
    f"""SELECT ord, substr({duck.squeeze(f"substr(description, greatest(hit - 100, 1), hit - greatest(hit - 100, 1) + n + 20)")}, 1, 200) AS address
        FROM (SELECT ord, description, {_AT} AS hit, length(regexp_extract(description, '{duck.POSTCODE}')) AS n FROM f_ads) q WHERE n > 0""",
    ("f_ads",))
def address_context(i):
    out = i.view("f_ads").select("ord", text.address_near_postcode(F.col("description")).alias("address"))
    return out.where("address IS NOT NULL")


_PERSON = r"(?i)(?:contact|speak to|talk to|email)\s+([A-Z][a-z]+ [A-Z][a-z]+)|([A-Z][a-z]+ [A-Z][a-z]+)[,\s]+(?:HR|Recruitment|People|Hiring|Manager|Director)"


@query(
    "contact_person",
    f"""SELECT ord, p AS person FROM (SELECT ord, coalesce(nullif(regexp_extract(description, '{_PERSON}', 1), ''),
        nullif(regexp_extract(description, '{_PERSON}', 2), '')) AS p FROM f_ads) q WHERE p IS NOT NULL""", ("f_ads",))
def contact_person(i):
    return i.view("f_ads").select("ord", text.contact_person(F.col("description")).alias("person")).where("person IS NOT NULL")


def _seed_cte(source: str = "f_ads", where: str = "company IS NOT NULL AND coalesce(description, '') <> ''", name: str = "seed") -> str:
    """CTE ``name(company, phones[], emails[])``: values in order of first (ord, pos)."""
    src = f"(SELECT * FROM {source} WHERE {where})"
    parts = []
    for kind in ("phone", "email"):
        rows = duck.mined(src, "company", "description", kind, "ord,")
        parts.append(
            f"{name}_{kind} AS (SELECT company, list(v ORDER BY o, p) AS vals FROM (SELECT company, v, "
            f"arg_min(ord, ord * 100000 + pos) AS o, arg_min(pos, ord * 100000 + pos) AS p FROM ({rows}) m GROUP BY company, v) g GROUP BY company)"
        )
    return (
        ", ".join(parts) + f", {name} AS (SELECT coalesce(a.company, b.company) AS company, coalesce(a.vals, []) AS phones, "
        f"coalesce(b.vals, []) AS emails FROM {name}_phone a FULL JOIN {name}_email b ON a.company = b.company)"
    )


@query(
    "seed_contacts",
    ", " + _seed_cte() + " SELECT company, array_to_string(phones, '|') AS phones, array_to_string(emails, '|') AS emails FROM seed", ("f_ads",))
def seed_contacts_q(i):
    s = seed_contacts(i.view("f_ads"))
    return s.select("company", F.array_join("phone_numbers", "|").alias("phones"), F.array_join("emails", "|").alias("emails"))


@query(
    "first_company_rep",
    "SELECT company, company_url, location FROM f_postings WHERE company IS NOT NULL QUALIFY row_number() OVER (PARTITION BY company ORDER BY ord) = 1", POST)
def first_company_rep_q(i):
    return first_company_rep(i.view("f_postings"))


@query(
    "email_priority",
    """SELECT company, array_to_string(list_concat(list_filter(emails, lambda e: regexp_matches(e, '(?i)^(hr|recruitment|jobs|careers|talent|people)@')),
       list_filter(emails, lambda e: NOT regexp_matches(e, '(?i)^(hr|recruitment|jobs|careers|talent|people)@'))), '|') AS emails, priority FROM f_parts""", ("f_parts",))
def email_priority(i):
    return i.view("f_parts").select("company", F.array_join(text.emails_by_priority(F.col("emails")), "|").alias("emails"), "priority")


@query(
    "site_guess",
    """SELECT c.company, min(u.pos || '#' || u.url)[3:] AS company_url FROM (SELECT company, regexp_replace(lower(company), '[^\\p{L}\\p{N}_]', '', 'g') AS slug FROM f_companies) c,
       LATERAL (SELECT '1' AS pos, 'https://www.' || slug || '.org.uk' AS url UNION ALL SELECT '2', 'https://' || slug || '.com') u
       WHERE length(slug) % 3 <> 2 AND (u.pos = '1' OR length(slug) % 3 >= 0) AND (u.pos = '2' OR length(slug) % 3 = 0) GROUP BY c.company""", ("f_companies",))
def site_guess(i):
    c = i.view("f_companies")
    slug = F.regexp_replace(F.lower("company"), r"[^\p{L}\p{N}_]", "")
    n = F.length(slug) % 3
    known = c.select(F.explode(F.array_compact(F.array(
        F.when(n == 0, F.concat(F.lit("https://www."), slug, F.lit(".org.uk"))),
        F.when(n != 2, F.concat(F.lit("https://"), slug, F.lit(".com"))),
    ))).alias("url"))
    return guess_sites(c, known, text.site_candidates(F.col("company")))


@query(
    "page_candidates",
    """SELECT company, CAST(pos AS INTEGER) AS page_ord, url FROM (SELECT DISTINCT company_url AS company, company_url FROM f_postings WHERE company_url IS NOT NULL) c,
       LATERAL (SELECT 0 AS pos, company_url AS url UNION ALL SELECT 1, company_url || '/contact' UNION ALL SELECT 2, company_url || '/contact-us'
       UNION ALL SELECT 3, company_url || '/about' UNION ALL SELECT 4, company_url || '/about-us' UNION ALL SELECT 5, company_url || '/team'
       UNION ALL SELECT 6, company_url || '/our-team' UNION ALL SELECT 7, company_url || '/staff') u""", POST)
def page_candidates_q(i):
    c = i.view("f_postings").where("company_url IS NOT NULL").select(
        F.col("company_url").alias("company"), F.concat("company_url", F.lit("/")).alias("company_url")).distinct()
    return candidate_pages(c).select("company", "page_ord", F.regexp_replace("url", "/$", "").alias("url"))


@query(
    "link_ids",
    """SELECT ord, CAST(ord AS VARCHAR) AS tail, CAST(ord AS VARCHAR) AS query_id, 'https://h.example.org/p/' || CAST(ord AS VARCHAR) AS link
       FROM f_postings WHERE apply_url IS NOT NULL""", POST)
def link_ids(i):
    key = F.col("ord").cast("string")
    p = i.view("f_postings").where("apply_url IS NOT NULL")
    return p.select(
        "ord", text.url_tail(F.col("apply_url")).alias("tail"),
        text.url_query_value(F.concat(F.lit("https://x/view?a=1&jk="), key, F.lit("&b=2#jk=9")), "jk").alias("query_id"),
        text.absolute_link(F.concat(F.lit("/p/"), key), "https://h.example.org", F.lit(None).cast("string")).alias("link"),
    )


@query(
    "request_render",
    """SELECT ord, 'Title: ' || coalesce(nullif(title, ''), 'Unknown') || '; company: ' || coalesce(company, 'Unknown') || '; text: '
       || coalesce(nullif(description, ''), 'Unknown') AS prompt FROM f_postings""", POST)
def request_render(i):
    return i.view("f_postings").select("ord", text.request_text(
        "Title: {title}; company: {company}; text: {description}", title=F.col("title"), company=F.col("company"),
        description=F.col("description")).alias("prompt"))


@query(
    "json_repair",
    """SELECT ord, CASE WHEN ord % 4 < 3 THEN '020 ' || CAST(ord AS VARCHAR) END AS phone,
       CASE WHEN ord % 4 < 3 THEN 'high' END AS confidence FROM f_postings""", POST)
def json_repair(i):
    body = F.to_json(F.struct(F.concat(F.lit("020 "), F.col("ord").cast("string")).alias("phone"), F.lit("high").alias("confidence"),
                              F.struct(F.lit("{x}").alias("deep")).alias("notes")))
    m = F.col("ord") % 4
    raw = F.when(m == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(
        m == 1, F.concat(F.lit("Sure, here it is: "), body, F.lit(" hope it helps"))).when(m == 2, body).otherwise("{broken")
    r = i.view("f_postings").select("ord", registers.parse_response(raw, "phone string, confidence string").alias("r"))
    return r.select("ord", "r.phone", "r.confidence")


@query(
    "literal_guard",
    """SELECT ord, CASE WHEN contains(description, phone) OR contains(description, replace(phone, ' ', '')) THEN phone END AS phone,
       CASE WHEN contains(lower(description), email) THEN email END AS email
       FROM (SELECT ord, description, '020 7946 ' || lpad(CAST((ord - ord % 5) % 10000 AS VARCHAR), 4, '0') AS phone,
             'hr@d' || CAST(dk AS VARCHAR) || '.co.uk' AS email FROM f_postings) q""", POST)
def literal_guard(i):
    p = i.columns("f_postings", "ord", "description", "dk").withColumn(
        "phone", F.concat(F.lit("020 7946 "), F.lpad(((F.col("ord") - F.col("ord") % 5) % 10000).cast("string"), 4, "0"))
    ).withColumn("email", F.concat(F.lit("hr@d"), F.col("dk").cast("string"), F.lit(".co.uk")))
    phone, email = registers.literal_guard(F.col("description"), F.col("phone"), F.col("email"))
    return p.select("ord", phone.alias("phone"), email.alias("email"))


@query(
    "trusted_value",
    f"""SELECT ord, CASE WHEN raw IS NULL OR raw IN ('', 'null') THEN NULL ELSE coalesce(cleaned, CASE WHEN conf <> 'low' THEN raw END) END AS phone FROM
        (SELECT ord, raw, conf, {duck.clean_phone('raw')} AS cleaned FROM (SELECT ord, CASE ord % 4 WHEN 0 THEN '020 7946 0958' WHEN 1 THEN 'null' WHEN 2 THEN 'ask reception' END AS raw,
         CASE WHEN ord % 3 = 0 THEN 'high' ELSE 'low' END AS conf FROM f_postings) a) b""", POST)
def trusted_value(i):
    m = F.col("ord") % 4
    raw = F.when(m == 0, "020 7946 0958").when(m == 1, "null").when(m == 2, "ask reception")
    conf = F.when(F.col("ord") % 3 == 0, "high")
    return i.view("f_postings").select("ord", registers.trusted_value(phones.clean_phone(raw), raw, conf).alias("phone"))


@query("budget_topn", """, seeded AS (SELECT DISTINCT company FROM f_postings WHERE contains(description, '@'))
   SELECT ord, title FROM f_postings WHERE coalesce(description, '') <> '' AND NOT (company IS NOT NULL AND company IN (SELECT company FROM seeded WHERE company IS NOT NULL) AND len(requirements) > 0 AND len(benefits) > 0)
   AND (len(requirements) = 0 OR len(benefits) = 0 OR company IS NOT NULL) ORDER BY ord LIMIT 30""", POST)
def budget_topn(i):
    p = i.view("f_postings")
    seeded = p.where(F.contains("description", F.lit("@")) & F.col("company").isNotNull()).select("company").distinct()
    return registers.parse_candidates(p, seeded).orderBy("ord").limit(30).select("ord", "title")


@query("parse_candidates", """, seeded AS (SELECT DISTINCT company FROM f_postings WHERE contains(description, '@'))
   SELECT ord FROM f_postings WHERE coalesce(description, '') <> '' AND (len(requirements) = 0 OR len(benefits) = 0
     OR (company IS NOT NULL AND company NOT IN (SELECT company FROM seeded WHERE company IS NOT NULL)))""", POST)
def parse_candidates(i):
    p = i.view("f_postings")
    seeded = p.where(F.contains("description", F.lit("@")) & F.col("company").isNotNull()).select("company").distinct()
    return registers.parse_candidates(p, seeded).select("ord")


@query("page_offset", "SELECT ord, title FROM f_postings ORDER BY ord OFFSET 100 LIMIT 50", POST)
def page_offset(i):
    return page(i.view("f_postings"), 100, 50).select("ord", "title")


@query(
    "dry_run_preview",
    "SELECT ord, '{\"job_id\":\"' || job_id || '\",\"source\":\"' || source || '\"}' AS json FROM f_postings ORDER BY ord LIMIT 5", POST)
def dry_run_preview(i):
    return preview(i.view("f_postings").select("ord", "job_id", "source"))


@query(
    "website_mining",
    f""", t AS (SELECT page_id, regexp_extract(url, '//([^/]+)', 1) AS company, url, {duck.text_of("replace(html, '</body>', CASE WHEN page_id % 3 = 0 THEN '<p>Call 020 7946 0123</p></body>' WHEN page_id % 3 = 1 THEN '<p>mail info@x.org</p></body>' ELSE '</body>' END)")} AS txt FROM pages),
        p AS ({duck.mined('t', 'page_id', 'txt', 'phone', 'company,')}), e AS ({duck.mined('t', 'page_id', 'txt', 'email', 'company,')}),
        stops AS (SELECT company, min(page_id) AS stop FROM t WHERE page_id IN (SELECT page_id FROM p) AND page_id IN (SELECT page_id FROM e) GROUP BY company),
        pl AS (SELECT company, string_agg(v, '|' ORDER BY k) AS phones FROM (SELECT p.company, v, min(p.page_id * 100000 + pos) AS k FROM p LEFT JOIN stops s ON s.company = p.company WHERE coalesce(p.page_id <= s.stop, true) GROUP BY p.company, v) g GROUP BY company),
        el AS (SELECT company, string_agg(v, '|' ORDER BY k) AS emails FROM (SELECT e.company, v, min(e.page_id * 100000 + pos) AS k FROM e LEFT JOIN stops s ON s.company = e.company WHERE coalesce(e.page_id <= s.stop, true) GROUP BY e.company, v) g GROUP BY company)
        SELECT coalesce(pl.company, el.company) AS company, coalesce(phones, '') AS phones, coalesce(emails, '') AS emails FROM pl FULL JOIN el ON pl.company = el.company""".replace(", t AS", "WITH t AS", 1))
def website_mining(i):
    m = F.col("page_id") % 3
    extra = F.when(m == 0, "<p>Call 020 7946 0123</p></body>").when(m == 1, "<p>mail info@x.org</p></body>").otherwise("</body>")
    pages = i.table("pages").select(
        F.regexp_extract("url", "//([^/]+)", 1).alias("company"), F.col("page_id").alias("page_ord"), "url",
        F.replace("html", F.lit("</body>"), extra).alias("html"))
    out = website_contacts(page_facts(pages)).where("size(phone_numbers) > 0 OR size(emails) > 0")
    return out.select("company", F.array_join("phone_numbers", "|").alias("phones"), F.array_join("emails", "|").alias("emails"))


@query(
    "ld_address",
    """SELECT page_id, CASE page_id % 3 WHEN 0 THEN CAST(page_id AS VARCHAR) || ' High St, Leeds, LS1 3AB' WHEN 1 THEN 'Leeds, UK' END AS address FROM pages""")
def ld_address(i):
    m, key = F.col("page_id") % 3, F.col("page_id").cast("string")
    block = F.when(m == 0, F.concat(F.lit('[{"@type":"x"},{"address":{"streetAddress":"'), key, F.lit(' High St","addressLocality":"Leeds","addressRegion":"","postalCode":"LS1 3AB"}}]'))
        ).when(m == 1, F.lit('{"location":{"address":{"addressLocality":"Leeds","addressCountry":"UK"}}}')).otherwise('{"address":"plain text"}')
    html = F.replace("html", F.lit("</head>"), F.concat(F.lit("<script type='application/ld+json'>"), block, F.lit("</script></head>")))
    return i.table("pages").select("page_id", web_pages.ld_address(html).alias("address"))
