"""Input views derived from the supplied tables by SQL that Spark and DuckDB read alike.

Only a few spellings differ between the two engines; they sit in ``Dialect``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from vacancia.session import work_dir

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DEALT = ("orders",)
# Wide views over rows that are dealt out already: they are written where they are calculated.
SPREAD = ("f_postings", "f_dup", "f_parts", "f_cache", "f_seeds")
# Views that read the postings once: those are calculated on the way, and only the columns that the view takes.
SLIM = ("f_companies", "f_dup")


@dataclass(frozen=True)
class Dialect:
    duck: bool

    def rx(self, text: str, pattern: str, to: str) -> str:
        return f"regexp_replace({text}, '{pattern}', '{to}'{', ' + chr(39) + 'g' + chr(39) if self.duck else ''})"

    def arr(self, *items: str) -> str:
        return f"[{', '.join(items)}]" if self.duck else f"array({', '.join(items)})"

    def each(self, source: str, items: list[str], name: str) -> str:
        """Every row of ``source`` once per item."""
        if self.duck:
            return f"{source}, (SELECT unnest([{', '.join(items)}]) AS {name}) t"
        return f"{source} LATERAL VIEW explode(array({', '.join(items)})) t AS {name}"

    def dealt(self, table: str) -> str:
        """A table of few files, dealt out while its rows are still slim."""
        return table if self.duck else f"{table}_dealt"

    @property
    def none(self) -> str:
        return "CAST([] AS VARCHAR[])" if self.duck else "CAST(array() AS array<string>)"


def _sql(d: Dialect) -> dict[str, str]:
    v: dict[str, str] = {}
    # Words of each document: 1-2 make a company name, 3-5 a title.
    words = f"""SELECT doc_id AS dk, split_part(t, ' ', 1) AS w1, split_part(t, ' ', 2) AS w2, split_part(t, ' ', 3) AS w3,
                     split_part(t, ' ', 4) AS w4, split_part(t, ' ', 5) AS w5
              FROM (SELECT doc_id, trim(replace(lower({d.rx('text', '[^A-Za-zÀ-ÿ]+', ' ')}), 'ß', 'ss')) AS t FROM documents) q1"""
    if not d.duck:
        # The same words, found one after the other: nothing is replaced in the rest of a text.
        five = "^" + "[^A-Za-zÀ-ÿ]*+([A-Za-zÀ-ÿ]*+)" * 5
        words = "SELECT doc_id AS dk, " + ", ".join(
            f"replace(lower(regexp_extract(text, '{five}', {n})), 'ß', 'ss') AS w{n}" for n in range(1, 6)) + " FROM documents"
    v["f_docs"] = f"""
        SELECT dk, CASE WHEN w1 = '' THEN 'alpha' ELSE w1 END || ' ' || CASE WHEN w2 = '' THEN 'beta' ELSE w2 END AS name,
               CASE WHEN w3 = '' THEN 'nurse' ELSE w3 END || ' ' || CASE WHEN w4 = '' THEN 'ward' ELSE w4 END
               || ' ' || CASE WHEN w5 = '' THEN 'team' ELSE w5 END AS title
        FROM ({words}) q2"""
    v["f_postings"] = f"""
        SELECT o.k AS ord,
               CASE WHEN o.k % 97 = 0 THEN '' ELSE 'J' || CAST(o.k AS string) END AS job_id,
               CASE o.k % 3 WHEN 0 THEN 'reed' WHEN 1 THEN 'indeed' ELSE 'job_feed' END AS source,
               CASE o.k % 4 WHEN 0 THEN upper(x.title) WHEN 1 THEN x.title || '!' WHEN 2 THEN '  ' || x.title ELSE x.title END AS title,
               CASE WHEN o.k % 10 < 3 THEN NULL
                    ELSE x.name || CASE o.k % 4 WHEN 0 THEN ' Ltd' WHEN 1 THEN ' Limited' WHEN 2 THEN ' NHS Trust' ELSE '' END END AS company,
               CASE WHEN o.k % 6 = 0 THEN 'https://site' || CAST(o.dk AS string) || '.example.org' END AS company_url,
               CASE n.n_nationkey % 5 WHEN 0 THEN NULL
                    WHEN 1 THEN n.n_name || ', LS' || CAST(n.n_nationkey % 9 + 1 AS string) || ' 3AB, UK'
                    WHEN 2 THEN n.n_name || ' ls' || CAST(n.n_nationkey % 9 + 1 AS string) || '4cd'
                    WHEN 3 THEN n.n_name || ', United Kingdom' ELSE n.n_name END AS location,
               CASE WHEN o.k % 8 = 0 THEN 'Town ' || CAST(n.n_nationkey AS string) END AS location_city,
               CAST(NULL AS string) AS location_postcode,
               CASE o.k % 11
                    WHEN 0 THEN '£' || CAST(o.p AS string) || ' - £' || CAST(o.p + 5000 AS string) || ' a year'
                    WHEN 1 THEN 'up to £' || CAST(o.p % 40 + 9 AS string) || '.50 per hour'
                    WHEN 2 THEN 'Competitive'
                    WHEN 3 THEN '£' || CAST(o.p % 90 + 10 AS string) || ',' || lpad(CAST(o.p % 1000 AS string), 3, '0') || ' per annum'
                    WHEN 4 THEN '£,' WHEN 5 THEN 'per annum'
                    WHEN 6 THEN '£' || CAST(o.p AS string) || ' does apply'
                    WHEN 7 THEN '£35,000 to £' || CAST(o.p % 30 AS string) || ' p.a.'
                    WHEN 8 THEN '£' || CAST(o.p % 60 AS string) || 'k' WHEN 9 THEN '' END AS salary_text,
               CASE WHEN o.k % 13 = 0 THEN CAST(o.p % 50 AS double) + 0.5 WHEN o.k % 17 = 0 THEN CAST(0 AS double) END AS salary_min,
               CASE WHEN o.k % 13 = 0 THEN CAST(o.p % 50 + 10 AS double) END AS salary_max,
               CASE WHEN o.k % 26 = 0 THEN 'hourly' END AS salary_period,
               CASE o.k % 5 WHEN 0 THEN 'full-time' WHEN 1 THEN 'part-time' END AS job_type,
               CASE o.k % 6
                    WHEN 0 THEN 'Join ' || x.name || '. Call 020 7946 ' || lpad(CAST(o.k % 10000 AS string), 4, '0') || ' or mail jobs@d' || CAST(o.dk AS string) || '.org.uk today.'
                    WHEN 1 THEN NULL
                    WHEN 2 THEN 'Tel: 01632 9' || lpad(CAST(o.k % 100000 AS string), 5, '0') || ', ref ' || CAST(o.k AS string)
                    WHEN 3 THEN ''
                    WHEN 4 THEN 'Email HR@d' || CAST(o.dk AS string) || '.co.uk, logo@2x.png, no-reply@d' || CAST(o.dk AS string) || '.co.uk or +44 7700 900' || lpad(CAST(o.k % 1000 AS string), 3, '0')
                    ELSE 'Plain text about ' || x.title END AS description,
               CASE WHEN o.k % 3 = 0 THEN {d.arr("'degree'", "'level ' || CAST(o.k % 7 AS string)")} ELSE {d.none} END AS requirements,
               CASE WHEN o.k % 4 = 1 THEN {d.arr("'pension'")} ELSE {d.none} END AS benefits,
               CASE o.k % 4 WHEN 0 THEN o.d WHEN 1 THEN o.d || 'T09:30:00Z' WHEN 3 THEN '2 days ago' END AS posted_at,
               CASE WHEN o.k % 9 = 0 THEN o.d END AS expires_at,
               CASE WHEN o.k % 2 = 0 THEN 'https://jobs.example.org/view/' || CAST(o.k AS string) || '/' END AS apply_url,
               o.d || 'T00:00:00Z' AS scraped_at, o.p AS price, o.dk AS dk, o.custkey AS custkey, x.name AS name
        FROM (SELECT o_orderkey AS k, o_custkey AS custkey, CAST(floor(o_totalprice) AS bigint) AS p,
                     CAST(CAST(o_orderdate AS date) AS string) AS d, o_orderkey % (SELECT count(*) FROM documents) AS dk
              FROM {d.dealt("orders")}) o
        JOIN customer c ON c.c_custkey = o.custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN f_docs x ON x.dk = o.dk"""
    cols = (
        "job_id, source, title, company, company_url, location, location_city, location_postcode, salary_text, "
        "salary_min, salary_max, salary_period, job_type, description, requirements, benefits, posted_at, "
        "expires_at, apply_url, scraped_at"
    )

    def changed(**new: str) -> str:
        return ", ".join(f"{new[c]} AS {c}" if c in new else c for c in cols.split(", "))

    # Repeats under the same id, copies under another source with gaps, and near-equal titles.
    mirrored = dict(
        source="'mirror'", job_id="'M' || CAST(ord AS string)", salary_text="CAST(NULL AS string)", salary_min="CAST(21 AS double)",
        salary_period="'annual'", job_type="coalesce(job_type, 'contract')", apply_url="CAST(NULL AS string)",
        expires_at="coalesce(expires_at, '2030-01-01')", benefits=d.arr("'mirror benefit'"))
    copies = {1: (7, dict(title="'copy ' || title")), 2: (5, mirrored), 3: (11, dict(job_id="'N' || CAST(ord AS string)", title="title || ' x'"))}
    if d.duck:
        v["f_dup"] = f"""
        SELECT ord * 4 AS ord, {cols}, dk FROM f_postings
        UNION ALL SELECT ord * 4 + 1, {changed(**copies[1][1])}, dk FROM f_postings WHERE ord % 7 = 0
        UNION ALL SELECT ord * 4 + 2, {changed(**mirrored)}, dk
                  FROM f_postings WHERE ord % 5 = 0
        UNION ALL SELECT ord * 4 + 3, {changed(**copies[3][1])}, dk FROM f_postings WHERE ord % 11 = 0"""
    else:
        # The postings are gone through once: every row by as many copies as it has.
        of = {c: " ".join(f"WHEN {n} THEN {new[c]}" for n, (_, new) in copies.items() if c in new) for c in cols.split(", ")}
        which = " OR ".join(f"n = {n} AND ord % {every} = 0" for n, (every, _) in copies.items())
        v["f_dup"] = f"""
        SELECT ord * 4 + copy AS ord, {', '.join(f'CASE copy {whens} ELSE {c} END AS {c}' if whens else c for c, whens in of.items())}, dk
        FROM f_postings LATERAL VIEW explode(filter(array(0, 1, 2, 3), n -> n = 0 OR {which})) t AS copy"""
    # Adverts: whole document texts, some with a contact line after them.
    v["f_ads"] = """
        SELECT d.doc_id AS ord, x.name AS company,
               CASE WHEN d.doc_id % 3 = 0
                    THEN d.text || ' Please contact Jane Smith on 0161 496 ' || lpad(CAST(d.doc_id % 10000 AS string), 4, '0')
                         || ' or Talent@d' || CAST(d.doc_id % 50 AS string) || '.co.uk; office at 1 High St, Leeds LS1 3AB, open daily.'
                    ELSE d.text END AS description
        FROM documents d JOIN f_docs x ON x.dk = d.doc_id"""
    # Companies and registers.
    v["f_companies"] = """
        SELECT company, min(ord) AS first_ord FROM f_postings WHERE company IS NOT NULL GROUP BY company"""
    v["f_register"] = """
        SELECT dk AS cand_ord, 'N' || CAST(dk AS string) AS company_number,
               CASE dk % 5 WHEN 0 THEN upper(name) WHEN 1 THEN name || 's' WHEN 2 THEN name || ' Limited'
                           WHEN 3 THEN 'the ' || name ELSE name || ' Ltd' END AS name,
               CASE WHEN dk % 3 = 0 THEN 'ltd' ELSE 'plc' END AS company_type,
               CASE WHEN dk % 7 = 0 THEN 'dissolved' WHEN dk % 7 = 1 THEN NULL ELSE 'active' END AS company_status,
               CAST(dk AS string) AS premises, CASE WHEN dk % 2 = 0 THEN 'High Street' ELSE '' END AS line1,
               CASE WHEN dk % 4 = 0 THEN NULL ELSE 'Leeds' END AS town, 'LS1 3AB' AS code
        FROM f_docs"""
    v["f_officers"] = """
        SELECT 'N' || CAST(l_orderkey % (SELECT count(*) FROM documents) AS string) AS company_number,
               ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS officer_ord,
               'Officer ' || CAST(l_suppkey AS string) || '-' || CAST(l_partkey AS string) AS name,
               CASE l_suppkey % 4 WHEN 0 THEN 'Director' WHEN 1 THEN 'llp-member' WHEN 2 THEN 'Company Secretary' ELSE 'manager' END AS officer_role,
               CASE WHEN l_partkey % 3 = 0 THEN '2020-01-01' WHEN l_partkey % 3 = 1 THEN '' END AS resigned_on
        FROM lineitem"""
    # Contact parts: one per (company, lookup), with phone, e-mail, both or neither.
    labels = "job_description website companies_house charities cqc duckduckgo other".split()
    label = "CASE priority " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(labels)) + " END"
    each = d.each("f_companies c", [str(i) for i in range(len(labels))], "priority")
    v["f_parts"] = f"""
        SELECT s.company, s.priority, s.first_ord * 10 + s.priority AS part_ord,
               CASE WHEN (s.first_ord + s.priority) % 3 = 0
                    THEN {d.arr("'+44 1632 9' || lpad(CAST((s.first_ord + s.priority) % 4 AS string), 5, '0')", "'+44 20 7946 0001'")}
                    ELSE {d.none} END AS phone_numbers,
               CASE WHEN (s.first_ord * 7 + s.priority) % 4 = 0
                    THEN {d.arr("'Info@c' || CAST(s.first_ord AS string) || '.org'", "CASE WHEN s.priority % 2 = 0 THEN 'HR@c.org' ELSE 'hr@C.org' END")}
                    ELSE {d.none} END AS emails,
               CASE WHEN (s.first_ord + s.priority) % 5 = 0 THEN 'Person ' || s.label WHEN (s.first_ord + s.priority) % 5 = 1 THEN '' END AS contact_person,
               CASE WHEN (s.first_ord * 3 + s.priority) % 4 = 0 THEN 'Addr ' || s.label END AS address,
               CASE (s.first_ord + s.priority) % 4 WHEN 0 THEN 'http://a' || s.label WHEN 1 THEN 'https://b' || s.label WHEN 2 THEN '' END AS company_website,
               CASE WHEN s.priority = 2 AND s.first_ord % 3 = 0 THEN 'N' || CAST(s.first_ord AS string) END AS company_number,
               CASE WHEN s.priority = 3 THEN 'charity' WHEN s.priority = 2 AND s.first_ord % 2 = 0 THEN 'ltd' END AS company_type,
               {d.arr('s.label')} AS enrichment_sources,
               s.priority = 6 AS ai_used,
               CASE WHEN s.first_ord % 5 = s.priority % 5 THEN '2024-01-0' || CAST(s.priority + 1 AS string) || 'T00:00:00Z' END AS enriched_at,
               s.label AS label
        FROM (SELECT company, first_ord, priority, {label} AS label FROM (SELECT company, first_ord, priority FROM {each}) q1) s
        WHERE (s.first_ord + s.priority) % 3 <> 1"""
    v["f_cache"] = f"""
        SELECT company,
               CASE WHEN first_ord % 4 <> 3 THEN {d.arr("'+44 20 7946 0001'")} ELSE {d.none} END AS phone_numbers,
               CASE WHEN first_ord % 4 = 0 THEN {d.arr("'HR@Old.org'")} ELSE {d.none} END AS emails,
               CASE WHEN first_ord % 8 = 3 THEN 'Addr' END AS address,
               CASE first_ord % 5 WHEN 0 THEN '2024-05-20T00:00:00Z' WHEN 1 THEN '2020-01-01T00:00:00' WHEN 2 THEN 'yesterday'
                                  WHEN 3 THEN '2024-05-02T00:00:00+00:00' END AS enriched_at,
               {d.arr("'website'")} AS enrichment_sources
        FROM f_companies"""
    v["f_seeds"] = f"""
        SELECT company,
               CASE WHEN first_ord % 3 = 0 THEN {d.arr("'+44 20 7946 0001'", "'+44 1632 900001'")} ELSE {d.none} END AS phone_numbers,
               CASE WHEN first_ord % 2 = 0 THEN {d.arr("'hr@old.org'")} WHEN first_ord % 7 = 1 THEN {d.arr("'new@x.org'")} ELSE {d.none} END AS emails
        FROM f_companies"""
    # Repeated captures of one posting.
    v["f_captures"] = f"""
        SELECT event_type AS source, CASE WHEN user_id % 50 = 0 THEN '' ELSE 'U' || CAST(user_id AS string) END AS job_id,
               event_id AS ord, ts,
               CASE WHEN event_id % 3 = 0 THEN '' ELSE 'Title ' || CAST(event_id % 11 AS string) END AS title,
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'Co ' || CAST(event_id % 13 AS string) END AS company,
               repeat('d', CAST(floor(value) AS int) % 40) || CAST(event_id % 2 AS string) AS description,
               CASE WHEN event_id % 5 = 0 THEN {d.arr("'r' || CAST(event_id % 17 AS string)")} ELSE {d.none} END AS requirements,
               props
        FROM events"""
    return v


@cache
def view_sql(duck: bool) -> dict[str, str]:
    return _sql(Dialect(duck))


def with_views(*names: str) -> str:
    """``WITH`` clause (without trailing comma) defining the views and what they build on."""
    views = view_sql(True)
    return "WITH " + ", ".join(f"{n} AS ({views[n]})" for n in needed(list(names), views))


def needed(names: list[str], views: dict[str, str]) -> list[str]:
    """The given views and those they build on, in building order."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        wanted.add(name)
        for other in views:
            if other != name and other in views[name]:
                need(other)

    for n in names:
        need(n)
    return [n for n in views if n in wanted]


class Inputs:
    """Tables of a scale-factor folder and the derived views, as DataFrames.

    A derived view is landed as parquet in the session's shared folder on first use, the way a
    run's input would be, so that a query's plan starts at a table and not at the fixture's joins.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self.root, self.landed = None, set()
        for t in TABLES:
            self.table(t).createOrReplaceTempView(t)
        for t in DEALT:
            self.table(t).repartition(spark.sparkContext.defaultParallelism).createOrReplaceTempView(f"{t}_dealt")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _land(self, names: list[str]) -> None:
        views = view_sql(False)
        building = [n for n in needed(names, views) if n not in self.landed]
        for name in building:
            if name == "f_postings" and name not in names and not any(name in views[n] for n in building if n not in (name, *SLIM)):
                self.spark.sql(views[name]).createOrReplaceTempView(name)
                continue
            self.root = self.root or work_dir(self.spark, "inputs")
            path = f"{self.root}/{name}"
            # Several files, so that reading uses every core, as a landed input of many files would.
            rows = self.spark.sql(views[name])
            if name not in SPREAD:
                rows = rows.repartition(self.spark.sparkContext.defaultParallelism)
            rows.write.mode("overwrite").parquet(path)
            self.spark.read.parquet(path).createOrReplaceTempView(name)
            self.landed.add(name)

    def view(self, name: str) -> DataFrame:
        self._land([name])
        return self.spark.table(name)

    def columns(self, name: str, *columns: str) -> DataFrame:
        """Some columns of a view that a query reads once: the rest of it is neither calculated nor stored."""
        views = view_sql(False)
        for n in needed([name], views):
            if n not in self.landed:
                self.spark.sql(views[n]).createOrReplaceTempView(n)
        return self.spark.table(name).select(*columns)

    def sql(self, query: str) -> DataFrame:
        self._land([n for n in view_sql(False) if n in query])
        return self.spark.sql(query)
