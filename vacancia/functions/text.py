"""Text functions: names, e-mails, places, HTML, links. All are plain Column expressions."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import blank_to_null, filled, first_filled

# Any Unicode whitespace, including the separators that Java's \s leaves out.
WS = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"
WORD = r"[\p{L}\p{N}_]"

# Legal-form suffixes removed from names, longest first.
NAME_SUFFIXES = [
    "nhs foundation trust", "nhs trust", "foundation trust", "ltd", "limited", "plc", "llp", "llc",
]
# File endings that look like mail domains, and robot mailboxes.
FILE_ENDINGS = ["png", "jpg", "jpeg", "svg", "css", "gif", "ico", "woff"]
NO_REPLY = r"noreply|no-reply|donotreply|do-not-reply"
# Mailboxes that sort first.
HIRING_MAILBOX = r"(?i)^(hr|recruitment|jobs|careers|talent|people)@"
# Patterns for e-mail and UK postcode.
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
POSTCODE = r"(?i)[A-Z]{1,2}[0-9][0-9A-Z]?\s?[0-9][A-Z]{2}"
# Words in a page title that mark a blocked page.
BLOCK_WORDS = [
    "captcha", "robot", "blocked", "verify", "security", "access denied", "just a moment",
    "attention required",
]
# Site paths likely to hold contact details.
CONTACT_PATHS = ["/contact", "/contact-us", "/about", "/about-us", "/team", "/our-team", "/staff"]
# Company site addresses to try, by name slug.
SITE_PATTERNS = [
    "https://{slug}.nhs.uk", "https://www.{slug}.nhs.uk", "https://{slug}.org.uk",
    "https://www.{slug}.org.uk", "https://{slug}.co.uk", "https://www.{slug}.co.uk",
    "https://{slug}.com",
]
# One alternation: comments and script-like blocks go before plain tags are recognised.
MARKUP = (
    r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>|</?[a-z!?][^>]*>"
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value calculated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def cut(c: Column, limit: int | None) -> Column:
    """First ``limit`` characters, or everything when ``limit`` is None."""
    return c if limit is None else F.substring(c, 1, limit)


def norm_name(c: Column) -> Column:
    """Lower-case, punctuation to spaces, legal suffixes deleted, ends stripped; null becomes ''.

    A deletion inside the name leaves its two spaces, and never joins words into a new suffix,
    so one alternation equals deleting the suffixes one after another. Whatever is no word character is punctuation or
    space, so a run of both becomes one space at once.
    """
    flat = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}_]+", " ")
    suffix = f"(?<!{WORD})(?:{'|'.join(NAME_SUFFIXES)})(?!{WORD})"
    return F.trim(F.regexp_replace(flat, suffix, ""))


def content_key(title: Column, company: Column, location: Column, job_id: Column) -> Column:
    """Normalised title, company and place; the identifier if all are empty."""
    t, c, l = norm_name(title), norm_name(company), norm_name(location)
    blank = (t == "") & (c == "") & (l == "")
    return F.when(
        blank, F.concat(F.lit("__fallback__|"), F.coalesce(job_id, F.lit("")))
    ).otherwise(F.concat_ws("|", t, c, l))


def content_hash(title: Column, company: Column, location: Column, job_id: Column) -> Column:
    """Short digest of the content key, an output column; merging and resuming use the whole key."""
    return hash_of(content_key(title, company, location, job_id))


def hash_of(key: Column) -> Column:
    return F.substring(F.md5(key), 1, 12)


def clean_email(raw: Column) -> Column:
    """Trimmed lower-case address; null for image names, robot mailboxes and non-addresses."""
    v = F.lower(strip(raw))
    bad = F.substring_index(v, ".", -1).isin(FILE_ENDINGS) | v.rlike(NO_REPLY)
    return F.when(v.rlike(f"^(?:{EMAIL})") & ~bad, v)


def extract_emails(text: Column) -> Column:
    """Distinct cleaned addresses in order of appearance; never null.

    The look-behind lets the scan start only at the head of a run (or right after a hit), which
    keeps it linear on long unbroken runs and finds the same hits.
    """
    finder = rf"(?:\G|(?<![a-zA-Z0-9._%+\-])){EMAIL}"
    hits = F.transform(F.regexp_extract_all(text, F.lit(finder), F.lit(0)), clean_email)
    found = F.array_distinct(F.filter(hits, lambda x: x.isNotNull()))
    return F.when(F.contains(text, F.lit("@")), found).otherwise(_no_strings())


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def emails_by_priority(emails: Column) -> Column:
    """Hiring mailboxes first, otherwise unchanged order."""
    return F.concat(
        F.filter(emails, lambda e: e.rlike(HIRING_MAILBOX)),
        F.filter(emails, lambda e: ~e.rlike(HIRING_MAILBOX)),
    )


def postcode(text: Column) -> Column:
    return F.upper(blank_to_null(F.regexp_extract(text, POSTCODE, 0)))


def city(text: Column) -> Column:
    plain = F.regexp_replace(text, r"(?i)\bUnited Kingdom\b|\bUK\b", "")
    head = strip(F.split_part(plain, F.lit(","), F.lit(1)))
    return F.when(filled(text) & (F.length(head) >= 2), head)


def parse_location(text: Column) -> Column:
    return F.struct(city(text).alias("city"), postcode(text).alias("postcode"))


@cache
def _references() -> tuple[str, str]:
    """All named character references of HTML as a JSON object, and a pattern of those that need no semicolon.

    The table is the standard library's. Frequent names come first, as a map is searched in order.
    """
    short = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    order = sorted(html5, key=lambda n: (n.rstrip(";") not in html5, n))
    return json.dumps({n: html5[n] for n in order}), "|".join(short)


# Numeric references 128 to 159 mean the characters of this code page; five of them have none.
_PAGE = [bytes([i]).decode("cp1252", "replace").replace("\ufffd", chr(i)) for i in range(128, 160)]


def decode_entities(c: Column) -> Column:
    """Named and numeric character references of HTML, each decoded once.

    A name without a semicolon is the longest one that needs none; what is no reference stays as it is. A number
    that is no character becomes U+FFFD.
    """
    table, short = _references()
    named = F.from_json(F.lit(table), "map<string,string>")
    page = F.lit(_PAGE)

    def number(piece: Column) -> Column:
        dec = F.regexp_extract(piece, r"^#0*([0-9]{1,8})", 1)
        hexa = F.regexp_extract(piece, r"^#[xX]0*([0-9a-fA-F]{1,8})", 1)
        point = F.coalesce(F.conv(F.nullif(hexa, F.lit("")), 16, 10), F.nullif(dec, F.lit(""))).cast("bigint")
        whole = F.regexp_extract(piece, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
        good = ((point > 0) & (point < 0xD800)) | ((point > 0xDFFF) & (point <= 0x10FFFF))
        char = F.when(point.between(128, 159), F.get(page, (point - 128).cast("int"))).when(
            good, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        ).otherwise("\ufffd")
        return F.when(whole != "", F.concat(char, F.substring(piece, F.length(whole) + 1, F.length(piece))))

    def name(piece: Column) -> Column:
        full = F.regexp_extract(piece, r"^[A-Za-z][A-Za-z0-9]{0,31};?", 0)
        part = F.regexp_extract(piece, f"^(?:{short})", 0)

        def rest(used: Column) -> Column:
            return F.substring(piece, F.length(used) + 1, F.length(piece))

        return F.coalesce(
            F.concat(named[full], rest(full)), F.when(part != "", F.concat(named[part], rest(part)))
        )

    def decode(piece: Column) -> Column:
        found = F.when(F.startswith(piece, F.lit("#")), number(piece)).otherwise(name(piece))
        return F.coalesce(found, F.concat(F.lit("&"), piece))

    def joined(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decode)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))

    return bound(c, lambda v: F.when(F.contains(v, F.lit("&")), bound(F.split(v, "&"), joined)).otherwise(v))


def html_to_text(html: Column) -> Column:
    """Visible text: markup splits it into nodes, each trimmed, joined by one space.

    Markup becomes a mark; after decoding, a mark with the white space and marks around it is the
    gap between two nodes.
    """
    marked = decode_entities(F.regexp_replace(F.coalesce(html, F.lit("")), MARKUP, "\u0001"))
    gap = rf"(?<!{WS}){WS}*+\x{{01}}(?:{WS}|\x{{01}})*"
    return strip(F.regexp_replace(marked, gap, " "))


def html_title(html: Column) -> Column:
    return squeeze(decode_entities(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)))


def is_blocked(html: Column) -> Column:
    return F.lower(html_title(html)).rlike("|".join(BLOCK_WORDS))


def join_parts(*parts: Column) -> Column:
    """Comma-joined non-blank parts, null when none is left."""
    return blank_to_null(F.concat_ws(", ", *[blank_to_null(p) for p in parts]))


def address_near_postcode(text: Column) -> Column:
    """Text around the first postcode: 100 characters before, 20 after, squeezed, at most 200."""
    at = F.regexp_instr(text, F.lit(POSTCODE))
    hit = F.length(F.regexp_extract(text, POSTCODE, 0))
    start = F.greatest(at - 100, F.lit(1))
    around = F.substring(text, start, at - start + hit + 20)
    return F.when(at > 0, F.substring(squeeze(around), 1, 200))


# Cue words around a contact person's name.
_PERSON = (
    r"(?i)(?:contact|speak to|talk to|email)\s+([A-Z][a-z]+ [A-Z][a-z]+)|"
    r"([A-Z][a-z]+ [A-Z][a-z]+)[,\s]+(?:HR|Recruitment|People|Hiring|Manager|Director)"
)


def contact_person(text: Column) -> Column:
    """First name next to a cue word ("contact", "speak to", ... or a role after the name)."""
    return strip(first_filled(F.regexp_extract(text, _PERSON, 1), F.regexp_extract(text, _PERSON, 2)))


def site_candidates(company: Column) -> Column:
    slug = F.regexp_replace(F.lower(company), r"[^\p{L}\p{N}_]", "")
    return F.transform(
        F.array(*[F.lit(p) for p in SITE_PATTERNS]), lambda p: F.replace(p, F.lit("{slug}"), slug)
    )


def page_candidates(base_url: Column) -> Column:
    """The base address and the usual contact pages below it, in visiting order."""
    root = F.regexp_replace(base_url, "/+$", "")
    paths = F.transform(F.array(*[F.lit(p) for p in CONTACT_PATHS]), lambda p: F.concat(root, p))
    return F.concat(F.array(base_url), paths)


def absolute_link(link: Column, host: str, fallback: Column) -> Column:
    return F.when(F.startswith(link, F.lit("/")), F.concat(F.lit(host), link)).otherwise(fallback)


def url_tail(url: Column) -> Column:
    """Last path segment of a link."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def url_query_value(url: Column, key: str) -> Column:
    return blank_to_null(F.regexp_extract(url, rf"[?&]{key}=([^&#]*)", 1))


def request_text(template: str, **values: Column) -> Column:
    """Fill ``{name}`` slots of a template; the result is a request row for an outside service."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(blank_to_null(value), F.lit("Unknown")))
    return out


def minus_ignore_case(new: Column, old: Column) -> Column:
    """Values of ``new`` that ``old`` lacks, whatever the letter case."""
    lowered = F.transform(old, F.lower)
    return F.filter(new, lambda x: ~F.array_contains(lowered, F.lower(x)))


def is_json(c: Column) -> Column:
    """One JSON value and nothing after it."""
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1, F.lit(False))
