"""SQL text of the scalar rules, written for DuckDB from their definitions."""

from __future__ import annotations

WS = r"[\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]"
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
FINDER = r"(?:\+44|0044|0)[\s\p{Z}\-.]?(?:\d[\s\p{Z}\-.]?){9,11}"
POSTCODE = r"(?i)[A-Z]{1,2}[0-9][0-9A-Z]?\s?[0-9][A-Z]{2}"


def rx(e: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({e}, '{pattern}', '{to}', 'g')"


def strip(e: str) -> str:
    return rx(e, f"^{WS}+|{WS}+$")


def squeeze(e: str) -> str:
    return strip(rx(e, f"{WS}+", " "))


def norm(e: str) -> str:
    out = squeeze(rx(f"lower(coalesce({e}, ''))", r"[^\p{L}\p{N}_\s\p{Z}]", " "))
    for s in ["nhs foundation trust", "nhs trust", "foundation trust", "ltd", "limited", "plc", "llp", "llc"]:
        out = rx(out, rf"\b{s}\b")
    return strip(out)


def content_hash(t: str = "title", c: str = "company", l: str = "location", j: str = "job_id") -> str:
    a, b, d = norm(t), norm(c), norm(l)
    return (
        f"substr(md5(CASE WHEN {a} || {b} || {d} = '' THEN '__fallback__|' || coalesce({j}, '') "
        f"ELSE {a} || '|' || {b} || '|' || {d} END), 1, 12)"
    )


def clean_email(e: str) -> str:
    v = f"lower({strip(e)})"
    endings = "'png','jpg','jpeg','svg','css','gif','ico','woff'"
    return (
        f"CASE WHEN {v} IS NULL OR string_split({v}, '.')[-1] IN ({endings}) "
        f"OR regexp_matches({v}, 'noreply|no-reply|donotreply|do-not-reply') "
        f"OR NOT regexp_matches({v}, '^(?:{EMAIL})') THEN NULL ELSE {v} END"
    )


def clean_phone(e: str) -> str:
    digits = rx(e, r"\D")
    n = f"regexp_replace({digits}, '^(?:0044|44)?0?', '')"

    def g(lengths: str) -> str:
        cuts, at = [], 1
        for size in lengths.split():
            cuts.append(f"substr({n}, {at}, {size})")
            at += int(size)
        return " || ' ' || ".join(cuts)

    rules = [
        (r"^2[03489]\d{8}$", "2 4 4"), (r"^(5[56]|70|76)\d{8}$", "2 4 4"), (r"^7[1-57-9]\d{8}$", "4 6"),
        (r"^(11[3-8]|1[2-69]1)\d{7}$", "3 3 4"), (r"^1[2-9]\d{7,8}$", "4 6"),
        (r"^(3[0347]\d|80[08]|84[2-5]|87[0-3]|9[018]\d)\d{7}$", "3 3 4"), (r"^800\d{6}$", "3 3 3"),
    ]
    cases = " ".join(f"WHEN regexp_matches({n}, '{p}') THEN '+44 ' || {g(s)}" for p, s in rules)
    bad = f"regexp_matches({e}, '\\d\\.\\d') OR length({digits}) < 10"
    return f"CASE WHEN {e} IS NULL OR {bad} THEN NULL {cases} END"


def mined(source: str, key: str, text: str, kind: str, extra: str = "") -> str:
    """Rows (key, extra, pos, value) of the phones or e-mails printed in a text."""
    pattern = FINDER if kind == "phone" else EMAIL
    clean = clean_phone("h") if kind == "phone" else clean_email("h")
    keep = "v IS NOT NULL"
    if kind == "phone":
        keep += f" AND NOT regexp_matches({rx('v', chr(92) + 'D')}, '2023|2024|2025|2026')"
    return (
        f"SELECT {key}, {extra} pos, v FROM (SELECT {key}, {extra} pos, {clean} AS v FROM "
        f"(SELECT {key}, {extra} unnest(l) AS h, generate_subscripts(l, 1) AS pos FROM "
        f"(SELECT {key}, {extra} regexp_extract_all({text}, '{pattern}') AS l FROM {source}) a) b) c WHERE {keep}"
    )


def city(e: str) -> str:
    head = strip(f"split_part(regexp_replace({e}, '(?i)\\bUnited Kingdom\\b|\\bUK\\b', '', 'g'), ',', 1)")
    return f"CASE WHEN length({head}) >= 2 THEN {head} END"


def postcode(e: str) -> str:
    return f"upper(nullif(regexp_extract({e}, '{POSTCODE}'), ''))"


def salary(e: str = "salary_text") -> dict[str, str]:
    low = f"lower({e})"
    ok = f"(coalesce({e}, '') <> '' AND NOT regexp_matches({low}, 'competitive|negotiable|depending|doe|tbc|tbf|market rate'))"
    nums = (
        f"list_filter(list_transform(regexp_extract_all({e}, '£([\\d,]+(?:\\.\\d{{1,2}})?)', 1), "
        "lambda a: TRY_CAST(replace(a, ',', '') AS DOUBLE)), lambda a: a IS NOT NULL)"
    )
    return {
        "min": f"CASE WHEN {ok} AND NOT (len({nums}) = 1 AND contains({low}, 'up to')) THEN list_min({nums}) END",
        "max": f"CASE WHEN {ok} THEN list_max({nums}) END",
        "period": (
            f"CASE WHEN NOT {ok} THEN NULL WHEN regexp_matches({low}, '\\bhour(ly)?\\b|/hr\\b|per hour') THEN 'hourly' "
            f"WHEN regexp_matches({low}, '\\byear\\b|\\bannum\\b|annual|p\\.a\\.|per year') THEN 'annual' END"
        ),
    }


def money_text(low: str, high: str, period: str, symbol: str = "'£'") -> str:
    label = f"CASE {period} WHEN 'hourly' THEN ' an hour' WHEN 'annual' THEN ' a year' ELSE '' END"

    def m(x: str) -> str:
        return f"{symbol} || format('{{:,.2f}}', {x})"

    return (
        f"replace(CASE WHEN {low} <> {high} THEN {m(low)} || ' - ' || {m(high)} || {label} "
        f"ELSE {m(f'coalesce({low}, {high})')} || {label} END, '.00', '')"
    )


ENTITIES = [
    ("&nbsp;", " "), ("&pound;", "£"), ("&euro;", "€"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&hellip;", "…"), ("&bull;", "•"), ("&middot;", "·"),
    ("&copy;", "©"), ("&reg;", "®"), ("&eacute;", "é"), ("&lt;", "<"), ("&gt;", ">"),
    ("&quot;", '"'), ("&amp;", "&"),
]


def text_of(html: str) -> str:
    """Visible text of a page: markup to a separator, nodes trimmed, blanks dropped."""
    blocks = "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in ("script", "style", "template"))
    e = f"regexp_replace({html}, '(?is)<!--.*?-->|{blocks}|</?[a-z!?][^>]*>', chr(1), 'g')"
    for name, char in ENTITIES:
        e = f"replace({e}, '{name}', '{char}')"
    nodes = f"list_transform(string_split({e}, chr(1)), lambda n: {strip('n')})"
    return f"array_to_string(list_filter({nodes}, lambda n: n <> ''), ' ')"
