"""UK phone numbers, as Column expressions.

Validity and grouping follow the public UK numbering plan by leading digits. That is an
approximation of a full numbering database: unallocated ranges inside a valid prefix pass, and
numbers of other countries are refused.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The finder, and year-like digit runs that mark a false hit.
FINDER = r"(?:\+44|0044|0)[\s\p{Z}\-.]?(?:\d[\s\p{Z}\-.]?){9,11}"
YEAR_RUN = "2023|2024|2025|2026"

# National number pattern -> printed groups, tried in order.
PLAN = [
    (r"^(2[03489])(\d{4})(\d{4})$", "$1 $2 $3"),
    (r"^(5[56]|70|76)(\d{4})(\d{4})$", "$1 $2 $3"),
    (r"^(7[1-57-9]\d{2})(\d{6})$", "$1 $2"),
    (r"^(11[3-8]|1[2-69]1)(\d{3})(\d{4})$", "$1 $2 $3"),
    (r"^(1[2-9]\d{2})(\d{5,6})$", "$1 $2"),
    (r"^(3[0347]\d|80[08]|84[2-5]|87[0-3]|9[018]\d)(\d{3})(\d{4})$", "$1 $2 $3"),
    (r"^(800)(\d{3})(\d{3})$", "$1 $2 $3"),
]


def clean_phone(raw: Column) -> Column:
    """``+44 ...`` in international grouping, or null when it is not a plausible UK number."""
    foreign = F.trim(raw).rlike(r"^(?:\+|00)(?!\s*44)")
    digits = F.regexp_replace(raw, r"\D", "")
    national = F.regexp_replace(digits, r"^(?:0044|44(?=\d{9,11}$))?0?", "")
    grouped = F.lit(None).cast("string")
    for pattern, groups in reversed(PLAN):
        grouped = F.when(
            national.rlike(pattern), F.regexp_replace(national, pattern, groups)
        ).otherwise(grouped)
    usable = ~raw.rlike(r"\d\.\d") & ~foreign & (F.length(digits) >= 10)
    return F.when(usable, F.concat(F.lit("+44 "), grouped))


def year_like(phone: Column) -> Column:
    return F.regexp_replace(phone, r"\D", "").rlike(YEAR_RUN)


def extract_phones(text: Column, year_filter: bool = True) -> Column:
    """Distinct valid numbers in order of appearance; never null."""
    hits = F.transform(F.regexp_extract_all(text, F.lit(FINDER), F.lit(0)), clean_phone)
    keep = (lambda p: p.isNotNull() & ~year_like(p)) if year_filter else (lambda p: p.isNotNull())
    return F.coalesce(F.array_distinct(F.filter(hits, keep)), F.array().cast("array<string>"))
