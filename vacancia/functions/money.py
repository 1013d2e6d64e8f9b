"""Salary text to numbers and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import filled

# Words that make a salary text unusable (plain substrings), and period cues.
VAGUE = r"competitive|negotiable|depending|doe|tbc|tbf|market rate"
HOURLY = r"\bhour(ly)?\b|/hr\b|per hour"
ANNUAL = r"\byear\b|\bannum\b|annual|p\.a\.|per year"
AMOUNT = r"£([\d,]+(?:\.\d{1,2})?)"


def parse_salary(text: Column) -> Column:
    """struct(min, max, period); all null for vague text, "up to x" has no minimum."""
    low = F.lower(text)
    usable = filled(text) & ~low.rlike(VAGUE)
    amounts = F.filter(
        F.transform(
            F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(1)),
            lambda a: F.replace(a, F.lit(","), F.lit("")).try_cast("double"),
        ),
        lambda a: a.isNotNull(),
    )
    ceiling_only = (F.size(amounts) == 1) & F.contains(low, F.lit("up to"))
    period = F.when(low.rlike(HOURLY), "hourly").when(low.rlike(ANNUAL), "annual")
    return F.struct(
        F.when(usable & ~ceiling_only, F.array_min(amounts)).alias("min"),
        F.when(usable, F.array_max(amounts)).alias("max"),
        F.when(usable, period).alias("period"),
    )


def period_of_unit(unit: Column) -> Column:
    """Period of a structured salary unit; monthly counts as annual."""
    low = F.lower(unit)
    return F.when(F.contains(low, F.lit("hour")), "hourly").when(low.rlike("year|annual|month"), "annual")


def money(amount: Column) -> Column:
    return F.format_number(amount, 2)


def render_salary(low: Column, high: Column, period: Column, symbol: Column | str = "£") -> Column:
    """``£a - £b a year``; one amount when equal; null when neither is given."""
    symbol = F.lit(symbol) if isinstance(symbol, str) else symbol
    label = F.when(period == "hourly", " an hour").when(period == "annual", " a year").otherwise("")
    one = F.concat(symbol, money(F.coalesce(low, high)), label)
    two = F.concat(symbol, money(low), F.lit(" - "), symbol, money(high), label)
    both = low.isNotNull() & high.isNotNull() & (low != high)
    return F.replace(F.when(both, two).otherwise(one), F.lit(".00"), F.lit(""))
