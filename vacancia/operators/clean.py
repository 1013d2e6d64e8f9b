"""Derived columns with provenance, and the recency filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import since
from ..functions.money import parse_salary
from ..functions.text import parse_location
from ..schema import filled

DERIVED = "derived"


def clean(df: DataFrame) -> DataFrame:
    """Fill blank city, postcode and salary columns from their texts, marked ``derived``."""
    place = F.when(filled("location"), parse_location(F.col("location")))
    # An amount of 0 counts as missing, and new amounts replace the old pair.
    reparse = filled("salary_text") & (F.coalesce("salary_min", F.lit(0.0)) == 0)
    work = df.withColumn("_place", place).withColumn(
        "_pay", F.when(reparse, parse_salary(F.col("salary_text")))
    )
    blank = {c: ~filled(c) for c in ("location_city", "location_postcode", "salary_period")}
    new = {
        "location_city": F.when(blank["location_city"], F.col("_place.city")),
        "location_postcode": F.when(blank["location_postcode"], F.col("_place.postcode")),
        "salary_min": F.col("_pay.min"),
        "salary_max": F.col("_pay.max"),
        "salary_period": F.when(blank["salary_period"], F.col("_pay.period")),
    }
    marks = F.array(*[F.when(v.isNotNull(), F.lit(n)) for n, v in new.items()])
    names = F.array_compact(marks)
    derived = F.map_from_arrays(names, F.transform(names, lambda _: F.array(F.lit(DERIVED))))
    origins = F.coalesce("field_sources", F.create_map().cast("map<string,array<string>>"))
    kept = F.map_filter(origins, lambda k, _: ~F.array_contains(names, k))
    out = work.withColumn("field_sources", F.map_concat(kept, derived))
    for name, value in new.items():
        out = out.withColumn(name, F.coalesce(value, F.col(name)))
    return out.select(*df.columns)


def filter_since(df: DataFrame, days: int, as_of: Column) -> DataFrame:
    return df.where(since(F.col("posted_at"), days, as_of))
