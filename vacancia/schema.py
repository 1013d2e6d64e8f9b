"""Canonical schemas, and the ordinal every first-wins rule depends on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())
_TYPES = {
    "string": T.StringType(),
    "strings": _STRINGS,
    "double": T.DoubleType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "origins": T.MapType(T.StringType(), _STRINGS),
    "changes": T.MapType(
        T.StringType(), T.StructType([T.StructField("old", _STRINGS), T.StructField("new", _STRINGS)])
    ),
}


def _schema(fields: str) -> T.StructType:
    """``name:type`` words; a name without a type is a string."""
    parts = [word.partition(":") for word in fields.split()]
    return T.StructType([T.StructField(name, _TYPES[kind or "string"]) for name, _, kind in parts])


POSTINGS = _schema(
    "ord:long job_id source title company company_url location location_city location_postcode "
    "salary_text salary_min:double salary_max:double salary_period job_type description "
    "requirements:strings benefits:strings posted_at expires_at apply_url sources:strings "
    "field_sources:origins hash scraped_at"
)

CONTACTS = _schema(
    "company phone_numbers:strings emails:strings contact_person address company_website "
    "company_number company_type enrichment_sources:strings ai_used:bool enriched_at "
    "confidence_score:int field_sources:origins changes:changes"
)

CONTACT_PARTS = _schema(
    "company priority:int part_ord:long phone_numbers:strings emails:strings contact_person address "
    "company_website company_number company_type enrichment_sources:strings ai_used:bool "
    "enriched_at changes:changes"
)

RUNS = _schema(
    "run_id started_at finished_at jobs_scraped:long jobs_new:long jobs_duplicate:long "
    "companies_enriched:long ai_calls_made:long errors:long"
)

# Fields whose origin is tracked in a posting, in report order.
JOB_TRACKED = [
    "title", "company", "company_url", "location", "location_city", "location_postcode",
    "salary_text", "salary_min", "salary_max", "salary_period", "job_type", "description",
    "requirements", "benefits", "posted_at", "expires_at", "apply_url",
]

# Fields whose origin is tracked in a contact, in report order.
CONTACT_TRACKED = [
    "phone_numbers", "emails", "contact_person", "address", "company_website",
    "company_number", "company_type",
]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become typed nulls, extra ones are dropped."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        ]
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def filled(c: Column | str) -> Column:
    """A string that is neither null nor empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c != "", F.lit(False))


def has_items(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.size(c) > 0, F.lit(False))


def blank_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither null nor empty, as in ``a or b or c``."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def filled_sql(field: T.StructField) -> str:
    """SQL text of the test that a field of any posting type counts as populated.

    Rules that run over many columns are built as SQL text: one call per column list instead of
    several per column.
    """
    if isinstance(field.dataType, T.ArrayType):
        return f"(coalesce(size({field.name}), 0) > 0)"
    if isinstance(field.dataType, T.StringType):
        return f"(coalesce({field.name}, '') <> '')"
    return f"({field.name} IS NOT NULL)"


#: Bits of an ordinal: items of a file below, files of a batch in the middle, batches above.
ITEM_BITS, FILE_BITS, BATCH_BITS = 26, 24, 13


def packed(high: Column, low: Column, bits: int, high_bits: int) -> Column:
    """``high`` above ``bits`` bits of ``low``; a number that does not fit ends the job."""

    def checked(c: Column, size: int) -> Column:
        over = F.concat(F.lit("ordinal part over its range: "), c.cast("string"))
        return F.when(c.between(0, (1 << size) - 1), c.cast("bigint")).when(c.isNotNull(), F.raise_error(over).cast("bigint"))

    return checked(high, high_bits) * F.lit(1 << bits) + checked(low, bits)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union of source batches. ``ord`` becomes (batch position, position in batch)."""
    out, bits = None, FILE_BITS + ITEM_BITS
    for rank, df in enumerate(frames):
        ranked = df.withColumn("ord", packed(F.lit(rank), F.col("ord"), bits, BATCH_BITS))
        out = ranked if out is None else out.unionByName(ranked, allowMissingColumns=True)
    return out
