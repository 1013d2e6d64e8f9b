"""Landed replies of an outside model about postings: structure, company and contacts filled where they lack.

A reply never overwrites. Phones and e-mails count only if they are printed in the posting's own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.phones import clean_phone
from ..functions.text import clean_email, strip
from ..schema import filled, first_filled, has_items
from ..sources.registers import literal_guard, parse_response
from .contacts import two_lists

# Fixed value: entries of a list that are taken from a reply.
LIST_ITEMS = 8
_FIELDS = "requirements array<string>, benefits array<string>, company_name string, phone string, email string"


def _items(c: Column) -> Column:
    return F.slice(F.filter(c, filled), 1, LIST_ITEMS)


def apply_replies(postings: DataFrame, seeds: DataFrame, replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, seed contacts) with ``replies(ord, provider, raw_response)`` applied, one at most for each posting.

    Empty ``requirements`` and ``benefits`` take the reply's first entries, a missing company its name; their origin
    is ``<provider>_description``. Contacts join the seeds of the posting's company, behind the values found in texts.
    An unreadable reply changes nothing, and no posting is lost or repeated.
    """
    read = replies.select(
        "ord", F.concat(first_filled("provider", F.lit("ai")), F.lit("_description")).alias("_tag"),
        parse_response(F.col("raw_response"), _FIELDS).alias("_r"),
    ).where(F.col("_r").isNotNull())
    j = postings.join(read, "ord", "left")
    name = F.col("_r.company_name")
    takes = {c: has_items(f"_r.{c}") & ~has_items(c) for c in ("requirements", "benefits")}
    takes["company"] = filled(name) & (name != "null") & ~filled("company")
    new = {c: _items(F.col(f"_r.{c}")) for c in ("requirements", "benefits")} | {"company": strip(name)}
    pairs = F.array(*[F.when(t, F.struct(F.lit(c).alias("key"), F.array("_tag").alias("value"))) for c, t in takes.items()])
    gained = F.map_from_entries(F.array_compact(pairs))
    known = F.coalesce("field_sources", F.create_map().cast("map<string,array<string>>"))
    kept = F.map_filter(known, lambda k, v: ~F.map_contains_key(gained, k))
    done = j.withColumns(
        {c: F.when(t, new[c]).otherwise(F.col(c)) for c, t in takes.items()} | {"field_sources": F.map_concat(kept, gained)}
    )
    phone, email = literal_guard(F.col("description"), clean_phone(F.col("_r.phone")), clean_email(F.col("_r.email")))
    found = done.where(F.col("_r").isNotNull() & filled("company") & filled("description")).select(
        "company", F.lit(1).alias("stage"), "ord", F.lit(0).alias("pos"),
        F.explode(F.array(F.struct(F.lit("phone").alias("kind"), phone.alias("value")), F.struct(F.lit("email").alias("kind"), email.alias("value")))).alias("v"),
    ).select("company", "stage", "ord", "pos", "v.*").where(F.col("value").isNotNull())
    old = seeds.select("company", F.explode(F.create_map(F.lit("phone"), "phone_numbers", F.lit("email"), "emails")).alias("kind", "vals"))
    old = old.select(
        "company", F.lit(0).alias("stage"), F.lit(0).cast("bigint").alias("ord"), F.posexplode("vals").alias("pos", "value"), "kind"
    )
    long = old.unionByName(found).select("company", "kind", "value", F.struct("stage", "ord", "pos").alias("o"))
    merged = two_lists(long).withColumn("enrichment_sources", F.array(F.lit("job_description")))
    return done.select(*postings.columns), merged
