"""Company names against registers: exact similarity join, profiles, officers, search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.similarity import edit_similarity, near_names
from ..functions.text import join_parts, norm_name
from ..schema import filled

# Least similarity per register.
COMPANY_REGISTER_MIN = 0.75
CHARITY_REGISTER_MIN = 0.70
CARE_REGISTER_MIN = 0.70
# Names of a word that meet at once; results do not depend on it.
BLOCK_COMPANIES, BLOCK_NAMES = 1024, 2048


def _words(name: Column) -> Column:
    return F.array_distinct(F.filter(F.split(norm_name(name), " +"), lambda w: w != ""))


def _blocks(names: DataFrame, name: str, shared: DataFrame, size: int, part: str, held: Column, lists: str) -> DataFrame:
    """Lists of up to about ``size`` names that hold a word: (word, part, list)."""
    rows = names.withColumn("word", F.explode(_words(F.col(name)))).join(shared, "word")
    at = F.pmod(F.xxhash64(name), F.ceil(F.col(f"n_{part}") / size)).cast("int")
    return rows.groupBy("word", at.alias(part)).agg(F.collect_list(held).alias(lists))


def best_matches(
    companies: DataFrame, register: DataFrame, threshold: float, kind: str = "sequence"
) -> DataFrame:
    """Best register name per company among all names sharing a word with it, as a name search does.

    ``companies(company)`` and ``register(name, cand_ord)``; ratio on lower-cased raw names; ties
    go to the earliest candidate. Names are first made distinct, so a name held by many rows is
    compared once. The names that share a word meet in blocks of bounded size, each of which is one row; no pair
    becomes a row unless it may reach the threshold, and of the sequence ratio only the best of a
    block does. There is no limit on candidates. ``kind='edit'`` takes the edit distance JVM-side.
    """
    left = companies.where(filled("company")).select("company", F.lower("company").alias("a"))
    right = register.where(filled("name")).select("cand_ord", F.lower("name").alias("b"))
    names_a = left.select("a").distinct()
    names_b = right.groupBy("b").agg(F.min("cand_ord").alias("cand_ord"))

    def sizes(df: DataFrame, name: str, part: str) -> DataFrame:
        return df.select(F.explode(_words(F.col(name))).alias("word")).groupBy("word").agg(F.count("*").alias(f"n_{part}"))

    shared = sizes(names_a, "a", "pa").join(sizes(names_b, "b", "pb"), "word")
    blocks_a = _blocks(names_a, "a", shared, BLOCK_COMPANIES, "pa", F.col("a"), "as_")
    blocks_b = _blocks(names_b, "b", shared, BLOCK_NAMES, "pb", F.struct("b", "cand_ord"), "bs")
    # Every block of a word's companies is a key of its own, so that a word of many names is many tasks' work.
    parts = shared.select("word", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_pa") / BLOCK_COMPANIES).cast("int") - 1)).alias("pa"))
    met = blocks_a.join(blocks_b.join(parts, "word"), ["word", "pa"])
    # Blocks are small and comparing them is long: dealt out by number, as by size they would all come to one task.
    tasks = 3 * companies.sparkSession.sparkContext.defaultParallelism
    met = met.repartition(tasks, "word", "pa", "pb").select(
        "as_", F.transform("bs", lambda x: x["b"]).alias("bs"), F.transform("bs", lambda x: x["cand_ord"]).alias("ords"))
    ord_type = register.schema["cand_ord"].dataType.simpleString()
    pairs = met.mapInPandas(near_names(threshold, kind), f"a string, b string, cand_ord {ord_type}, score double")
    if kind == "edit":
        pairs = pairs.withColumn("score", edit_similarity(F.col("a"), F.col("b"))).where(F.col("score") >= threshold)
    best = pairs.groupBy("a").agg(
        F.min_by(F.struct("b", "cand_ord", "score"), F.struct((-F.col("score")).alias("s"), "cand_ord")).alias("m")
    )
    return left.join(best, "a").select(
        "company", F.col("m.cand_ord").alias("cand_ord"), F.col("m.score").alias("score")
    )


def first_active_officer(officers: DataFrame) -> DataFrame:
    """First officer still in office whose role names a secretary, director or manager."""
    active = F.coalesce(F.col("resigned_on"), F.lit("")) == ""
    role = F.lower(F.coalesce("officer_role", F.lit(""))).rlike("secretary|director|manager")
    return (
        officers.where(active & role)
        .groupBy("company_number")
        .agg(F.min_by("name", "officer_ord").alias("contact_person"))
    )


def not_dissolved(status: Column) -> Column:
    return ~status.eqNullSafe("dissolved")


def register_address(addr: Column) -> Column:
    return join_parts(
        *[
            addr[k]
            for k in (
                "premises", "address_line_1", "address_line_2", "locality", "region",
                "postal_code", "country",
            )
        ]
    )


def company_register_parts(
    companies: DataFrame, register: DataFrame, officers: DataFrame,
    threshold: float = COMPANY_REGISTER_MIN, kind: str = "sequence",
) -> DataFrame:
    """Companies to contact fields of their best register entry; a dissolved best match gives none."""
    hits = best_matches(companies, register.withColumnRenamed("title", "name"), threshold, kind)
    profile = register.select(
        "cand_ord", "company_number", "company_type", "company_status",
        register_address(F.col("registered_office_address")).alias("address"),
    )
    out = hits.join(profile, "cand_ord").where(not_dissolved(F.col("company_status")))
    out = out.join(first_active_officer(officers), "company_number", "left")
    return out.where(filled("address") | filled("company_number")).select(
        "company", "company_number", "company_type", "address", "contact_person",
        F.array(F.lit("companies_house")).alias("enrichment_sources"),
    )


def top_links(hits: DataFrame, n: int = 2) -> DataFrame:
    """First ``n`` links per company, by rank."""
    r = F.row_number().over(W.partitionBy("company").orderBy("rank"))
    return hits.withColumn("link_ord", r).where(F.col("link_ord") <= n)


def guess_sites(companies: DataFrame, known_sites: DataFrame, candidates: Column) -> DataFrame:
    """First candidate site of each company that is known to exist (``known_sites(url)``)."""
    c = companies.select("company", F.posexplode(candidates).alias("pos", "url"))
    hit = c.join(known_sites.select("url").distinct(), "url", "left_semi")
    return hit.groupBy("company").agg(F.min_by("url", "pos").alias("company_url"))

