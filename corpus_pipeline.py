"""A training corpus from raw documents: five stages, each written and read again as Parquet.

Toxic documents go, then exact copies, then all but one document of each near-duplicate group (five-word
shingles, similarity 0.8); the sources are mixed, none below its own size; the texts become token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm import bpe, exact_dedup, minhash, mixing, toxicity
from vacancia.llm.common import table
from vacancia.session import work_dir

#: No source is used more than so often; the largest is used once.
REPEAT_LIMIT = 1.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one_of_each(docs, k=5, per_cent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, repeat_limit=REPEAT_LIMIT)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids, restored``: token ids, and whether they decode to the text."""
    import public_tokenizers

    rows = docs.select("doc_id", "source", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    coded = bpe.encode_documents(
        rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=("source", "digest")
    )
    return coded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.sha2("decoded", 256) == F.col("digest")).alias("restored"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_dedup", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
