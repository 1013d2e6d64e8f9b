"""Queries opN_<name> over the whole given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, embeddings, exact_dedup, minhash, mixing, periodic, prefix_trie, quality, secrets, sharding
from . import token_counts, toxicity
from .common import table

SHARDS = 16


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = bpe.encode_documents(_documents(spark, sf_dir), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(bpe.id_text("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_documents(spark, sf_dir), SHARDS)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_documents(spark, sf_dir))
    return secrets.with_digests(found)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels")).drop("text_hash")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), k=4, per_cent=80)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(_documents(spark, sf_dir), repeat_limit=3.0, entropy=0.97)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_elements(table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.prefix_nodes(prefix_trie.spliced(turns))
    none = F.sha2(F.lit(""), 256)
    return nodes.withColumn("ends_sha256", F.coalesce("ends", none)).drop("ends")


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_spans(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return decontaminate.with_digests(found).drop("spans")


def periodic_tail(doc_id: int | None):
    """Makes the texts of every tenth document periodic from some word on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10

    def rebuild(words: np.ndarray) -> np.ndarray:
        n = len(words)
        if not n:
            return words
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return np.concatenate([words[:a], words[a + np.arange(n - a) % p]])

    return rebuild


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.with_digests(periodic.periodic_runs(_documents(spark, sf_dir), rebuild=periodic_tail))


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("op")}
# A-Z to lower case, as the operators do it.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: SQL of the queries that it can express; the others are tested against brute force.
SQL: dict[str, str] = {
    "op9_exact_dedup": """WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS sha FROM documents),
        k AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size FROM t WINDOW w AS (PARTITION BY sha ORDER BY chars DESC, doc_id))
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM k""",
    "op12_decontaminate": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, len(w[i : i + 9]) AS k, w[i : i + 9] AS win FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) u(i) WHERE len(w) > 0),
        ks AS (SELECT DISTINCT k FROM bw),
        dw AS (SELECT doc_id, i, k, w[i : i + k - 1] AS win FROM d, ks, unnest(range(1, len(w) - k + 2)) u(i)),
        hits AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON bw.k = dw.k AND bw.win = dw.win),
        marked AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM hits, unnest(range(i, i + k)) u(x) GROUP BY doc_id),
        found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hits GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN marked ON marked.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id""",
}
