"""What the classifiers share: which rows may teach, and labels joined to texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the identifier as text, modulo ``folds``; -1 for a null identifier."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % folds, F.lit(-1))


def teaching_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """``id, y`` of the rows that may teach: labelled 0 or 1 and not held out.

    An identifier with several labels counts once, with the largest.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(fold("doc_id", folds) != held_out)
    return known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).cast("int").alias("y"))


def labelled(docs: DataFrame, marks: DataFrame, folds: int, held_out: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, y`` of the documents that have one of the ``marks`` (id, y)."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    return texts.where(fold("id", folds) != held_out).join(marks, "id")


def sampled(key: str, share: float) -> Column:
    """Whether a row is in a hash sample of that share, which may be as small as 2^-50."""
    hashed = F.xxhash64(key)
    low, whole = F.pmod(hashed, F.lit(1 << 20)), int(share * (1 << 20))
    # Where the first bits are just those of the share, the next ones decide.
    rest = F.pmod(F.shiftright(hashed, 20), F.lit(1 << 30)) < int((share * (1 << 20) - whole) * (1 << 30))
    return (low < whole) | ((low == whole) & rest)
