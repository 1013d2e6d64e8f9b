"""Session settings and the shared scratch folder for iterative jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Columns of names and titles are a tenth of their size in files: joins are planned by the size of the rows,
    # so that no table is sent through the driver that only looks small.
    "spark.sql.sources.fileCompressionFactor": "10",
}


def build_session(app: str = "vacancia", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a machine-local
    folder would lose the data together with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="vacancia-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor costs a re-read and not a replay of every round."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def landed(df: DataFrame) -> DataFrame:
    """``df`` stored once as columns in the shared folder and read back.

    Unlike a checkpoint the rows are calculated once, are compressed, and come back with their true size: estimates
    and constraints of earlier plans do not pile up in loops. The shuffle files of the job are dropped when they are stored.
    """
    path = work_dir(df.sparkSession, "landed")
    with brief_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs inside drop their shuffle files when they end, for steps whose results are all stored; the setting is put back.

    Otherwise the files of every step stay on disk until the driver happens to collect its garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
