"""Row counts of the stages of a job, observed while its rows pass, so that no stage is run again to be counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class StageCounts:
    """Counts of named stages. ``at`` marks a place in a plan; ``n`` is known once a job has run through it.

    The first job counts. A stage that Spark repeats after losing an executor may add its rows again: counts that
    decide something are taken from stored rows, these are for reports.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def at(self, stage: str, df: DataFrame, **more: Column) -> DataFrame:
        """``df``, counted as ``stage``; ``more`` are further aggregates under their names."""
        self._seen[stage] = Observation()
        return df.observe(self._seen[stage], F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in more.items()])

    def n(self, stage: str, name: str = "n") -> int:
        return self._seen[stage].get[name]

    def stages(self) -> list[str]:
        return list(self._seen)
