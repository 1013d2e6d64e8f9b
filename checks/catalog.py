"""All checked queries: name -> (Spark function of Inputs, DuckDB SQL or None)."""

from __future__ import annotations

from vacancia.session import SETTINGS

from . import catalog_entities, catalog_extract
from .fixtures import Inputs

QUERIES = {**catalog_extract.QUERIES, **catalog_entities.QUERIES}
_OPEN: dict = {}


def inputs(spark, sf_dir: str) -> Inputs:
    """Views are set up once per session and folder; they are lazy and hold no rows."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if _OPEN.get("key") != key:
        for name in ("spark.sql.session.timeZone", "spark.sql.sources.fileCompressionFactor"):
            spark.conf.set(name, SETTINGS[name])
        _OPEN.update(key=key, inputs=Inputs(spark, sf_dir))
    return _OPEN["inputs"]
