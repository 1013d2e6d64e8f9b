"""Listing sources as Spark data sources: a plug-in says what its searches are and yields their postings.

    class Board(ListingSource):
        @classmethod
        def name(cls): return "board"
        def searches(self): return [("nurse", "Leeds")]
        def postings(self, keyword, location): yield {"job_id": "1", "title": "Nurse"}

    spark.dataSource.register(Board)
    raw = spark.read.format("board").load()

Each search is one partition, so searches run side by side and a failed one is repeated alone. As a stream the
searches are numbered, and a micro-batch takes those that were added since the last one.
"""

from __future__ import annotations

import io
import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .listings import RAW

# Plug-ins travel with their reader, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NAMES = [f.name for f in RAW.fields]
_SCHEMA = T.StructType([T.StructField("keyword", T.StringType()), T.StructField("search_location", T.StringType()),
                        T.StructField("pos", T.LongType()), *RAW.fields])


class Search(InputPartition):
    def __init__(self, keyword: str, location: str):
        self.keyword, self.location = keyword, location


def _text(value) -> str | None:
    """Fields are read as text, as from landed files; the normaliser casts."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value) if isinstance(value, (list, dict)) else str(value)


class _Rows:
    def __init__(self, source: ListingSource):
        self.source = source

    def read(self, partition: Search) -> Iterator[tuple]:
        for pos, item in enumerate(self.source.postings(partition.keyword, partition.location)):
            yield (partition.keyword, partition.location, pos, *(_text(item.get(n)) for n in _NAMES))


class _Reader(_Rows, DataSourceReader):
    def partitions(self) -> list[Search]:
        return [Search(*s) for s in self.source.searches()]


class _StreamReader(_Rows, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"searches": 0}

    def latestOffset(self) -> dict:
        return {"searches": len(self.source.searches())}

    def partitions(self, start: dict, end: dict) -> list[Search]:
        return [Search(*s) for s in self.source.searches()[start["searches"] : end["searches"]]]

    def commit(self, end: dict) -> None:
        pass


class ListingSource(DataSource):
    """Base of a plug-in; ``self.options`` holds what the reader was given."""

    def searches(self) -> list[tuple[str, str]]:
        """All (keyword, location) pairs; a stream's list only grows at its end."""
        raise NotImplementedError

    def postings(self, keyword: str, location: str) -> Iterator[dict]:
        """Postings of one search, as field names and values; called on an executor."""
        raise NotImplementedError

    def schema(self) -> T.StructType:
        return _SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(self)


class LandedSearches(ListingSource):
    """Searches that a fetcher landed below ``path``, a shared folder of any file system: JSON-lines files in folders
    ``search=<keyword>@<location>``, as a partitioned write makes them, in the order of their landing.

    A line that is no JSON object is left out; blank lines are common at the end of such files.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_searches"

    def _listed(self, folder: str = "") -> tuple:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.options["path"])
        found = files.get_file_info(fs.FileSelector(f"{root}/{folder}".rstrip("/")))
        return files, sorted((f for f in found if not f.base_name.startswith(("_", "."))), key=lambda f: (f.mtime_ns or 0, f.base_name))

    def searches(self) -> list[tuple[str, str]]:
        from urllib.parse import unquote

        names = [unquote(f.base_name.partition("=")[2]) for f in self._listed()[1] if f.base_name.startswith("search=")]
        return [tuple(n.split("@", 1)) for n in names if "@" in n]

    def postings(self, keyword: str, location: str) -> Iterator[dict]:
        from urllib.parse import unquote

        files, folders = self._listed()
        folder = next(f.base_name for f in folders if unquote(f.base_name) == f"search={keyword}@{location}")
        for info in self._listed(folder)[1]:
            with files.open_input_stream(info.path) as stream:
                for line in io.TextIOWrapper(stream, "utf-8"):
                    try:
                        item = json.loads(line)
                    except ValueError:
                        continue
                    if isinstance(item, dict):
                        yield item
