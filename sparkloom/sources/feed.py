"""A feed that is read page by page behind a cursor, as a data source for batch and stream reads.

The feed is a folder of Parquet files whose names rise with time, as a crawler
that stores what an interface returns writes them.  A cursor is a file and a
row in it: a stream goes on behind the one that its checkpoint holds, so a
restart loses and repeats nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NAME = "paged_feed"

#: Rows of a page, and pages that a task asks for.
PAGE, PAGES_PER_TASK = 1000, 16


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") or "://" not in path:
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Pages(InputPartition):
    """Rows ``lo`` to ``hi`` of a file."""

    file: str
    lo: int
    hi: int


class _Feed:
    """Listing, cutting into pages and reading, for both kinds of readers."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.page = int(options.get("page", PAGE))
        self.limit = int(options["limit"]) if "limit" in options else None

    def counts(self, after: str = "") -> list[tuple[str, int]]:
        """(name, rows) of the files from ``after`` on, in order of name; rows are read off the files' ends."""
        fs, root = _system(self.path)
        names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(root)) if f.base_name.endswith(".parquet") and f.base_name[0] not in "._")
        return [(n, pq.read_metadata(f"{root}/{n}", filesystem=fs).num_rows) for n in names if n >= after]

    def cut(self, ranges: list[tuple[str, int, int]]) -> list[Pages]:
        """Whole pages, some to a task; with a limit no page is asked for once enough rows are there."""
        out, rows, step = [], 0, self.page * (1 if self.limit else PAGES_PER_TASK)
        for name, lo, hi in ranges:
            for at in range(lo, hi, step):
                if self.limit is not None and rows >= self.limit:
                    return out
                out.append(Pages(name, at, min(hi, at + step)))
                rows += out[-1].hi - at
        return out

    def read(self, partition: Pages | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where there is no page
            return
        fs, root = _system(self.path)
        wanted = to_arrow_schema(self.schema)
        with fs.open_input_file(f"{root}/{partition.file}") as source:
            file, begin = pq.ParquetFile(source), 0
            for group in range(file.num_row_groups):
                end = begin + file.metadata.row_group(group).num_rows
                if end > partition.lo and begin < partition.hi:
                    at = begin
                    for batch in file.iter_batches(self.page, row_groups=[group], columns=wanted.names):
                        lo, hi = max(partition.lo - at, 0), min(partition.hi - at, batch.num_rows)
                        if hi > lo:
                            yield from pa.Table.from_batches([batch.slice(lo, hi - lo)]).select(wanted.names).cast(wanted).to_batches()
                        at += batch.num_rows
                begin = end


class _Search(_Feed, DataSourceReader):
    """A paged search: all pages, or whole pages until ``limit`` rows are there."""

    def partitions(self) -> list[Pages]:
        return self.cut([(name, 0, n) for name, n in self.counts()])


class _Follow(_Feed, DataSourceStreamReader):
    """What came since the cursor."""

    def initialOffset(self) -> dict:
        return {"file": "", "row": 0}

    def latestOffset(self) -> dict:
        there = self.counts()
        return {"file": there[-1][0], "row": there[-1][1]} if there else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        found = [(n, start["row"] if n == start["file"] else 0, end["row"] if n == end["file"] else rows) for n, rows in self.counts(start["file"]) if n <= end["file"]]
        return self.cut(found)


class PagedFeed(DataSource):
    """``spark.read`` or ``spark.readStream`` with format ``paged_feed``, a schema, and options path, page and, for reads, limit."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Search(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Follow(schema, {k: v for k, v in self.options.items() if k != "limit"})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedFeed)
