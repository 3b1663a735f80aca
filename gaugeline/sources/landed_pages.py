"""Landed result pages as a data source: ``spark.read.format("landed_pages")`` and ``spark.readStream``.

Pages lie in ``query_no=<n>/page=<p>/`` below a folder, one text file each, which may be compressed
(.gz), and come as rows (query_no, page, body). A batch read is cut into partitions of ``pages_per_partition`` pages, and conditions on
``query_no`` and ``page`` leave out files before any is opened. The offset of a stream holds, for every query, how far
its pages were read, so its size does not grow with the pages; a query's pages must land in rising order.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

FORMAT = "landed_pages"
SCHEMA = "query_no int, page int, body string"
PAGES_PER_PARTITION = 50

_PLACE = re.compile(r"query_no=(\d+)/page=(\d+)/[^/_.][^/]*$")
_TESTS = {
    EqualTo: lambda have, wanted: have == wanted,
    In: lambda have, wanted: have in wanted,
    GreaterThan: lambda have, wanted: have > wanted,
    GreaterThanOrEqual: lambda have, wanted: have >= wanted,
    LessThan: lambda have, wanted: have < wanted,
    LessThanOrEqual: lambda have, wanted: have <= wanted,
}


@dataclass(frozen=True)
class Page:
    query_no: int
    page: int
    path: str


@dataclass
class Pages(InputPartition):
    pages: list[Page]


def _open(path: str):
    from pyarrow import fs

    address = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), address) if address.startswith("/") else fs.FileSystem.from_uri(address)


def find_pages(folder: str) -> list[Page]:
    """All landed pages by query and page; none if the folder is not there."""
    from pyarrow import fs

    system, root = _open(folder)
    found = []
    for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True)):
        place = _PLACE.search(info.path)
        if place and info.type == fs.FileType.File:
            found.append(Page(int(place[1]), int(place[2]), info.path))
    return sorted(found, key=lambda p: (p.query_no, p.page, p.path))


def read_pages(folder: str, part: Pages) -> Iterator[tuple]:
    system, _ = _open(folder)
    for page in part.pages:
        with system.open_input_stream(page.path) as stream:
            for line in stream.read().decode("utf-8").split("\n"):
                if line:
                    yield page.query_no, page.page, line


def in_parts(pages: list[Page], size: int) -> list[Pages]:
    """Parts of ``size`` pages; one empty part where there are none, as a read needs a part."""
    return [Pages(pages[i:i + size]) for i in range(0, len(pages), size)] or [Pages([])]


class PageReader(DataSourceReader):
    def __init__(self, folder: str, size: int):
        self.folder, self.size, self.filters = folder, size, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for condition in filters:
            if type(condition) in _TESTS and condition.attribute in (("query_no",), ("page",)):
                self.filters.append(condition)
            else:
                yield condition

    def wanted(self, page: Page) -> bool:
        return all(
            _TESTS[type(f)](getattr(page, f.attribute[0]), f.value) for f in self.filters)

    def partitions(self) -> list[Pages]:
        return in_parts([p for p in find_pages(self.folder) if self.wanted(p)], self.size)

    def read(self, partition: Pages) -> Iterator[tuple]:
        return read_pages(self.folder, partition)


class PageStreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, size: int):
        self.folder, self.size = folder, size

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        last: dict[str, int] = {}
        for page in find_pages(self.folder):
            last[str(page.query_no)] = max(page.page, last.get(str(page.query_no), -1))
        return last

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        new = [p for p in find_pages(self.folder)
               if start.get(str(p.query_no), -1) < p.page <= end.get(str(p.query_no), -1)]
        return in_parts(new, self.size)

    def read(self, partition: Pages) -> Iterator[tuple]:
        return read_pages(self.folder, partition)


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _arguments(self) -> tuple[str, int]:
        return self.options["path"], int(self.options.get("pages_per_partition", PAGES_PER_PARTITION))

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(*self._arguments())

    def streamReader(self, schema: StructType) -> PageStreamReader:
        return PageStreamReader(*self._arguments())


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let conditions reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedPages)


def write_pages(pages: DataFrame, folder: str) -> None:
    """Land pages of (query_no, page, body), a row a page: one compressed file for each, beside those that are there."""
    (pages.select("query_no", "page", "body")
     .write.mode("append").partitionBy("query_no", "page").text(folder, compression="gzip"))


def read_landed(spark: SparkSession, folder: str, pages_per_partition: int = PAGES_PER_PARTITION) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).option("pages_per_partition", pages_per_partition).load(folder)


def stream_landed(spark: SparkSession, folder: str, pages_per_partition: int = PAGES_PER_PARTITION) -> DataFrame:
    register(spark)
    return spark.readStream.format(FORMAT).option("pages_per_partition", pages_per_partition).load(folder)
