"""Paged providers as a Spark data source.

A provider answers ``fetch_page(query, cursor)`` with (papers, next cursor,
exhausted). Each query is one partition; its pages are read in order until the
provider is exhausted. Register with ``register(spark, name, factory)``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Provider(Protocol):
    def fetch_page(self, query: str, cursor: str | None) -> tuple[list[dict], str | None, bool]: ...


class _Query(InputPartition):
    def __init__(self, text: str) -> None:
        super().__init__(text)
        self.text = text


class _Reader(DataSourceReader):
    def __init__(self, factory: Callable[[dict], Provider], options: dict) -> None:
        self.factory, self.options = factory, options

    def partitions(self) -> list[InputPartition]:
        return [_Query(q) for q in json.loads(self.options["queries"])]

    def read(self, partition: _Query) -> Iterator[tuple]:
        provider, cursor = self.factory(dict(self.options)), None
        ordinal, pages, most = 0, 0, int(self.options.get("max_pages", "1000000"))
        while pages < most:
            papers, cursor, exhausted = provider.fetch_page(partition.text, cursor)
            for p in papers:
                yield (partition.text, ordinal, json.dumps(p))
                ordinal += 1
            pages += 1
            if exhausted or cursor is None:
                return


def register(spark: SparkSession, name: str, factory: Callable[[dict], Provider]) -> None:
    """Make ``spark.read.format(name).option('queries', json).load()`` give ``query, ordinal, paper``."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "query string, ordinal int, paper string"

        def reader(self, schema) -> DataSourceReader:
            return _Reader(factory, dict(self.options))

    spark.dataSource.register(Source)


class StoredPages:
    """A provider over pages in memory: {query: [[paper, ...], ...]}; the cursor is the page's number."""

    def __init__(self, pages: dict[str, list[list[dict]]]) -> None:
        self.pages = pages

    def fetch_page(self, query: str, cursor: str | None) -> tuple[list[dict], str | None, bool]:
        at = int(cursor or 0)
        pages = self.pages.get(query, [])
        if at >= len(pages):
            return [], None, True
        return pages[at], str(at + 1), at + 1 >= len(pages)
