"""A paged feature service as a Spark data source: one partition per planned page, read by the executors.

Options: ``url``; ``page_size``; ``fields`` (comma-separated attributes); ``fetch`` names a function ``module:function(url, offset, count) -> dict``
that gets one page, and ``count`` a function ``module:function(url) -> int`` that asks how many features there are, so that tests and other
transports need no network; ``pages`` plans so many pages without asking; ``tasks`` is how many partitions share them at most.

The plan only spreads the work: the last partition goes on until the service no longer says ``exceededTransferLimit``, so features that are
added meanwhile come too, and a partition whose page comes back short while the service says so asks for the rest of it. An error inside
a good answer raises, and so does a page with more features than were asked for, which would come twice.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def http(url: str, tries: int = 3, **query) -> dict:
    """An answer by HTTP, with growing pauses between tries; an error inside a good response is an error."""
    text = urllib.parse.urlencode({"where": "1=1", "f": "json"} | query)
    for k in range(tries):
        try:
            with urllib.request.urlopen(f"{url}{'&' if '?' in url else '?'}{text}", timeout=60) as r:
                return checked(json.load(r), url)
        except OSError:
            if k == tries - 1:
                raise
            time.sleep(2**k)
    raise AssertionError


def checked(page: dict, url: str) -> dict:
    """The answer, unless it is an error."""
    if "error" in page:
        raise OSError(f"{url}: {page['error']}")
    return page


def http_page(url: str, offset: int, count: int) -> dict:
    """One page by HTTP, in the order of the features' own ids."""
    return http(url, outFields="*", orderByFields="OBJECTID", resultOffset=offset, resultRecordCount=count)


def http_count(url: str) -> int:
    """How many features the service says it has."""
    return int(http(url, returnCountOnly="true")["count"])


def function(name: str):
    """``module:function``."""
    module, _, name = name.partition(":")
    return getattr(importlib.import_module(module), name)


class Page(InputPartition):
    """Features ``offset`` to ``end``; the last one has no end."""

    def __init__(self, offset: int, end: int | None):
        self.offset, self.end = offset, end


class Reader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.options, self.names = options, [f.name for f in schema]

    def partitions(self) -> list[Page]:
        size = int(self.options.get("page_size", 1000))
        if "pages" in self.options:
            pages = int(self.options["pages"])
        elif "fetch" in self.options and "count" not in self.options:
            pages = 1  # a transport of its own that cannot be asked
        else:
            pages = max(1, -(-function(self.options.get("count", f"{__name__}:http_count"))(self.options["url"]) // size))
        tasks = min(pages, int(self.options.get("tasks", pages)))
        if pages < 1 or size < 1 or tasks < 1:
            raise ValueError(f"pages, page_size and tasks must be at least 1, not {pages}, {size} and {tasks}")
        begins = [i * pages // tasks * size for i in range(tasks)]
        return [Page(a, b) for a, b in zip(begins, [*begins[1:], None], strict=True)]

    def read(self, partition: Page) -> Iterator[tuple]:
        fetch, size, url = function(self.options.get("fetch", f"{__name__}:http_page")), int(self.options.get("page_size", 1000)), self.options["url"]
        offset = partition.offset
        while partition.end is None or offset < partition.end:
            asked = size if partition.end is None else min(size, partition.end - offset)
            page = checked(fetch(url, offset, asked), url)
            features = page.get("features", [])
            if len(features) > asked:
                raise OSError(f"{url} sends {len(features)} features at offset {offset} where {asked} were asked for")
            for f in features:
                values = f.get("attributes", {})
                yield tuple(None if values.get(n) is None else str(values[n]) for n in self.names)
            offset += len(features)
            if not page.get("exceededTransferLimit", False):
                break
            if not features:
                raise OSError(f"{url} has more features at offset {offset} but sends none")


class FeatureService(DataSource):
    @classmethod
    def name(cls) -> str:
        return "features"

    def schema(self) -> str:
        return ", ".join(f"`{f.strip()}` string" for f in self.options["fields"].split(","))

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("features")`` known."""
    spark.dataSource.register(FeatureService)


def sample_page(url: str, offset: int, count: int) -> dict:
    """A service of five wells, for trials without a network."""
    rows = [{"attributes": {"api": i, "lat": 30.0 + i}} for i in range(offset, min(5, offset + count))]
    return {"features": rows, "exceededTransferLimit": offset + count < 5}
