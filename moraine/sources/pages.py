"""A paged source as a Python data source: one partition a page, read from a landing folder or a fetcher.

``spark.read.format("moraine_pages").option("dir", landing).load()`` reads pages that were landed as JSON lists named
page-00000000.json, page-00001000.json, ... by their offset. ``land`` fetches pages with retries and writes each whole or not at
all, so that a later call goes on where the last one stopped.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def cache_name(endpoint: str, params: dict) -> str:
    """A request's file name: empty parameters do not count."""
    kept = {k: v for k, v in sorted(params.items()) if v not in (None, "")}
    return hashlib.sha256(json.dumps([endpoint, kept], sort_keys=True, default=str).encode()).hexdigest() + ".json"


def land(fetch: Callable[[int, int], list], folder: str, page: int = 1000, most: int | None = None, retries: int = 3, pause: float = 0.1) -> int:
    """Fetch pages (offset, size) until a short one; how many rows there are. Pages that are there already are not fetched."""
    os.makedirs(folder, exist_ok=True)
    offset = rows = 0
    while most is None or offset < most:
        path = os.path.join(folder, f"page-{offset:08d}.json")
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                got = json.load(f)
        else:
            for attempt in range(retries + 1):
                try:
                    got = fetch(offset, page if most is None else min(page, most - offset))
                    break
                except OSError:
                    if attempt == retries:
                        raise
                    time.sleep(pause * 2**attempt)
            with open(path + ".part", "w", encoding="utf-8") as f:
                json.dump(got, f)
            os.replace(path + ".part", path)
        rows += len(got)
        if len(got) < page:
            break
        offset += page
    return rows


class Page(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PageReader(DataSourceReader):
    def __init__(self, folder: str, fields: list[str]):
        self.folder, self.fields = folder, fields

    def partitions(self) -> list[Page]:
        return [Page(os.path.join(self.folder, n)) for n in sorted(os.listdir(self.folder)) if n.endswith(".json")]

    def read(self, partition: Page) -> Iterator[tuple]:
        with open(partition.path, encoding="utf-8") as f:
            for row in json.load(f):
                yield tuple(None if row.get(k) is None else str(row[k]) for k in self.fields)


class PageSource(DataSource):
    """Options: dir (a folder every executor can read), fields (comma-separated names)."""

    @classmethod
    def name(cls) -> str:
        return "moraine_pages"

    def schema(self) -> str:
        return ", ".join(f"`{f}` string" for f in self.options["fields"].split(","))

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["dir"], [f.name for f in schema.fields])
