"""Answers of a web service, page by page, at a gentle pace."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def get_json(url: str, params: dict | None = None, retries: int = 4, delay: float = 1.0, timeout: float = 30.0, sleep=time.sleep):
    """The parsed answer, or None when all tries failed. Between tries it waits ``delay`` times a
    doubling factor, five seconds more where the service asks to slow down."""
    full = f"{url}?{urllib.parse.urlencode(params)}" if params else url
    for k in range(retries):
        try:
            with urllib.request.urlopen(full, timeout=timeout) as answer:
                return json.loads(answer.read().decode("utf-8", errors="replace"))
        except urllib.error.HTTPError as e:
            pause = delay * 2**k + (5 if e.code == 429 else 0)
        except (urllib.error.URLError, OSError, ValueError):
            pause = delay * 2**k
        if k + 1 < retries:
            sleep(pause)
    return None


def is_empty(answer) -> bool:
    """No record in any of the places where an answer may hold them."""
    data = answer.get("data", []) if isinstance(answer, dict) else answer
    if isinstance(data, dict):
        data = data.get("hadiths") or data.get("results")
    return not data


class PagedJson(DataSource):
    """Spark source ``paged_json``: one row ``query, page, answer`` a page, up to the first empty one.

    Options: ``url``; ``queries``, one a line; ``pages``, at most (1); ``delay`` between requests in
    seconds, at least 0.5; ``retries`` (4). One task asks for everything, as the pace is that of
    the service and not of the cluster.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "query string, page int, answer string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.url, self.queries = options["url"], [q for q in options.get("queries", "").split("\n") if q]
        self.pages, self.delay, self.retries = int(options.get("pages", 1)), float(options.get("delay", 1.0)), int(options.get("retries", 4))
        if self.delay < 0.5:
            raise ValueError("delay must be 0.5 seconds or more")

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition) -> Iterator[tuple]:
        for query in self.queries:
            for page in range(1, self.pages + 1):
                answer = get_json(self.url, {"value": query, "page": page}, self.retries, self.delay)
                if answer is None or is_empty(answer):
                    break
                yield query, page, json.dumps(answer, ensure_ascii=False)
                time.sleep(self.delay)
