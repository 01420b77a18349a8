"""spark.read.format("paged"): skip/limit pages as a Spark source, one partition a page, fetched by executors."""

from __future__ import annotations

import json

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Page(InputPartition):
    def __init__(self, skip: int):
        self.skip = skip


class PagedSource(DataSource):
    """Options: url, pageSize, maxRecords.  Rows are the records' JSON text.  A page beyond the end has no rows."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "skip long, record string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.url, self.size, self.most = options["url"], int(options.get("pageSize", "1000")), int(options.get("maxRecords", "5000"))

    def partitions(self) -> list[InputPartition]:
        return [Page(s) for s in range(0, self.most, self.size)]

    def read(self, partition):
        from urllib.request import urlopen

        with urlopen(f"{self.url}{'&' if '?' in self.url else '?'}limit={self.size}&skip={partition.skip}", timeout=60) as answer:
            records = json.loads(answer.read()).get("results") or []
        for r in records:
            yield partition.skip, json.dumps(r, sort_keys=True)
