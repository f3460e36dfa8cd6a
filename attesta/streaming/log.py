"""An append-only log of micro-batches with compaction: what T1, T2, T4 and T5 land in."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from attesta.sources import folders

#: So many neighbouring folders that hold equally many batches become one.
FAN = 8


class BatchLog:
    """Rows by micro-batch in Parquet folders `<path>/span=<first>-<last>`, partitioned by `by`.

    A batch that is tried again replaces its own folder. `compact` turns FAN neighbours into one, which then counts as soon as it is committed; what it replaces is deleted after that, so a reader, or a crash, at any
    point finds each batch once. A row is rewritten once for each power of FAN, and the folders stay about FAN times the logarithm of the batches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: str | None = None):
        self.spark, self.path, self.schema, self.by = spark, path, schema, by

    def _folder(self, span: tuple[int, int]) -> str:
        return f"{self.path}/span={span[0]}-{span[1]}"

    def spans(self) -> list[tuple[int, int]]:
        """The committed folders, by their first and last batch: the wider of those that overlap."""
        found = [tuple(map(int, n[5:].split("-"))) for n in folders.names(self.spark, self.path) if n.startswith("span=") and folders.complete(self.spark, f"{self.path}/{n}")]
        out: list[tuple[int, int]] = []
        for span in sorted(found, key=lambda s: (s[0], -s[1])):
            if not out or span[0] > out[-1][1]:
                out.append(span)
        return out

    def last(self) -> int:
        return max((b for _, b in self.spans()), default=-1)

    def write(self, rows: DataFrame, first: int, last: int | None = None) -> None:
        writer = rows.select(*self.schema.names).write.mode("overwrite")
        (writer.partitionBy(self.by) if self.by else writer).parquet(self._folder((first, first if last is None else last)))

    def values(self, spans: Iterable[tuple[int, int]]) -> set[str]:
        """The values of `by` that these folders hold: names of folders, no file is opened."""
        return {n for span in spans for n in folders.names(self.spark, self._folder(span)) if n.startswith(f"{self.by}=")}

    def read(self, spans: Iterable[tuple[int, int]], only: set[str] | None = None) -> DataFrame:
        """The rows of these folders; with `only`, of these partitions of them (names as `values` gives them). Nothing else is listed or read."""
        out = None
        for span in spans:
            folder = self._folder(span)
            paths = [folder] if only is None else [f"{folder}/{n}" for n in folders.names(self.spark, folder) if n in only]
            if paths:
                rows = self.spark.read.schema(self.schema).option("basePath", folder).parquet(*paths).select(*self.schema.names)
                out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], self.schema) if out is None else out

    def all(self) -> DataFrame:
        return self.read(self.spans())

    def compact(self, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows, fan: int = FAN) -> None:
        """Turns `fan` neighbouring folders of equal width into one, until there are none; `merge` may reduce their rows."""
        while True:
            spans = self.spans()
            width = lambda s: s[1] - s[0] + 1
            group = next((spans[i:i + fan] for i in range(len(spans) - fan + 1) if len({width(s) for s in spans[i:i + fan]}) == 1), None)
            if not group:
                return
            self.write(merge(self.read(group)), group[0][0], group[-1][1])
            for span in group:
                folders.remove(self.spark, self._folder(span))
