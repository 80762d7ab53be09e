"""One latest row per entity, cut by a hash of the key: stored parts plus pushed rows not yet folded in.

Beside the folders of ``parted``:

    pushed/push_id=ID/key_part=K   newest rows of one push

Only parts that new history or pushes touch are rewritten, and a look-up reads only the parts that its
keys fall into. A push that is repeated writes its own folder again. It is read until a commit names it,
whatever number of runs pass while it is under way; more than OPEN_PUSHES of them are folded in by
the next push. Folders of pushes go one commit after they were folded in, so that readers of the commit
before still find them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators.latest import between, latest_per_entity
from tillwatch.operators.skew import DEFAULT_HOT_KEYS, HotKeys, lookup_any
from tillwatch.plans.feature_store.parted import PART, PARTS, Commit, PartedTable
from tillwatch.sources.paths import exists, folders, remove

#: Pushes that a read may have to add to the stored parts.
OPEN_PUSHES = 32


class LatestTable:
    """Latest values of one source; readers see the newest commit and pushed rows."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str],
                 event_ts: str, created: str | None, parts: int = PARTS):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.event_ts, self.created = keys, event_ts, created
        self.table = PartedTable(spark, root, schema, keys, parts)

    def state(self) -> tuple[int, datetime | None]:
        """Current version and the event time up to which it was materialised."""
        head = self.table.head()
        return head.version, head.mark

    def _push_path(self, push_id: str) -> str:
        return f"{self.root}/pushed/push_id={push_id}"

    def _open_pushes(self, head: Commit) -> list[str]:
        """Finished pushes that no commit has folded in."""
        names = [name.split("=", 1)[1] for name in folders(self.spark, f"{self.root}/pushed")]
        return [n for n in names if n not in head.folded and exists(self.spark, f"{self._push_path(n)}/_SUCCESS")]

    def _pushed(self, pushes: list[str], parts: Iterable[int] | None = None) -> list[DataFrame]:
        if not pushes:
            return []
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.IntegerType())])
        found = [self.spark.read.schema(schema).option("basePath", self._push_path(n)).parquet(self._push_path(n)) for n in pushes]
        rows = reduce(DataFrame.unionByName, found)
        if parts is not None:
            rows = rows.filter(F.col(PART).isin(*parts))
        return [rows.select(*self.schema.names)]

    def _newest(self, rows: list[DataFrame]) -> DataFrame:
        return latest_per_entity(reduce(DataFrame.unionByName, rows), self.keys, self.event_ts, self.created)

    def read(self, parts: Iterable[int] | None = None) -> DataFrame:
        """Newest row per key, of all parts or of the given ones."""
        head = self.table.head()
        return self._newest([self.table.rows(head, parts), *self._pushed(self._open_pushes(head), parts)])

    def parts_of(self, rows: DataFrame) -> list[int]:
        return self.table.parts_of(rows)

    def lookup(self, rows: DataFrame, values: list[str], hot_keys: HotKeys = DEFAULT_HOT_KEYS) -> DataFrame:
        """``rows`` with the latest ``values`` of their keys, NULL where a key is unknown.

        Reads only the parts that the keys fall into; rows of a hot key are spread. ``rows`` is evaluated
        more than once: a stored or persisted frame.
        """
        return lookup_any(rows, self.read(self.parts_of(rows)).select(*self.keys, *values), self.keys, hot_keys)

    def push(self, rows: DataFrame, push_id: str) -> None:
        """Add rows under an id; the same id again replaces its rows."""
        newest = latest_per_entity(self.table.typed(rows), self.keys, self.event_ts, self.created)
        (newest.withColumn(PART, self.table.part()).repartition(PART).write.mode("overwrite").partitionBy(PART)
         .parquet(self._push_path(push_id)))
        if len(self._open_pushes(self.table.head())) > OPEN_PUSHES:
            self._fold(None, lambda head: head.mark)

    def materialize(self, history: DataFrame, end: datetime, start: datetime | None = None) -> int:
        """Fold history rows of ``(start or last mark, end]`` and pushed rows into the parts they touch."""
        def fresh(head: Commit) -> DataFrame:
            return between(self.table.typed(history), self.event_ts, start or head.mark, end)

        return self._fold(fresh, lambda head: end).version

    def _fold(self, fresh, mark) -> Commit:
        gone: list[str] = []

        def step(head: Commit) -> Commit:
            pushes = self._open_pushes(head)
            rows = [*([fresh(head)] if fresh else []), *self._pushed(pushes)]
            new = self._newest(rows).persist() if rows else None
            try:
                touched = self.parts_of(new) if rows else []
                runs = self.table.write(self._newest([new, self.table.rows(head, touched)])) if touched else {}
            finally:
                if rows:
                    new.unpersist()
            gone[:] = [n for n in head.folded if exists(self.spark, self._push_path(n))]
            return self.table.commit(head, runs, mark(head), [*pushes, *gone])

        after = self.table.change(step)
        for name in gone:
            remove(self.spark, self._push_path(name))
        return after
