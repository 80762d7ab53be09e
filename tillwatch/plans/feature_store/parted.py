"""A table cut by a hash of its key, of which a change rewrites only the parts it touches.

    values/run=R/key_part=K   rows of part K as run R left them
    commits/version=N         one row per part: the run that holds it; one row without part for the rest

A reader takes the newest finished commit, so it never sees half a change. A commit fails if its version
exists: of two writers that started from the same version one has to repeat its work. What the last two
commits name stays on disk, so that a reader of the one before still finds its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.sources.paths import exists, folders, remove

PART = "key_part"
#: Parts of a table unless the caller says otherwise. A change of one key rewrites this share of the rows.
PARTS = 64
COMMIT_DDL = "mark TIMESTAMP, folded ARRAY<STRING>, parts INT, part INT, run STRING"
ATTEMPTS = 5


@dataclass(frozen=True)
class Commit:
    """State of a table: event time up to which it holds history, pushes it contains, run of each part."""

    version: int = 0
    mark: datetime | None = None
    folded: list[str] = field(default_factory=list)
    runs: dict[int, str] = field(default_factory=dict)


class PartedTable:
    """``parts`` belongs to the table: every reader and writer gives the same."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], parts: int = PARTS):
        if PART in schema.names or "run" in schema.names:
            raise ValueError(f"columns '{PART}' and 'run' are the table's own")
        self.spark, self.root, self.schema, self.keys, self.parts = spark, root.rstrip("/"), schema, keys, parts

    def part(self) -> Column:
        """Part of a row, by its keys in the table's types."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys]), F.lit(self.parts)).cast("int")

    def parts_of(self, rows: DataFrame) -> list[int]:
        """Parts that the rows' keys fall into: ``parts`` numbers at most."""
        return sorted(r[0] for r in rows.select(self.part().alias("p")).distinct().collect())

    def typed(self, rows: DataFrame, *more: str) -> DataFrame:
        return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields] + [F.col(c) for c in more])

    def _versions(self) -> list[int]:
        names = folders(self.spark, f"{self.root}/commits")
        return sorted((int(n.split("=")[1]) for n in names), reverse=True)

    def _load(self, version: int) -> Commit:
        rows = self.spark.read.schema(COMMIT_DDL).parquet(f"{self.root}/commits/version={version}").collect()
        rest = next(r for r in rows if r["part"] is None)
        if rest["parts"] != self.parts:
            raise ValueError(f"the table has {rest['parts']} parts, not {self.parts}")
        return Commit(version, rest["mark"], list(rest["folded"]), {r["part"]: r["run"] for r in rows if r["part"] is not None})

    def head(self) -> Commit:
        """The newest finished commit."""
        for version in self._versions():
            if exists(self.spark, f"{self.root}/commits/version={version}/_SUCCESS"):
                return self._load(version)
        return Commit()

    def _path(self, part: int, run: str) -> str:
        return f"{self.root}/values/run={run}/{PART}={part}"

    def rows(self, head: Commit, parts: Iterable[int] | None = None) -> DataFrame:
        """Rows of a commit; with ``parts`` only their folders are listed and read."""
        chosen = head.runs if parts is None else {p: head.runs[p] for p in parts if p in head.runs}
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        paths = [self._path(p, r) for p, r in sorted(chosen.items())]
        return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/values").parquet(*paths).select(*self.schema.names)

    def write(self, rows: DataFrame) -> dict[int, str]:
        """Write rows part by part under a run of their own; (part, run) of the parts that got rows."""
        return self.write_dealt(rows.withColumn(PART, self.part()).repartition(PART))

    def write_dealt(self, rows: DataFrame) -> dict[int, str]:
        """``write`` of rows that know their part (``PART``) and were dealt by it: they are not shuffled again."""
        run = uuid.uuid4().hex
        path = f"{self.root}/values/run={run}"
        rows.write.partitionBy(PART).parquet(path)
        return {int(name.split("=")[1]): run for name in folders(self.spark, path) if name.startswith(f"{PART}=")}

    def commit(self, head: Commit, runs: dict[int, str], mark: datetime | None, folded: Iterable[str] = ()) -> Commit:
        """The next version: ``head`` with the given parts in place of its own. Fails if it exists."""
        after = Commit(head.version + 1, mark, list(folded), {**head.runs, **runs})
        rows = [(mark, after.folded, self.parts, None, None)] + [(None, None, None, p, r) for p, r in sorted(after.runs.items())]
        (self.spark.createDataFrame(rows, COMMIT_DDL).coalesce(1).write.mode("errorifexists")
         .parquet(f"{self.root}/commits/version={after.version}"))
        self._sweep(head)
        return after

    def _sweep(self, before: Commit) -> None:
        """Remove commits older than ``before``, and the parts that only they name."""
        for version in self._versions():
            if version < before.version:
                if exists(self.spark, f"{self.root}/commits/version={version}/_SUCCESS"):
                    for part, run in self._load(version).runs.items():
                        if before.runs.get(part) != run:
                            remove(self.spark, self._path(part, run))
                remove(self.spark, f"{self.root}/commits/version={version}")

    def change(self, step: Callable[[Commit], Commit]) -> Commit:
        """Run ``step`` on the newest commit; again on a newer one where another writer came first."""
        for left in reversed(range(ATTEMPTS)):
            try:
                return step(self.head())
            except AnalysisException as error:
                if not left or error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
        raise AssertionError("unreachable")
