"""What features exist: plain objects, no Spark work."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tillwatch.sources.paths import exists

# declared type name -> Spark type (fixed values)
TYPES = {"Int64": "bigint", "Float32": "float", "Float64": "double", "String": "string"}


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    description: str = ""

    @property
    def spark_type(self) -> str:
        return TYPES[self.dtype]


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]


@dataclass(frozen=True)
class FeatureSource:
    """A table with an event-time column and, for ties, a created-time column.

    ``path`` is a Parquet path; ``table`` gives the rows of a source that is not a plain path. Pushed
    rows lie beside ``path``, one folder per push, and count as rows of the table.
    """

    name: str
    path: str | None = None
    timestamp_field: str = "event_timestamp"
    created_field: str | None = None
    table: Callable[[SparkSession], DataFrame] | None = None

    @property
    def batch(self) -> "FeatureSource":
        return self

    @property
    def pushed_path(self) -> str:
        return f"{self.path.rstrip('/')}_pushed"

    def read(self, spark: SparkSession) -> DataFrame:
        if self.table:
            return self.table(spark)
        rows = spark.read.parquet(self.path)
        if not exists(spark, self.pushed_path):
            return rows
        pushed = spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(self.pushed_path)
        return rows.unionByName(pushed)


@dataclass(frozen=True)
class PushSource:
    """Rows arrive one by one or as a stream; history lives in the batch source."""

    name: str
    batch_source: FeatureSource

    @property
    def batch(self) -> FeatureSource:
        return self.batch_source


@dataclass(frozen=True)
class RequestSource:
    """Columns that only the caller knows."""

    name: str
    schema: tuple[Field, ...]

    def check(self, df: DataFrame) -> None:
        missing = [f.name for f in self.schema if f.name not in df.columns]
        if missing:
            raise ValueError(f"request source '{self.name}': missing columns {missing}")


@dataclass(frozen=True)
class FeatureView:
    name: str
    entities: tuple[Entity, ...]
    schema: tuple[Field, ...]
    source: FeatureSource | PushSource
    ttl: timedelta | None = None
    online: bool = True
    tags: dict[str, str] = field(default_factory=dict, hash=False)
    selected: tuple[str, ...] | None = None

    def __getitem__(self, names: list[str]) -> "FeatureView":
        """The same view, only some features: ``view[["conv_rate"]]``."""
        unknown = [n for n in names if n not in self.fields]
        if unknown:
            raise KeyError(f"{self.name}: {unknown}")
        return replace(self, selected=tuple(names))

    @property
    def keys(self) -> list[str]:
        return [k for e in self.entities for k in e.join_keys]

    @property
    def fields(self) -> dict[str, Field]:
        return {f.name: f for f in self.schema}

    @property
    def features(self) -> list[str]:
        return list(self.selected if self.selected is not None else self.fields)


Inputs = Callable[[str], Column]


@dataclass(frozen=True)
class OnDemandView:
    """Features computed at read time: Column builders, or a pandas function as a hook."""

    name: str
    sources: tuple[FeatureView | RequestSource, ...]
    schema: tuple[Field, ...]
    columns: dict[str, Callable[[Inputs], Column]] | None = field(default=None, hash=False)
    pandas: Callable[[pd.DataFrame], pd.DataFrame] | None = None

    @property
    def features(self) -> list[str]:
        return [f.name for f in self.schema]

    @property
    def views(self) -> list[FeatureView]:
        return [s for s in self.sources if isinstance(s, FeatureView)]

    @property
    def requests(self) -> list[RequestSource]:
        return [s for s in self.sources if isinstance(s, RequestSource)]

    def inputs(self) -> Iterator[tuple[str, str]]:
        """(input name, internal column); a request column keeps its name."""
        for source in self.sources:
            for name in (source.fields if isinstance(source, FeatureView) else [f.name for f in source.schema]):
                yield name, internal_name(source.name, name) if isinstance(source, FeatureView) else name

    def attach(self, df: DataFrame) -> DataFrame:
        """Add this view's features to a frame that holds its inputs."""
        for request in self.requests:
            request.check(df)
        place = dict(self.inputs())
        out = {f.name: internal_name(self.name, f.name) for f in self.schema}
        if self.columns is not None:
            def value(name: str) -> Column:
                return F.col(place[name]).cast("double")
            return df.withColumns({out[f.name]: self.columns[f.name](value).cast(f.spark_type)
                                   for f in self.schema})
        return self._attach_pandas(df, place, out)

    def _attach_pandas(self, df: DataFrame, place: dict[str, str], out: dict[str, str]) -> DataFrame:
        """Only the inputs pass through pandas; all other columns stay as they are."""
        compute, names = self.pandas, [f.name for f in self.schema]
        inputs = list(place)
        kinds = ", ".join(f"`{f.name}` {f.spark_type}" for f in self.schema)

        def per_batch(*columns: pd.Series) -> pd.DataFrame:
            made = compute(pd.DataFrame(dict(zip(inputs, columns))))
            return pd.DataFrame({n: made[n].to_numpy() for n in names})

        made = F.pandas_udf(per_batch, kinds)(*[F.col(place[n]) for n in inputs])
        box = "_" + internal_name(self.name, "made")
        return df.withColumn(box, made).withColumns({out[n]: F.col(f"{box}.{n}") for n in names}).drop(box)


def on_demand(sources: list, schema: list[Field]):
    """Decorator: a pandas function of the inputs becomes an on-demand view of the same name."""
    def wrap(function: Callable[[pd.DataFrame], pd.DataFrame]) -> OnDemandView:
        return OnDemandView(function.__name__, tuple(sources), tuple(schema), pandas=function)
    return wrap


@dataclass(frozen=True)
class FeatureService:
    """A named, versioned list of views, parts of views and on-demand views."""

    name: str
    features: tuple[FeatureView | OnDemandView, ...]
    log_path: str | None = None

    def references(self) -> list[str]:
        return [f"{view.name}:{name}" for view in self.features for name in view.features]


def internal_name(view: str, feature: str) -> str:
    return f"{view}__{feature}"
