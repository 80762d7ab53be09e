"""Retrieval: historical (point in time), online (latest), push, materialise."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators.asof import AsofTable, asof_carry_all, within_ttl
from tillwatch.operators.latest import instant, latest_per_entity
from tillwatch.operators.skew import DEFAULT_HOT_KEYS, HotKeys, lookup_any
from tillwatch.plans.feature_store.definitions import (
    FeatureService,
    FeatureView,
    OnDemandView,
    PushSource,
    internal_name,
)
from tillwatch.plans.feature_store.online import LatestTable

References = list[str] | FeatureService


class FeatureStore:
    """Definitions by name, and the jobs that read and fill their tables under ``root``."""

    def __init__(self, spark: SparkSession, definitions: Iterable, root: str | None = None,
                 hot_keys: HotKeys = DEFAULT_HOT_KEYS):
        self.spark, self.root, self.hot_keys = spark, root, hot_keys
        self.views: dict[str, FeatureView] = {}
        self.on_demand_views: dict[str, OnDemandView] = {}
        self.services: dict[str, FeatureService] = {}
        self.push_sources: dict[str, PushSource] = {}
        for item in definitions:
            place = {FeatureView: self.views, OnDemandView: self.on_demand_views,
                     FeatureService: self.services, PushSource: self.push_sources}[type(item)]
            if item.name in place:
                raise ValueError(f"'{item.name}' is defined twice")
            place[item.name] = item

    def get_feature_view(self, name: str) -> FeatureView:
        return self.views[name]

    def get_feature_service(self, name: str) -> FeatureService:
        return self.services[name]

    def describe(self, now: datetime | None = None) -> DataFrame:
        """One row per view: definition, and rows, time range and age of its batch source.

        ``first_event``, ``last_event`` and ``rows`` come from one aggregate per source over its time column alone;
        ``age_seconds``: from the last event to ``now``. A source without rows has NULLs and 0.
        """
        rows = [(v.name, [e.name for e in v.entities],
                 None if v.ttl is None else int(v.ttl.total_seconds()), v.online, v.features, dict(v.tags), v.source.batch.name)
                for v in self.views.values()]
        views = self.spark.createDataFrame(
            rows, "name STRING, entities ARRAY<STRING>, ttl_seconds BIGINT, online BOOLEAN, "
                  "features ARRAY<STRING>, tags MAP<STRING, STRING>, source STRING")
        held = []
        for source in {v.source.batch.name: v.source.batch for v in self.views.values()}.values():
            at = F.col(source.timestamp_field).cast("timestamp")
            held.append(source.read(self.spark).agg(F.count(F.lit(1)).alias("rows"), F.min(at).alias("first_event"), F.max(at).alias("last_event"))
                        .withColumn("source", F.lit(source.name)))
        if not held:
            held.append(self.spark.createDataFrame([], "rows BIGINT, first_event TIMESTAMP, last_event TIMESTAMP, source STRING"))
        out = views.join(F.broadcast(reduce(DataFrame.unionByName, held)), "source", "left")
        moment = F.lit(None).cast("timestamp") if now is None else instant(now, T.TimestampType())
        return out.withColumn("age_seconds", F.unix_timestamp(moment) - F.unix_timestamp("last_event"))

    def _resolve(self, features: References) -> tuple[list[tuple[str, str]], list[FeatureView], list[OnDemandView]]:
        """Wanted (view, feature) pairs, and the stored and on-demand views they need."""
        names = features.references() if isinstance(features, FeatureService) else features
        wanted = [tuple(name.split(":", 1)) for name in names]
        stored: dict[str, FeatureView] = {}
        computed: dict[str, OnDemandView] = {}
        for view, feature in wanted:
            if view in self.views:
                if feature not in self.views[view].fields:
                    raise KeyError(f"{view}:{feature}")
                stored[view] = self.views[view]
            elif view in self.on_demand_views:
                if feature not in self.on_demand_views[view].features:
                    raise KeyError(f"{view}:{feature}")
                computed[view] = self.on_demand_views[view]
                stored.update({v.name: self.views[v.name] for v in computed[view].views})
            else:
                raise KeyError(f"no view '{view}'")
        return wanted, list(stored.values()), list(computed.values())

    @staticmethod
    def _project(df: DataFrame, passed: list[str], wanted: list[tuple[str, str]], full_names: bool) -> DataFrame:
        names = [internal_name(v, f) if full_names else f for v, f in wanted]
        clashes = sorted({n for n in names if names.count(n) > 1 or n in passed})
        if clashes:
            raise ValueError(f"feature names {clashes} are not unique; use full_names=True")
        return df.select(*passed, *[F.col(internal_name(v, f)).alias(n) for (v, f), n in zip(wanted, names)])

    def get_historical_features(self, spine: DataFrame, features: References,
                                timestamp: str = "event_timestamp", full_names: bool = False,
                                tables: dict[str, DataFrame] | None = None,
                                now: datetime | None = None) -> DataFrame:
        """Each spine row with the features known at its time; all spine columns pass through.

        Views on the same table are carried once and differ only in columns and time-to-live; tables with
        the same keys share one as-of join. ``tables`` overrides the rows of a source by name. ``now``: the time
        of every spine row, which makes the join a look-up of the newest rows of that moment.
        """
        wanted, stored, computed = self._resolve(features)
        groups: dict[tuple, dict[str, list[FeatureView]]] = {}
        for view in stored:
            groups.setdefault(tuple(view.keys), {}).setdefault(view.source.batch.name, []).append(view)
        out = spine
        for keys, sources in groups.items():
            held = []
            for views in sources.values():
                source, ttls = views[0].source.batch, [v.ttl for v in views]
                rows = (tables or {}).get(source.name)
                fields = list({n: None for v in views for n in v.fields})
                held.append(AsofTable(source.read(self.spark) if rows is None else rows, source.timestamp_field,
                                      source.created_field, fields, None if None in ttls else max(ttls)))
            if now is None:
                out = asof_carry_all(out, held, list(keys), timestamp, self.hot_keys)
            else:
                for i, table in enumerate(held):
                    out = self._newest_at(out, table, list(keys), now).withColumnRenamed("_carried", f"_carried_{i}")
            for i, views in enumerate(sources.values()):
                carried = F.col(f"_carried_{i}")
                out = out.withColumns({
                    internal_name(v.name, n): F.when(within_ttl(carried, F.col(timestamp), v.ttl), carried[n]).cast(f.spark_type)
                    for v in views for n, f in v.fields.items()})
            out = out.drop(*[f"_carried_{i}" for i in range(len(held))])
        for view in computed:
            out = view.attach(out)
        return self._project(out, spine.columns, wanted, full_names)

    def features_for_scoring(self, spine: DataFrame, features: References, now: datetime,
                             timestamp: str = "event_timestamp", **options) -> DataFrame:
        """Historical retrieval with every spine row at ``now``."""
        kind = spine.schema[timestamp].dataType if timestamp in spine.columns else T.TimestampType()
        return self.get_historical_features(spine.withColumn(timestamp, instant(now, kind)), features,
                                            timestamp, now=now, **options)

    def _newest_at(self, spine: DataFrame, table: AsofTable, keys: list[str], now: datetime) -> DataFrame:
        """``_carried`` for one moment: only rows of the time-to-live are read, one per key is looked up."""
        moment = instant(now, table.rows.schema[table.ts].dataType)
        known = table.rows.filter(F.col(table.ts) <= moment)
        if table.ttl is not None:
            known = known.filter(F.col(table.ts) >= moment - F.lit(table.ttl))
        newest = latest_per_entity(known, keys, table.ts, table.created)
        carried = F.struct(F.col(table.ts).alias("event_ts"), *[F.col(c) for c in table.fields]).alias("_carried")
        return lookup_any(spine, newest.select(*keys, carried), keys, self.hot_keys)

    # ----- latest values -----

    def latest_table(self, view: FeatureView, history: DataFrame | None = None) -> LatestTable:
        """The table of latest values behind a view; views with the same source and keys share it."""
        if self.root is None:
            raise ValueError("this store has no root folder")
        source = view.source.batch
        rows = source.read(self.spark) if history is None else history
        return LatestTable(self.spark, f"{self.root}/{view.source.name}/by={'+'.join(view.keys)}", rows.schema, view.keys,
                           source.timestamp_field, source.created_field)

    def _online_views(self) -> dict[tuple[str, ...], FeatureView]:
        """One online view for each (source, keys): those with a latest table of their own."""
        found: dict[tuple[str, ...], FeatureView] = {}
        for view in self.views.values():
            if view.online:
                found.setdefault((view.source.name, *view.keys), view)
        return found

    def materialize_incremental(self, end: datetime) -> dict[tuple[str, ...], int]:
        """Fold history up to ``end`` into every online source and key; returns the version of each."""
        done: dict[tuple[str, ...], int] = {}
        for place, view in self._online_views().items():
            history = view.source.batch.read(self.spark)
            done[place] = self.latest_table(view, history).materialize(history, end)
        return done

    def push(self, source: str, rows: DataFrame, online: bool = True, offline: bool = True,
             push_id: str | None = None) -> None:
        """Send rows to the latest values of all of the push source's views and to its batch table.

        The same ``push_id`` again replaces its rows in both places.
        """
        pushed, name = self.push_sources[source], push_id or uuid.uuid4().hex
        batch = pushed.batch_source
        history = batch.read(self.spark)
        typed = rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in history.schema.fields])
        if offline:
            if batch.path is None:
                raise ValueError(f"source '{batch.name}' has no path to append to")
            typed.write.mode("overwrite").parquet(f"{batch.pushed_path}/{name}")
        if online:
            for (of, *_), view in self._online_views().items():
                if of == source:
                    self.latest_table(view, history).push(typed, name)

    def get_online_features(self, requests: DataFrame, features: References, full_names: bool = False,
                            tables: dict[str, DataFrame] | None = None,
                            now: datetime | None = None, max_age: timedelta | None = None) -> DataFrame:
        """Request rows with the latest values of their keys; an unknown key gets NULLs.

        Only the parts of the latest tables that the requests' keys fall into are read, so ``requests`` is
        evaluated more than once. ``tables`` gives latest rows by source name in place of the stored ones.
        ``max_age`` blanks values older than that at ``now``.
        """
        wanted, stored, computed = self._resolve(features)
        groups: dict[tuple, list[FeatureView]] = {}
        for view in stored:
            groups.setdefault((view.source.name, *view.keys), []).append(view)
        out = requests
        for views in groups.values():
            source, keys = views[0].source, views[0].keys
            latest = (tables or {}).get(source.name)
            if latest is None:
                table = self.latest_table(views[0])
                latest = table.read(table.parts_of(requests))
            if max_age is not None:
                at = source.batch.timestamp_field
                latest = latest.filter(F.col(at) >= instant(now, latest.schema[at].dataType) - F.lit(max_age))
            values = latest.select(*keys, *[
                F.col(n).cast(f.spark_type).alias(internal_name(v.name, n))
                for v in views for n, f in v.fields.items()])
            out = lookup_any(out, values, keys, self.hot_keys)
        for view in computed:
            out = view.attach(out)
        return self._project(out, requests.columns, wanted, full_names)

    def log_served(self, served: DataFrame, service: str, served_at: datetime) -> None:
        """Append served features to the service's log."""
        path = self.services[service].log_path
        if path is None:
            raise ValueError(f"service '{service}' has no log path")
        (served.withColumns({"served_at": instant(served_at, T.TimestampType()), "service": F.lit(service)})
         .write.mode("append").parquet(path))


def sorted_listing(row_frame: DataFrame, keys: list[str]) -> DataFrame:
    """One line per (key, feature) in feature order, values as text."""
    values = [c for c in row_frame.columns if c not in keys]
    text = row_frame.select(*keys, *[F.col(c).cast("string").alias(c) for c in values])
    return text.unpivot(keys, values, "feature", "value").orderBy("feature", *keys)
