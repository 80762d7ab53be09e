"""Query name -> function of (session, table folder), and its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwatch.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        key = name or function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return function(spark, folder.rstrip("/"))

        run.__name__, run.__doc__ = key, function.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return function
    return register
