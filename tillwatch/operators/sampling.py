"""Sampling and train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.hashing import unit_hash


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement; any fraction outside (0, 1) keeps all rows.

    The rows chosen depend on the partitioning of ``df``.
    """
    if 0.0 < fraction < 1.0:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df


def sample_by_key(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """The same keys on every run and partitioning; all rows of a key stay together."""
    if 0.0 < fraction < 1.0:
        return df.filter(unit_hash(key, seed) < fraction)
    return df


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([train_share, 1 - train_share], seed=seed)
    return train, test


def split_by_key(df: DataFrame, key: str = "transaction_id", train_share: float = 0.8,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A split that a retried or repeated job repeats exactly."""
    return split_by_place(df, unit_hash(key, seed), train_share)


def split_by_place(df: DataFrame, place: Column, train_share: float) -> tuple[DataFrame, DataFrame]:
    """The split of ``split_by_key`` where the rows know their ``unit_hash``."""
    return df.filter(place < train_share), df.filter(place >= train_share)
