"""A row's place in [0, 1), the same on every run, partitioning and SQL engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = float(16 ** 8)


def unit_hash(key: str, seed: int = 42) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(_SPACE)
