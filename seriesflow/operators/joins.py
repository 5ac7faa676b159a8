"""Key sets for semi and anti joins, and the join of facts with their dimension.

AQE splits the hot partitions of a sort-merge join only where an exchange made for that join is right below
it on both sides. A side that was just aggregated by the join key brings its partitioning along and has no
such exchange. Grouping by one more column derived from the key gives the same groups in another
partitioning, so the join gets its own exchange and a key with a third of all facts is split over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_digest(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).alias("_digest")


def distinct_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The distinct keys of ``df``, at most one row for each key and map task shuffled."""
    return df.select(*on, key_digest(on)).distinct().select(*on)


def keep_referenced(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str] = "series_id") -> DataFrame:
    """Facts whose key the dimension holds."""
    keys = [on] if isinstance(on, str) else list(on)
    return facts.join(distinct_keys(dimension, keys), keys, "left_semi")


def drop_referenced(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str] = "series_id") -> DataFrame:
    """Facts whose key the dimension lacks; a NULL key counts as lacking."""
    keys = [on] if isinstance(on, str) else list(on)
    return facts.join(distinct_keys(dimension, keys), keys, "left_anti")
