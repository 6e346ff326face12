"""Intermediate tables in the folder that the cluster shares, and joins that bear hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.staging import clear, discard, exists, materialize, new_path, shared_dir

__all__ = ["HOT_GROUPS", "clear", "discard", "exists", "join_groups", "materialize", "new_path", "shared_dir"]

#: A group larger than total/HOT_GROUPS rows is hot; sizes add up to the total, so there are fewer than HOT_GROUPS of them.
HOT_GROUPS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of ``rows`` to ``groups`` (one row per ``key``, with its number of rows in ``size``).

    Hot groups number fewer than HOT_GROUPS whatever the input, so that side is broadcast; the rest meets
    in an ordinary shuffled join, in which no key has more than total/HOT_GROUPS rows.
    """
    limit = max(total // HOT_GROUPS, 1)
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    seen = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    warm = seen.filter("_hot").drop("_hot")
    rest = seen.filter("_hot is null").select(*rows.columns)
    return warm.unionByName(rest.join(cold, key, "left"))
