"""Exact treatment of hot keys.

`hot_keys` finds, by partial counts, the keys whose groups are too large for one task. At most
`max_hot` keys are returned, the largest first, so the result may be broadcast; every key left
out has at most max(floor, rows / max_hot) rows, which one task sorts and spills as needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT = 10_000
FLOOR = 10_000


def hot_keys(df: DataFrame, key: str, floor: int = FLOOR, max_hot: int = MAX_HOT, weight: str | None = None) -> DataFrame:
    """The keys with at least `floor` rows (or summed `weight`): one column `key`."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(key).agg(n.alias("__n")).where(F.col("__n") >= floor).orderBy(F.desc("__n"), key).limit(max_hot).select(key)


def join_small_side(rows: DataFrame, keyed: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner join of `rows` with `keyed` (one row per key): rows of hot keys meet their partner by
    a bounded broadcast, the others by one shuffle in which no group is large."""
    hot = F.broadcast(hot)
    few = keyed.join(hot, key, "left_semi")
    return rows.join(F.broadcast(few), key).unionByName(
        rows.join(hot, key, "left_anti").join(keyed.join(hot, key, "left_anti"), key)
    )
