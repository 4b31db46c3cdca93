"""Filling containers of fixed capacity: distributed sum-of-squares packing.

Items are spread over shards of bounded size by a hash; each shard packs its items on its own,
largest first, placing every item where the sum of the squared counts of open containers per
residual gap becomes smallest (ties: the fullest container). A shard leaves only its last few
containers open, so the loss against one global packing is some containers per `items_per_shard`.
An item is cut only if it exceeds the capacity, into full containers and one remaining item.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
ITEMS_PER_SHARD = 50_000


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """The container of each item, in the given order; sizes are 1..capacity."""
    count = np.zeros(capacity + 1, np.int64)  # open containers per gap; gap 0 is closed
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed = np.empty(len(sizes), np.int64)
    fresh, big = 0, np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        if s == capacity:
            placed[i], fresh = fresh, fresh + 1
            continue
        # change of the sum of squares if a container of gap g takes the item, g = s..capacity-1
        open_ = count[s:capacity]
        after = count[: capacity - s]
        change = 2 * (after - open_) + 2
        change[0] -= 1 + 2 * int(after[0])  # gap g = s closes; closed containers don't count
        change = np.where(open_ > 0, change, big)
        j = int(change.argmin())
        if change[j] <= 2 * int(count[capacity - s]) + 1:
            gap = s + j
            box = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, box, fresh = capacity, fresh, fresh + 1
        left = gap - s
        if left:
            count[left] += 1
            stacks[left].append(box)
        placed[i] = box
    return placed, fresh


def pack(sizes: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", capacity: int = CAPACITY, items_per_shard: int = ITEMS_PER_SHARD) -> DataFrame:
    """(id, piece_no, token_start, n_tokens, shard, container): every row of `sizes` placed.

    `container` counts within its shard; (shard, container) names a container. A row larger than
    the capacity gives several pieces (piece_no from 0, token_start = its first token). Rows of
    size null, 0 or less take no room: one piece of 0 tokens, container null. Rows delivered again
    are items of their own; an empty table gives an empty result.
    """
    if capacity < 1 or items_per_shard < 1:
        raise ValueError("capacity and items_per_shard must be positive")
    src = sizes.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)), F.lit(0)).alias("n"))
    shards = max(1, math.ceil(src.count() / items_per_shard))
    kind = src.schema["id"].dataType.simpleString()
    # rows without an id are told apart by their place
    place = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
    src = src.withColumn("shard", F.pmod(F.xxhash64("id", "n", place), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "id"], ascending=[False, True], kind="stable")
        n = pdf["n"].to_numpy(np.int64)
        full, rest = n // capacity, n % capacity
        # full containers of the oversized rows come first
        rows = np.repeat(np.arange(len(n)), full)
        first = np.cumsum(full) - full
        piece = np.arange(len(rows)) - first[rows]
        item = np.flatnonzero((rest > 0) | (n == 0))
        fit = rest[item] > 0
        order = item[fit][np.argsort(-rest[item[fit]], kind="stable")]
        placed, _ = sum_of_squares(rest[order], capacity)
        none = item[~fit]
        out = np.concatenate([rows, order, none])
        return pd.DataFrame(
            {
                id_col: pdf["id"].iloc[out].array,
                "piece_no": np.concatenate([piece, full[order], np.zeros(len(none), np.int64)]).astype(np.int32),
                "token_start": np.concatenate([piece * capacity, full[order] * capacity, np.zeros(len(none), np.int64)]),
                "n_tokens": np.concatenate([np.full(len(rows), capacity), rest[order], np.zeros(len(none), np.int64)]).astype(np.int32),
                "shard": np.full(len(out), pdf["shard"].iloc[0], np.int64),
                "container": pd.array(np.concatenate([np.arange(len(rows)), placed + len(rows), np.full(len(none), -1)]), dtype="Int64").copy(),
            }
        ).assign(container=lambda d: d["container"].mask(d["container"] < 0))

    schema = f"`{id_col}` {kind}, piece_no int, token_start bigint, n_tokens int, shard bigint, container bigint"
    return src.groupBy("shard").applyInPandas(run, schema)
