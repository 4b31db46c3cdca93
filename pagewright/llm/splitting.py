"""Splitting oversized texts at natural boundaries with balanced targets.

The minimum number of pieces is computed, equal-length targets are placed, and each target is
snapped to the strongest boundary near it (the nearest of equal strength). If a piece exceeds the
limit, one more piece is tried. Consecutive pieces share exactly the specified overlap.

Sizes are those of the heuristic counter: word runs and other single signs, times 1.3, plus 1.
Units never span white space, so a text of up to `limit` needs no Python: only oversized texts
leave the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.plans.base import once

LIMIT = 1024
OVERLAP = 50
#: Share of a target's distance in which a boundary is looked for, on either side.
REACH = 0.15

_UNITS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_UNIT = re.compile(r"\w+|[^\w\s]")


def text_size(text: Column) -> Column:
    """Size of a text; null for null."""
    return (F.floor(F.regexp_count(text, F.lit(_UNITS)) * F.lit(1.3)) + 1).cast("int")


def most_units(limit: int) -> int:
    """The most units that a piece of size `limit` holds."""
    n = int((limit - 1) / 1.3) + 2
    while int(n * 1.3) + 1 > limit:
        n -= 1
    return n


def boundary_strength(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Strength of a cut before each unit: 5 blank line, 4 line end, 3 sentence end, 2 clause end,
    1 white space, 0 inside a run of signs."""
    strength = np.zeros(len(starts), np.int8)
    for i in range(1, len(starts)):
        gap = text[ends[i - 1] : starts[i]]
        if not gap:
            continue
        before = text[ends[i - 1] - 1]
        if "\n" in gap or "\r" in gap:
            lines = gap.replace("\r\n", "\n").replace("\r", "\n").count("\n")
            strength[i] = 5 if lines > 1 else 4
        elif before in ".!?…。":
            strength[i] = 3
        elif before in ",;:—–)":
            strength[i] = 2
        else:
            strength[i] = 1
    return strength


def cut_points(strength: np.ndarray, most: int, overlap: int, reach: float = REACH) -> np.ndarray:
    """Unit indexes at which pieces after the first begin their own part. Piece i covers its own
    part and the `overlap` units before it, at most `most` units in all."""
    n = len(strength)
    if n <= most:
        return np.empty(0, np.int64)
    pieces = max(2, -(-(n - overlap) // (most - overlap)))
    while True:
        step = n / pieces
        cuts, last = [], 0
        for i in range(1, pieces):
            target = round(i * step)
            room = int(step * reach)
            low, high = max(last + 1, target - room), min(n - 1, target + room)
            # what the piece that ends here and those that follow can hold
            high = min(high, last + most - (overlap if cuts else 0))
            if low > high:
                low = high = max(last + 1, min(target, high))
            window = strength[low : high + 1]
            best = np.flatnonzero(window == window.max()) + low
            last = int(best[np.abs(best - target).argmin()])
            cuts.append(last)
        edges = np.array([0, *cuts, n])
        own = np.diff(edges)
        if (own > 0).all() and own[0] <= most and (own[1:] + np.minimum(overlap, edges[1:-1]) <= most).all():
            return edges[1:-1]
        pieces += 1


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP, reach: float = REACH) -> list[tuple[int, int, int]]:
    """(start, own_start, end) in characters of each piece; own parts join to the whole text."""
    units = [m.span() for m in _UNIT.finditer(text)]
    if not units:
        return [(0, 0, len(text))]
    starts, ends = (np.array(x) for x in zip(*units, strict=True))
    shared = most_units(overlap) if overlap > 1 else 0
    cuts = cut_points(boundary_strength(text, starts, ends), most_units(limit), shared, reach)
    own = [0, *(int(starts[c]) for c in cuts), len(text)]
    begin = [0, *(int(starts[max(0, c - shared)]) for c in cuts)]
    return list(zip(begin, own[:-1], own[1:], strict=True))


def split_oversized(
    df: DataFrame,
    id_col: str = "chunk_id",
    text_col: str = "text",
    limit: int = LIMIT,
    overlap: int = OVERLAP,
    reach: float = REACH,
    only_oversized: bool = False,
) -> DataFrame:
    """(id, piece_no, n_pieces, start, own_start, end, size, piece) with 0-based character offsets.

    A text within the limit is one piece, unchanged; so are empty and blank texts. Null texts and
    null ids give no row. Rows delivered again (same id) count once. A word is never cut: it is one
    unit, however long. `overlap` 0 gives disjoint pieces; a limit that doesn't leave at least one
    unit beside the overlap is an error. Other columns are ignored.
    """
    if most_units(limit) - (most_units(overlap) if overlap > 1 else 0) < 2:
        raise ValueError("limit must exceed the overlap by at least two units")
    d = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    kind = d.schema["id"].dataType.simpleString()
    most = most_units(limit)
    # a unit has at least one character, so a short text needs no counting
    maybe = F.length("text") > most
    size = F.when(maybe, text_size(F.col("text")))
    big = d.where(maybe).withColumn("size", text_size(F.col("text"))).where(F.col("size") > limit).dropDuplicates(["id"]).select("id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, text in zip(b["id"], b["text"], strict=True):
                spans = split_text(text, limit, overlap, reach)
                for i, (start, own, end) in enumerate(spans):
                    piece = text[start:end]
                    out.append((key, i, len(spans), start, own, end, int(len(_UNIT.findall(piece)) * 1.3) + 1, piece))
            yield pd.DataFrame(out, columns=["id", "piece_no", "n_pieces", "start", "own_start", "end", "size", "piece"])

    schema = f"id {kind}, piece_no int, n_pieces int, start bigint, own_start bigint, end bigint, size int, piece string"
    pieces = big.mapInPandas(run, schema)
    if not only_oversized:
        small = once(d.where(~maybe | (size <= limit)), "id", "text")  # ids are counted, texts stay where they are
        pieces = pieces.unionByName(
            small.select(
                "id",
                F.lit(0).alias("piece_no"),
                F.lit(1).alias("n_pieces"),
                F.lit(0).cast("bigint").alias("start"),
                F.lit(0).cast("bigint").alias("own_start"),
                F.length("text").cast("bigint").alias("end"),
                text_size(F.col("text")).alias("size"),
                F.col("text").alias("piece"),
            )
        )
    return pieces.withColumnRenamed("id", id_col)
