"""Coverage of overlapping, nested and gapped intervals per entity.

The merge has two levels so that one entity may hold any number of intervals over any range:

1. intervals are pre-aggregated to one row per (entity, start) and clipped into shards of
   `shard_width` points. Only the first and the last shard of an interval get a piece; the shards between
   are covered whole and stay one row, merged per entity in shard numbers. Each (entity, shard) then holds
   at most `shard_width` rows, is merged on its own and also yields the uncovered runs inside the shard;
2. what touches a shard boundary is stitched per entity, at most two runs per shard and kind, together
   with the shards covered whole and the gaps over shards without intervals. All other runs are final.

Rows follow the intervals, not the width of the ranges; no entity's intervals are collected or sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import materialize


def coverage(
    intervals: DataFrame,
    domains: DataFrame,
    entity: str = "doc_id",
    start: str = "page_start",
    end: str = "page_end",
    low: str = "lo",
    high: str = "hi",
    shard_width: int = 64,
) -> DataFrame:
    """Maximal covered periods and uncovered gaps of each entity in `domains`.

    `intervals` has closed integer ranges [start, end]; `domains` one or more rows per entity
    with its range [low, high] (repeated rows: the widest counts). Output: entity,
    span_kind ('period' | 'gap'), span_start, span_end (bigint). Touching runs are one run.

    Defined cases: intervals with a null entity, a null end or start > end cover nothing;
    what leaves the domain is cut off; repeated rows change nothing; entities without a domain
    or with low > high or null give no row; a domain without intervals is one gap; empty inputs
    give an empty result; other columns are ignored, whatever their names. Domains must lie within
    -2**61 and 2**61.
    """
    e = "__entity"
    dom = (
        domains.select(F.col(entity).alias(e), F.col(low).cast("bigint").alias("__lo"), F.col(high).cast("bigint").alias("__hi"))
        .where("__entity is not null and __lo is not null and __hi is not null and __lo <= __hi")
        .groupBy(e)
        .agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    )
    iv = (
        intervals.select(F.col(entity).alias(e), F.col(start).cast("bigint").alias("__s"), F.col(end).cast("bigint").alias("__e"))
        .where("__entity is not null and __s <= __e")
        .groupBy(e, "__s")
        .agg(F.max("__e").alias("__e"))
    )
    iv = (
        iv.join(dom, e)
        .select(e, "__lo", F.greatest("__s", "__lo").alias("__s"), F.least("__e", "__hi").alias("__e"), "__hi")
        .where("__s <= __e")
    )

    def first(k: Column) -> Column:
        return F.col("__lo") + k * shard_width

    k = F.col("__k")
    iv = iv.withColumn("__k1", F.expr(f"(__s - __lo) div {shard_width}")).withColumn("__k2", F.expr(f"(__e - __lo) div {shard_width}"))
    iv = materialize(iv, "intervals")
    # shards that one interval covers whole: ranges of shard numbers, merged
    whole = iv.where("__k2 - __k1 >= 2").groupBy(e, (F.col("__k1") + 1).alias("__a")).agg((F.max("__k2") - 1).alias("__b"))
    by_a = Window.partitionBy(e).orderBy("__a")
    upto = F.max("__b").over(by_a.rowsBetween(Window.unboundedPreceding, -1))
    whole = whole.withColumn("__new", F.coalesce((F.col("__a") > upto + 1).cast("int"), F.lit(1)))
    whole = whole.withColumn("__island", F.sum("__new").over(by_a.rowsBetween(Window.unboundedPreceding, 0)))
    whole = materialize(whole.groupBy(e, "__island").agg(F.min("__a").alias("__a"), F.max("__b").alias("__b")).drop("__island"), "whole-shards")
    pieces = iv.withColumn("__k", F.explode(F.array_distinct(F.array("__k1", "__k2"))))
    # the other shards with pieces
    held = pieces.select(e, "__k").distinct().select(e, "__k", F.lit(None).cast("bigint").alias("__b")).unionByName(whole.select(e, F.col("__a").alias("__k"), "__b"))
    by_k = Window.partitionBy(e).orderBy("__k", F.col("__b").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    free = held.withColumn("__upto", F.max("__b").over(by_k)).where("__b is null and (__upto is null or __upto < __k)").select(e, "__k")
    free = materialize(free, "shards")
    pieces = pieces.join(free, [e, "__k"]).select(
        e,
        "__k",
        F.greatest("__s", first(k)).alias("__s"),
        F.least("__e", first(k) + (shard_width - 1)).alias("__e"),
        first(k).alias("__first"),
        F.least("__hi", first(k) + (shard_width - 1)).alias("__last"),
    )
    # A marker behind the last point of every shard closes its final gap.
    marks = free.join(dom, e).select(e, "__k", first(k).alias("__first"), F.least("__hi", first(k) + (shard_width - 1)).alias("__last"))
    marks = marks.select(e, "__k", (F.col("__last") + 1).alias("__s"), (F.col("__last") + 1).alias("__e"), "__first", "__last")
    local = pieces.unionByName(marks).groupBy(e, "__k", "__s", "__first", "__last").agg(F.max("__e").alias("__e"))
    # one exchange by (entity, shard) serves the aggregate above, the window and the islands below
    w = Window.partitionBy(e, "__k").orderBy("__s")
    before = F.coalesce(F.max("__e").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("__first") - 1)
    local = local.withColumn("__before", before).withColumn("__new", (F.col("__s") > F.col("__before") + 1).cast("int"))
    local = local.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = local.groupBy(e, "__k", "__island").agg(
        F.min(F.when(F.col("__s") <= F.col("__last"), F.col("__s"))).alias("__ps"),
        F.max(F.when(F.col("__s") <= F.col("__last"), F.col("__e"))).alias("__pe"),
        F.max(F.when(F.col("__new") == 1, F.col("__before") + 1)).alias("__gs"),
        F.max(F.when(F.col("__new") == 1, F.col("__s") - 1)).alias("__ge"),
        F.first("__first").alias("__first"),
        F.first("__last").alias("__last"),
    )
    runs = runs.select(
        e,
        "__first",
        "__last",
        F.explode(
            F.array(
                F.struct(F.lit("period").alias("kind"), F.col("__ps").alias("s"), F.col("__pe").alias("e")),
                F.struct(F.lit("gap").alias("kind"), F.col("__gs").alias("s"), F.col("__ge").alias("e")),
            )
        ).alias("r"),
    ).where("r.s is not null")
    runs = runs.select(
        e,
        F.col("r.kind").alias("span_kind"),
        F.col("r.s").alias("s"),
        F.col("r.e").alias("e"),
        ((F.col("r.s") == F.col("__first")) | (F.col("r.e") == F.col("__last"))).alias("open"),
    )
    # shards without any interval: between the shards that have one, in front of them and behind
    blocks = free.select(e, F.col("__k").alias("__a"), F.col("__k").alias("__b")).unionByName(whole)
    blocks = blocks.join(dom, e).unionByName(dom.select(e, F.lit(-1).cast("bigint").alias("__a"), F.lit(-1).cast("bigint").alias("__b"), "__lo", "__hi"))
    after = F.lead("__a").over(Window.partitionBy(e).orderBy("__a"))
    blocks = blocks.withColumn("__next", F.coalesce(after, F.expr(f"(__hi - __lo) div {shard_width} + 1")))
    empty = blocks.where("__next > __b + 1").select(
        e, F.lit("gap").alias("span_kind"), first(F.col("__b") + 1).alias("s"), F.least("__hi", first(F.col("__next")) - 1).alias("e")
    )
    covered = whole.join(dom, e).select(e, F.lit("period").alias("span_kind"), first(F.col("__a")).alias("s"), F.least("__hi", first(F.col("__b") + 1) - 1).alias("e"))
    w2 = Window.partitionBy(e, "span_kind").orderBy("s")
    stitched = (
        runs.where("open").drop("open").unionByName(empty).unionByName(covered)
        .withColumn("new", F.coalesce((F.col("s") != F.lag("e").over(w2) + 1).cast("int"), F.lit(1)))
        .withColumn("run", F.sum("new").over(w2.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(e, "span_kind", "run")
        .agg(F.min("s").alias("s"), F.max("e").alias("e"))
        .select(e, "span_kind", "s", "e")
    )
    closed = runs.where("not open").select(e, "span_kind", "s", "e")
    return stitched.unionByName(closed).select(
        F.col(e).alias(entity), "span_kind", F.col("s").alias("span_start"), F.col("e").alias("span_end")
    )
