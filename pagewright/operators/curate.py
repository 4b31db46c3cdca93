"""Curation: filters, counts, decisions, and the state of interrupted runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T


def text_filter(chunks: DataFrame, query: str = "", section: str | None = None, flagged: DataFrame | None = None, ident: str = "chunk_id") -> DataFrame:
    """Chunks of a section whose text, keywords or title hold `query` without case; only flagged ones if
    `flagged` is given."""
    d = chunks.join(flagged.select(ident).distinct(), ident, "left_semi") if flagged is not None else chunks
    if section is not None:
        d = d.where(F.col("section_title") == section)
    hay = F.concat_ws(" ", F.coalesce("text", F.lit("")), F.array_join(F.coalesce("keywords", F.array()), " "), F.coalesce("section_title", F.lit("")))
    return d.where(F.contains(F.lower(hay), F.lit(query.lower())))


def section_counts(chunks: DataFrame, keys: list[str], included: str = "inc") -> DataFrame:
    """Per section the chunks and included chunks, and its box: checked, indeterminate or empty."""
    c = chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("chunks"), F.count_if(F.coalesce(included, F.lit(True))).alias("included"))
    state = F.when(F.col("included") == F.col("chunks"), "checked").when(F.col("included") > 0, "indeterminate").otherwise("empty")
    return c.withColumn("state", state)


def token_stats(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Upper median, least and largest token count over positive ones, by counts per value: the list of
    all values is never gathered."""
    n = chunks.where("token_count > 0").groupBy(*keys, "token_count").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("token_count")
    n = n.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    hit = F.min(F.when(F.col("upto") > F.floor(F.col("total") / 2), F.col("token_count")))
    return n.groupBy(*keys).agg(hit.alias("median_tokens"), F.min("token_count").alias("min_tokens"), F.max("token_count").alias("max_tokens"))


def curated_export(chunks: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks without the excluded ones; edited texts replace theirs, are counted anew and marked.
    `decisions`: keys, inc (false excludes), new_text (null: not edited)."""
    d = chunks.join(decisions.select(*keys, "inc", "new_text"), keys, "left").where(F.coalesce("inc", F.lit(True)))
    edited = F.col("new_text").isNotNull()
    d = d.withColumn("edited", edited).withColumn("token_count", F.when(edited, T.ascii_token_count(F.col("new_text"))).otherwise(F.col("token_count")))
    return d.withColumn("text", F.coalesce("new_text", "text")).drop("inc", "new_text")


def curated_gate(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ok: the line is a complete JSON object with a text."""
    one = f"try_cast(try_parse_json(concat('[', {raw}, ']')) as array<variant>)"
    v = F.expr(f"case when size({one}) = 1 then try_cast(get({one}, 0) as map<string,variant>) end")
    return lines.withColumn("ok", F.coalesce(F.map_contains_key(v, "text"), F.lit(False)))


def over_limit(chunks: DataFrame, limit: int) -> DataFrame:
    """Edited chunks recounted, those over the limit."""
    return chunks.withColumn("token_count", T.token_count(F.col("text"))).where(F.col("token_count") > limit)


def completed_prefix(sections: DataFrame, chunks: DataFrame, key: str, title: str = "title", ord_col: str = "ord") -> DataFrame:
    """(key, done): how many sections in order have chunks (by title) before the first that has none.
    `ord` numbers each document's sections from 0 without holes."""
    have = chunks.select(key, F.col("section_title").alias(title)).distinct().withColumn("__h", F.lit(True))
    d = sections.join(have, [key, title], "left")
    return d.groupBy(key).agg(F.coalesce(F.min(F.when(F.col("__h").isNull(), F.col(ord_col))), F.count(F.lit(1)).cast("int")).alias("done"))


def resume_plan(sections: DataFrame, chunks: DataFrame, key: str, title: str = "title", ord_col: str = "ord") -> DataFrame:
    """The chunks an interrupted run keeps, numbered anew: those of the completed sections' titles."""
    done = completed_prefix(sections, chunks, key, title, ord_col)
    kept = sections.join(done, key).where(F.col(ord_col) < F.col("done")).select(key, F.col(title).alias("section_title")).distinct()
    w = Window.partitionBy(key).orderBy("chunk_index")
    n = chunks.select(key, "section_title", "chunk_index").join(kept, [key, "section_title"], "left_semi")
    n = n.select(key, "chunk_index", (F.row_number().over(w) - 1).cast("int").alias("__n"))  # no text in the window
    return chunks.join(n, [key, "chunk_index"]).drop("chunk_index").withColumnRenamed("__n", "chunk_index")


def usage_totals(log: DataFrame, counters: list[str], model: str = "model") -> DataFrame:
    """Sums of the counters per model; rows without any counter are no calls."""
    some = F.coalesce(*counters).isNotNull()
    return log.groupBy(model).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters], F.count_if(some).alias("calls"))


def usage_cost(totals: DataFrame, rates: DataFrame, counters: list[str], model: str = "model") -> DataFrame:
    """One row: the cost of all models by the first rate whose prefix fits, per million; null if a model has
    none. `rates`: prefix, ord and a column rate_<counter> each. It is a given price list of at most 10,000
    rows."""
    if rates.limit(10_001).count() > 10_000:
        raise ValueError("the price list has more than 10,000 rows")
    j = totals.join(F.broadcast(rates), F.expr(f"startswith({model}, prefix)"), "left")
    r = j.groupBy(model).agg(F.min_by(F.struct(*[F.col(c) for c in counters], *[F.col(f"rate_{c}") for c in counters]), "ord").alias("r"), F.count("prefix").alias("n"))
    cost = sum((F.col(f"r.{c}") * F.col(f"r.rate_{c}") for c in counters), F.lit(0.0)) / 1_000_000
    return r.agg(F.when(F.count(F.lit(1)) == F.count_if(F.col("n") > 0), F.coalesce(F.sum(cost), F.lit(0.0))).alias("cost"))


def job_listing(jobs: DataFrame) -> DataFrame:
    """Jobs, the newest first."""
    return jobs.orderBy(F.desc("created_at"), "job_id")
