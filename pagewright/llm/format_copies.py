"""Records that differ only in formatting: one record each, with the number of copies.

A record is canonical when every string is reduced to its letters and digits in one case and the
fields are put in order of their names; the 128-bit hash of that form is the key. Hot keys are
found exactly from partial counts. Their rows are aggregated in two levels (key and salt, then
key) and meet the result by a bounded broadcast; all other keys take one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.operators.skew import FLOOR, MAX_HOT, hot_keys
from pagewright.session import materialize

SALTS = 64


def canonical_text(c: Column) -> Column:
    """Letters and digits only, without letter case: the sharp s equals its capital form SS, the final
    sigma the other one. Combining marks are neither: "é" in one code point is a letter, the accent of a decomposed
    one is ignored, as are vowel signs."""
    return F.replace(F.replace(F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", "")), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def canonical_json(raw: str) -> Column:
    """Canonical form of a complete JSON object in column `raw`, else null.

    Strings and the strings of lists are reduced by `canonical_text`; numbers, booleans, nulls
    and nested objects count by value, the order of fields is free. Blank, cut or otherwise
    incomplete lines, values that aren't objects, and objects that name a field twice are null.
    """
    # the brackets make text behind a complete object an error
    one = f"try_cast(try_parse_json(concat('[', {raw}, ']')) as array<variant>)"
    rec = f"case when size({one}) = 1 then try_cast({one}[0] as map<string,variant>) end"

    def text(x: str) -> str:
        return rf"replace(replace(lower(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]+', '')), 'ß', 'ss'), 'ς', 'σ')"

    value = (
        "case when schema_of_variant(m[k]) = 'STRING' then concat('s', " + text("variant_get(m[k], '$', 'string')") + ") "
        "when schema_of_variant(m[k]) = 'ARRAY<STRING>' then concat('l', array_join(transform("
        "variant_get(m[k], '$', 'array<string>'), x -> coalesce(concat('s', " + text("x") + "), 'n')), '\\u0001')) "
        "else concat('v', to_json(m[k])) end"
    )
    return F.expr(
        f"transform(array({rec}), m -> array_join(transform(array_sort(map_keys(m)), k -> concat(k, '\\u0002', {value})), '\\u0003'))[0]"
    )


def keyed_lines(df: DataFrame, id_col: str, raw_col: str) -> DataFrame:
    """(id, key) of every complete record; 16 bytes of key whatever the record's length."""
    d = df.select(F.col(id_col).alias("id"), F.col(raw_col).alias("raw")).where("id is not null")
    return d.select("id", F.unhex(F.md5(canonical_json("raw").cast("binary"))).alias("key")).where("key is not null")


def collapse(keyed: DataFrame, floor: int = FLOOR, max_hot: int = MAX_HOT, salts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """`keyed` has id and key. Returns

    - groups (keep_id, n_copies): one row per distinct record, n_copies counts its lines,
    - copies (keep_id, copy_id): one row per line that isn't its group's representative.

    The representative is the smallest id. A row delivered again (same id and key) counts once.
    An empty table gives two empty results.
    """
    keyed = materialize(keyed, "keys")  # the parse runs once
    hot = materialize(hot_keys(keyed, "key", floor, max_hot), "hot-keys")
    hot_b = F.broadcast(hot)
    cold = keyed.join(hot_b, "key", "left_anti")
    w = Window.partitionBy("key").orderBy("id")
    cold = cold.withColumn("keep_id", F.first("id").over(w)).withColumn("again", F.coalesce(F.lag("id").over(w) == F.col("id"), F.lit(False)))
    cold = cold.where("not again")
    # the salt follows from the id, so rows delivered again meet in one salt
    hot_rows = keyed.join(hot_b, "key", "left_semi").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    by_salt = hot_rows.groupBy("key", "salt").agg(F.min("id").alias("keep_id"))
    reps = by_salt.groupBy("key").agg(F.min("keep_id").alias("keep_id"))
    unique_hot = hot_rows.groupBy("key", "salt", "id").agg(F.count(F.lit(1)).alias("n"))
    hot_out = unique_hot.join(F.broadcast(reps), "key")
    copies = (
        cold.select("keep_id", F.col("id").alias("copy_id"))
        .unionByName(hot_out.select("keep_id", F.col("id").alias("copy_id")))
        .where("keep_id <> copy_id")
    )
    groups = (
        cold.groupBy("key").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n_copies"))
        .unionByName(
            unique_hot.groupBy("key", "salt").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
            .groupBy("key").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n_copies"))
        )
        .select("keep_id", "n_copies")
    )
    return groups, copies
