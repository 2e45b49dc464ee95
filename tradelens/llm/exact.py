"""Exact dedup: one row of every group of equal texts stays.

Method: rows are grouped by a 128-bit hash of their text.  The grouping key is
(hash, text): the hash leads, and the aggregate compares the bytes of texts with
equal hash, map-side first, so a group of copies of any size costs one row per
task.  Hashes that turn out to hold one text (all of them, short of a collision)
are joined to the rows by hash alone; only rows of a collided hash are joined
by their text.  The table of groups holds groups of two rows or more; it is
written before the join, so that Spark sees its size and can split a hot hash.

All of it is DataFrame expressions.

Defined cases: a null text is empty; the row that stays has the largest id
(``keep="smallest"``: the least), a null id yields to any other; identical rows
(same id, same text) are reported each and exactly one of them stays; an empty
table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.llm.frames import stored

#: Copies of one identical row that are handed out as one array.
BLOCK = 10_000


def content_hash(text: Column) -> Column:
    """128 bits of a text's bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def _copies(rows: DataFrame) -> DataFrame:
    """One row per copy again, the first of them marked; arrays of at most BLOCK numbers."""
    blocks = rows.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / BLOCK).cast("long"))))
    size = F.least(F.col("c") - F.col("b") * BLOCK, F.lit(BLOCK))
    return blocks.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), size))).withColumn("first", (F.col("b") == 0) & (F.col("i") == 1))


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest",
                normalise: Callable[[Column], Column] = lambda t: t,
                hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """id_column, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    ``normalise``: texts are equal if their normalised texts are identical.
    """
    best = {"largest": F.max, "smallest": F.min}[keep]
    text = normalise(F.coalesce(F.col(text_column), F.lit("")))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    rows = rows.select("id", hashed(F.col("text")).alias("h"), "text")

    texts = rows.groupBy("h", "text").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    groups = stored(texts.groupBy("h").agg(best("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
                    .where("n > 1"), "exact-groups")
    collided = groups.where("texts > 1").select("h")

    def judged(members: DataFrame, keys: list[str], of: DataFrame) -> DataFrame:
        own = members.groupBy("id", *keys, "sha").agg(F.count(F.lit(1)).alias("c"))
        both = own.join(of.withColumn("found", F.lit(True)), keys, "left").where("texts is null or texts = 1")
        keep_id = F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("id"))
        return _copies(both.withColumn("keep_id", keep_id)).select(
            F.col("id").alias(id_column), "keep_id", F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
            (F.col("id").eqNullSafe(F.col("keep_id")) & F.col("first")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))

    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")
    plain = judged(rows.select("id", "h", sha), ["h"], groups)
    apart = rows.join(collided, "h", "left_semi")
    equal = apart.groupBy("h", "text").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("n")).withColumn("texts", F.lit(1))
    return plain.union(judged(apart.select("id", "h", "text", sha), ["h", "text"], equal))
