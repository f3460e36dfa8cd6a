"""Runs of words or characters as keys: what contains what, without comparing all with all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.session import land

#: Texts are looked for by runs of so many characters, shorter ones as they are.
CHARS = 4
#: Texts of a group of at most so many rows are compared with one another in one row; larger groups meet by runs. NEAR large groups at most go to every task.
FEW, NEAR = 64, 100_000


def runs(df: DataFrame, id: str, parts: str, gram: int) -> DataFrame:
    """(id, _k): hashes of the distinct runs of `gram` neighbouring parts; `gram` itself is part of the hash."""
    n = F.size(parts) - (gram - 1)
    shifted = F.arrays_zip(*[F.slice(parts, F.lit(i + 1), n).alias(f"w{i}") for i in range(gram)])
    keys = F.transform(shifted, lambda r: F.xxhash64(F.lit(gram), *[r[f"w{i}"] for i in range(gram)]))
    return df.filter(F.size(parts) >= gram).select(id, F.explode(F.array_distinct(keys)).alias("_k"))


def containments(df: DataFrame, group: list[str], text: str, few: int = FEW) -> DataFrame:
    """(group, _inner, _outer): the pairs of different texts of a group of which the outer one contains the inner one.

    The texts of a group of at most `few` rows are gathered and compared at once, at most `few` comparisons a text. In a larger group each text is looked for by its anchor: the run of its characters that
    fewest texts of its group have. Only texts with that run are compared, so pairs follow shared runs, not the square of a group. Null and empty texts and null groups take no part.
    """
    texts = df.select(*group, F.col(text).alias("_t")).filter(F.length("_t") > 0)
    for c in group:
        texts = texts.filter(F.col(c).isNotNull())
    large = land(texts.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > few).select(*group))
    n = large.count()
    if not n:
        return _compared(texts, group)
    large = F.broadcast(large) if n <= NEAR else large
    return _compared(texts.join(large, group, "left_anti"), group).unionByName(_anchored(texts.join(large, group, "left_semi"), group))


def _compared(texts: DataFrame, group: list[str]) -> DataFrame:
    """`containments` of small groups."""
    sets = texts.groupBy(*group).agg(F.collect_set("_t").alias("_all"))
    each = sets.select(*group, "_all", F.explode("_all").alias("_inner"))
    return each.select(*group, "_inner", F.explode(F.filter("_all", lambda o: (o != F.col("_inner")) & F.contains(o, F.col("_inner")))).alias("_outer"))


def _anchored(texts: DataFrame, group: list[str]) -> DataFrame:
    """`containments` of groups of any size."""
    texts = texts.distinct().select(F.struct(*group, F.col("_t")).alias("_id"), F.split("_t", "").alias("_c"))
    kinds = range(1, CHARS + 1)
    own = None
    for k in kinds:
        part = runs(texts, "_id", "_c", k).select("_id", F.lit(k).alias("_kind"), "_k")
        own = part if own is None else own.unionByName(part)
    own = own.select(*[F.col(f"_id.{c}").alias(c) for c in group], F.col("_id._t").alias("_t"), "_kind", "_k")
    key = [*group, "_kind", "_k"]
    many = own.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    asked = own.filter(F.col("_kind") == F.least(F.length("_t"), F.lit(CHARS))).join(many, key)
    anchors = asked.groupBy(*group, F.col("_t").alias("_inner")).agg(F.min_by(F.struct("_kind", "_k", "_n"), F.struct("_n", "_k")).alias("_a")).select(*group, "_inner", "_a.*")
    anchors = anchors.filter("_n > 1").drop("_n")  # a text with a run that it alone has is in no other
    return anchors.join(own.withColumnRenamed("_t", "_outer"), key).filter((F.col("_inner") != F.col("_outer")) & F.contains(F.col("_outer"), F.col("_inner"))).select(*group, "_inner", "_outer")
