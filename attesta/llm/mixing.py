"""Mixing sources to target weights: nested hash thresholds from histograms, without a sort of the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.arrays import quoted, unused
from attesta.llm.session import stored

#: Levels of the hash that are refined, and hexadecimal digits of each: 4,096 cells a level, 2^36 in all.
LEVELS, DIGITS = 3, 3
CELLS = 16 ** DIGITS


def cell_of(id_col: str) -> Column:
    """The first 36 bits of the MD5 of the id: the place of a document among those of its source."""
    digits = F.substring(F.md5(F.coalesce(quoted(id_col).cast("string"), F.lit("")).cast("binary")), 1, LEVELS * DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size (words) and `cell` (see `cell_of`)."""
    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(quoted(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
                       cell_of(id_col).alias("cell"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target. `weights` go to the sources in code-point order, null last, and repeat. Targets share `share` of all
    sizes by weight; none is above `most` times its source's size, and what is cut is shared again among the others until none is above:
    with sources by rising (limit / weight), those before the first that can bear its share get their limit and the others
    share the rest by weight. The frame has a row for each source, so its windows see the sources only.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    per = per.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
    order = Window.orderBy((F.col("limit") / F.col("w")), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(after))
    # the first source whose limit bears the level ends the sharing; without one all are at their limits
    level = F.min(F.when(F.col("limit") >= F.col("level") * F.col("w"), F.struct((F.col("limit") / F.col("w")).alias("k"), F.col("level").alias("level")))).over(every)["level"]
    per = per.withColumn("share_level", level)
    return per.select("source", "source_size", F.when(F.col("share_level").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("share_level") * F.col("w"))).alias("target"))


def _digit(level: int) -> Column:
    """The cell number of a document at a level, from 0."""
    return F.pmod(F.floor(F.col("cell") / F.lit(CELLS ** (LEVELS - 1 - level))), F.lit(CELLS)).cast("long")


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """source, source_size, target, rounds (how often every document is taken) and `below`: documents of a smaller cell are taken once more.

    The words that remain after the whole rounds are found in the histogram of the source: the cell in which the sum reaches them is the boundary
    and alone is cut finer at the next level. At the last level the boundary goes to the nearer side.
    """
    found = (targets.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
             .withColumn("left", F.col("target") - F.col("rounds") * F.col("source_size")).withColumn("edge", F.lit(0).cast("long")))
    for level in range(LEVELS):
        width = CELLS ** (LEVELS - 1 - level)
        inside = sizes.alias("d").join(found.alias("f"), F.col("d.source").eqNullSafe(F.col("f.source"))
                                       & (F.floor(F.col("d.cell") / F.lit(width * CELLS)).cast("long") * F.lit(width * CELLS) == F.col("f.edge")) & (F.col("f.left") > 0))
        hist = inside.groupBy(F.col("d.source").alias("source"), _digit(level).alias("digit")).agg(F.sum("d.size").alias("n"), F.first("f.left").alias("left"), F.first("f.edge").alias("edge"))
        upto = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("sum", F.sum("n").over(upto))
        crossed = F.col("sum") >= F.col("left")
        cell = F.min(F.when(crossed, F.struct("digit", "n", "sum")))
        step = hist.groupBy("source").agg(cell.alias("b"))
        # the first cell that reaches what is left; none can be missing but by rounding, and then all cells are below
        step = step.select(F.col("source").alias("s"), F.col("b.digit").alias("digit"), F.col("b.n").alias("n"), F.col("b.sum").alias("sum"))
        found = found.join(step, F.col("source").eqNullSafe(F.col("s")), "left")
        hit, before = F.col("digit").isNotNull(), F.col("sum") - F.col("n")
        if level < LEVELS - 1:
            edge, left = F.col("edge") + F.col("digit") * F.lit(width), F.col("left") - before
        else:
            nearer = F.when(F.col("sum") - F.col("left") <= F.col("left") - before, F.lit(1)).otherwise(F.lit(0))
            edge, left = F.col("edge") + F.col("digit") + nearer, F.lit(0.0)
        whole = F.when(F.col("left") > 0, F.lit(CELLS ** LEVELS)).otherwise(F.col("edge"))
        found = found.select("source", "source_size", "target", "rounds", F.when(hit, edge).otherwise(whole).cast("long").alias("edge"), F.when(hit, left).otherwise(F.lit(0.0)).alias("left"))
        found = stored(found)
    return found.select("source", "source_size", "target", "rounds", F.col("edge").alias("below"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0,
        most: float = 3.0) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target (of its source) and `copies`, how often the mix takes it.

    Every document is taken floor(target / source_size) times, and those whose hash lies below their source's threshold once more, so
    that no document is taken more than `most` times (rounded up). Null texts have size 0; null sources are one source, the last; documents with one id stand and fall together; an empty table gives none.
    A source is never a group of rows: histograms have 4,096 cells a source and are summed before they are shuffled.
    """
    sizes = stored(sized(docs, id_col, text_col, source_col))
    edges = thresholds(sizes, source_targets(sizes, weights, share, most))
    on = F.col("d.source").eqNullSafe(F.col("e.source"))
    return sizes.alias("d").join(F.broadcast(edges).alias("e") if edges.count() <= 100_000 else edges.alias("e"), on).select(
        "d.doc_id", "d.source", "d.size", "e.source_size", "e.target", (F.col("e.rounds") + F.when(F.col("d.cell") < F.col("e.below"), 1).otherwise(0)).cast("long").alias("copies"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """The rows that the mix takes, with all their columns, and `copies` (a longer name where the table has that column), how often each is taken.

    A row's cell and its source's threshold decide, so nothing is joined by id and no text is shuffled. See `mix` for nulls, ties and repeated rows.
    """
    sizes = stored(sized(docs, id_col, text_col, source_col))
    edges = thresholds(sizes, source_targets(sizes, weights, share, most)).withColumnRenamed("source", "of")
    rows = docs.select(F.struct(*(quoted(c) for c in docs.columns)).alias("row"), quoted(source_col).cast("string").alias("source"), cell_of(id_col).alias("cell"))
    copies = (F.col("rounds") + F.when(F.col("cell") < F.col("below"), 1).otherwise(0)).cast("long").alias(unused(docs, "copies"))
    both = rows.join(F.broadcast(edges) if edges.count() <= 100_000 else edges, F.col("source").eqNullSafe(F.col("of")))
    return both.select("row", copies).filter(F.col(unused(docs, "copies")) > 0).select("row.*", unused(docs, "copies"))


def digest(mixed: DataFrame) -> DataFrame:
    """The columns of the query."""
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
