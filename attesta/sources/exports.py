"""Export of the posting corpus and selection of the work queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attesta import config as cfg


def jobs_index(postings: DataFrame, extracts: DataFrame, sites: DataFrame) -> DataFrame:
    """The corpus a reader filters, per owning or mirrored account: postings with a site or admitted, with their site
    city and team and tool text. Sort or partition at the write; see `write_jobs_index`."""
    ex = extracts.select("posting_id", "team_name", F.array_join("tech_stack", " · ").alias("tech"), F.lit(True).alias("has_extract"))
    city = sites.select("site_id", F.coalesce(F.nullif("city", F.lit("")), "site").alias("_city"))
    d = shown(postings).filter("NOT skipped").join(ex, "posting_id", "left").join(city, "site_id", "left")
    return d.select("shown_account", "posting_id", F.col("role_title").alias("title"), "url", F.col("site_id").alias("site"),
                    F.coalesce("_city", "city_raw").alias("city"), F.col("job_family").alias("family"), "last_seen",
                    F.coalesce("tier2_score", F.lit(0)).alias("score"), F.coalesce("has_extract", F.lit(False)).alias("has_extract"),
                    F.coalesce("team_name", F.lit("")).alias("team"), F.coalesce("tech", F.lit("")).alias("tech"))


def shown(postings: DataFrame) -> DataFrame:
    """Each posting under its own account and under its mirror, with whether the export leaves it out."""
    accounts = F.array_distinct(F.array_compact(F.array("account_id", "mirror_account_id")))
    out = F.col("site_id").isNull() & ~F.coalesce("tier2_admit", F.lit(False))
    return postings.withColumn("shown_account", F.explode(accounts)).withColumn("skipped", out)


def skipped_counts(postings: DataFrame) -> DataFrame:
    """Per account the postings left out of the export, so a reader can say what is not shown."""
    return shown(postings).groupBy("shown_account").agg(F.count_if("skipped").alias("skipped_no_site"))


def write_jobs_index(index: DataFrame, path: str) -> None:
    """JSON partitioned by account, best scores first inside each file; a large account gets several files."""
    spread = index.repartitionByRange("shown_account", F.col("score").desc(), "posting_id")
    spread.sortWithinPartitions("shown_account", F.col("score").desc(), "posting_id").write.partitionBy("shown_account").json(path)


def extraction_queue(postings: DataFrame, bodies: DataFrame, done: DataFrame, shard: int, cap: int, min_score: int = 0,
                     min_chars: int = cfg.MIN_BODY) -> DataFrame:
    """(posting_id, score, rn, shard, n_dropped): admitted postings with a usable body and no extract, best scores first,
    cut at shard x cap. The number left out travels on every row.

    The cut is a top-k of constant size; only that bounded result is numbered.
    """
    usable = bodies.filter(F.length("text") >= min_chars).select("posting_id")
    open_ = (postings.filter(F.coalesce("tier2_admit", F.lit(False)) & (F.coalesce("tier2_score", F.lit(0)) >= min_score))
             .select("posting_id", F.coalesce("tier2_score", F.lit(0)).alias("score"))
             .join(usable, "posting_id", "left_semi").join(done.select("posting_id"), "posting_id", "left_anti"))
    order = [F.col("score").desc(), F.col("posting_id").asc()]
    top = open_.orderBy(*order).limit(shard * cap)
    total = open_.agg(F.count(F.lit(1))).scalar()
    rn = F.row_number().over(Window.partitionBy().orderBy(*order))
    return (top.withColumn("rn", rn).withColumn("shard", F.floor((F.col("rn") - 1) / shard).cast("int"))
            .withColumn("n_dropped", F.greatest(total - shard * cap, F.lit(0))))
