"""T4: the shares and indices of A1, kept as micro-batches come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta import config as cfg
from attesta.operators.mix import share_of_cells
from attesta.session import cut
from attesta.sources import buckets
from attesta.streaming.streams import for_each_batch

CELLS = "account_id string, period string, dim_key string, n long"
#: For each (period, dimension) how many accounts have each share: counts that add up, and from which the exact median follows.
PEERS = "period string, dim_key string, share double, accounts long"


def _shares(cells: DataFrame, min_denom: int, sign: int) -> DataFrame:
    """(period, dim_key, share, accounts): what some accounts add to, or take from, the distributions of their peers."""
    d = cells.withColumn("denom", F.sum("n").over(Window.partitionBy("account_id", "period"))).filter(F.col("denom") >= min_denom)
    return d.select("period", "dim_key", (F.col("n") / F.col("denom")).alias("share"), F.lit(sign).cast("long").alias("accounts"))


def update_mix(counts: DataFrame, out: str, version: int, min_denom: int = cfg.MIN_DENOM) -> None:
    """Adds the counts (account_id, period, dim_key, n) of a micro-batch to the state in `out`. Read and written are the buckets of its accounts and of the periods and dimensions that their
    shares moved in. The version is the batch's number, so a batch that is tried again is added once."""
    spark = counts.sparkSession
    cells, peers = T.StructType.fromDDL(CELLS), T.StructType.fromDDL(PEERS)
    counts = cut(counts.groupBy("account_id", "period", "dim_key").agg(F.sum("n").alias("n")))
    key = ["account_id"]
    touched = {r[0] for r in counts.select(buckets.bucket_of(key, buckets.BUCKETS)).distinct().collect()}
    moved = counts.select("account_id", "period").distinct()
    old = buckets.read(spark, f"{out}/cells", cells, touched, version).join(moved, ["account_id", "period"], "left_semi")
    added = lambda rows, d: rows.unionByName(d).groupBy("account_id", "period", "dim_key").agg(F.sum("n").alias("n"))
    delta = _shares(added(old, counts), min_denom, 1).unionByName(_shares(old, min_denom, -1)).groupBy("period", "dim_key", "share").agg(F.sum("accounts").alias("accounts")).filter("accounts != 0")
    delta = cut(delta)  # before the cells change
    total = lambda rows, d: rows.unionByName(d).groupBy("period", "dim_key", "share").agg(F.sum("accounts").alias("accounts")).filter("accounts != 0")
    buckets.update(delta, f"{out}/peers", ["period", "dim_key"], peers, total, version)
    buckets.update(counts, f"{out}/cells", key, cells, added, version)


def peer_medians(peers: DataFrame) -> DataFrame:
    """(period, dim_key, peer_median_share, peer_n_accounts): exact medians from counts of shares, the mean of the two middle ones where their number is even."""
    upto = Window.partitionBy("period", "dim_key").orderBy("share")
    d = peers.withColumn("upto", F.sum("accounts").over(upto)).withColumn("all", F.sum("accounts").over(Window.partitionBy("period", "dim_key")))
    at = lambda place: F.min(F.when(F.col("upto") >= place, F.col("share")))
    low, high = at(F.floor((F.col("all") + 1) / 2)), at(F.floor(F.col("all") / 2) + 1)
    return d.groupBy("period", "dim_key").agg(((low + high) / 2).alias("peer_median_share"), F.first("all").alias("peer_n_accounts"))


def mix_shares(spark: SparkSession, out: str, min_denom: int = cfg.MIN_DENOM, burst: float = cfg.BURST_RATIO) -> DataFrame:
    """`share_of_mix` as the state in `out` gives it: from its counts alone."""
    cells = buckets.read(spark, f"{out}/cells", T.StructType.fromDDL(CELLS))
    return share_of_cells(cells, peer_medians(buckets.read(spark, f"{out}/peers", T.StructType.fromDDL(PEERS))), min_denom, burst)


def mix_shares_stream(stream: DataFrame, acct: str, period: str, dim: str, out: str, checkpoint: str, min_denom: int = cfg.MIN_DENOM) -> None:
    """T4: the state of A1 after every micro-batch of a stream; read it with `mix_shares`. Rows without a period are out."""
    rows = stream.filter(F.col(period).isNotNull()).select(F.col(acct).alias("account_id"), F.col(period).alias("period"), F.coalesce(F.col(dim), F.lit("unclassified")).alias("dim_key"))

    def land(batch: DataFrame, number: int) -> None:
        update_mix(batch.groupBy("account_id", "period", "dim_key").agg(F.count(F.lit(1)).alias("n")), out, number, min_denom)
    for_each_batch(rows, checkpoint, land)
