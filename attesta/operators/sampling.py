"""Reproducible samples: order by a seeded hash, so a rerun on the same rows picks the same ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.operators.skew import rank_within, top_per_group


def seeded(id: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id).cast("string")))


def quotas(n: int) -> dict[str, int]:
    """M1: 40% disagreements, 25% reviews, agreements the rest."""
    disagree, review = round(n * 0.4), round(n * 0.25)
    return {"disagree": disagree, "review": review, "agree": n - disagree - review}


def quota_sample(df: DataFrame, bucket: str, strata, quota: dict[str, int], seed: int = cfg.SAMPLE_SEED, id: str = "site_id") -> DataFrame:
    """M1: per bucket its quota, taken round-robin over the strata, in seeded order within each.

    Two bounded top-k passes; no stratum is ever sorted whole in one task.
    """
    strata = list(strata)
    most = max(quota.values())
    d = df.withColumn("_h", seeded(id, seed))
    d = top_per_group(d, [bucket, *strata], [F.col("_h").asc(), F.col(id).asc()], most, "_turn")
    take = F.create_map(*[F.lit(x) for kv in quota.items() for x in kv])
    d = top_per_group(d, [bucket], [F.col("_turn").asc(), *[F.col(s).asc() for s in strata]], most, "pick")
    return d.filter(F.col("pick") <= F.try_element_at(take, F.col(bucket))).drop("_h", "_turn")


def seeded_sample(df: DataFrame, key: str, n: int = cfg.TITLE_SAMPLE, seed: int = cfg.SAMPLE_SEED) -> DataFrame:
    """M2: `n` distinct keys in seeded order (a top-k, merged from one bounded heap per partition)."""
    return df.select(key).distinct().orderBy(seeded(key, seed), key).limit(n)


def systematic_sample(df: DataFrame, by: str, order: str, n: int = 4) -> DataFrame:
    """M3: every k-th row of each group in order, k = max(1, rows // n), the first `n` of them."""
    size = df.groupBy(by).agg(F.greatest(F.floor(F.count(F.lit(1)) / n), F.lit(1)).alias("_step"))
    d = rank_within(df, [by], [order], "_rn").join(size, by)
    hit = F.pmod(F.col("_rn") - 1, F.col("_step")) == 0
    return d.filter(hit & ((F.col("_rn") - 1) < n * F.col("_step"))).drop("_rn", "_step")
