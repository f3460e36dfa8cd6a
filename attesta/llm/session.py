"""Session settings of these operators and tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from attesta.llm.arrays import BATCH_ROWS
from attesta.session import configure, scratch


def prepared(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches that stay small with long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def _path(spark: SparkSession) -> str:
    return f"{scratch(spark)}/llm/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = _path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """`df` as `stored` gives it, and metrics of its rows that are taken while it is written."""
    seen = Observation()
    back = stored(df.observe(seen, *(c.alias(n) for n, c in metrics.items())))
    return back, seen.get


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """`df` as `stored` gives it, and its number of rows."""
    back, seen = observed(df, n=F.count(F.lit(1)))
    return back, seen["n"]
