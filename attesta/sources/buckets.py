"""Tables in buckets of a key, of which an update rewrites those it touches.

Every version of a bucket is a folder that is never changed: `<path>/v=<version>/bucket=<b>`. An update writes the buckets of its keys under the next version; all others keep their files. Readers take the latest committed version of
each bucket, so they see a table before or after an update. An update that is tried again replaces its own version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.sources import folders

BUCKETS = 64


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The latest committed version of each bucket, of those before `before`. At most as many names as there are buckets and versions are listed."""
    out: dict[int, int] = {}
    for version in sorted(int(n[2:]) for n in folders.names(spark, path) if n.startswith("v=")):
        if (before is None or version < before) and folders.complete(spark, f"{path}/v={version}"):
            out |= {int(n[7:]): version for n in folders.names(spark, f"{path}/v={version}") if n.startswith("bucket=")}
    return out


def latest(spark: SparkSession, path: str) -> int:
    """The number of the last committed version, -1 without any."""
    return max((int(n[2:]) for n in folders.names(spark, path) if n.startswith("v=") and folders.complete(spark, f"{path}/{n}")), default=-1)


def read(spark: SparkSession, path: str, schema: T.StructType, only: set[int] | None = None, before: int | None = None) -> DataFrame:
    """The table, or these of its buckets."""
    paths = [f"{path}/v={v}/bucket={b}" for b, v in sorted(versions(spark, path, before).items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def update(delta: DataFrame, path: str, key, schema: T.StructType, merge: Callable[[DataFrame, DataFrame], DataFrame], version: int | None = None, buckets: int = BUCKETS) -> set[int]:
    """Replaces the buckets of the keys of `delta` by merge(their rows, delta) and gives their numbers. The first update writes the table. A row's bucket follows from its key, so `merge` must keep keys in place.

    What reaches the driver are numbers of buckets. An empty delta writes nothing but an empty version.
    """
    spark, key = delta.sparkSession, [key] if isinstance(key, str) else list(key)
    version = latest(spark, path) + 1 if version is None else version
    touched = {r[0] for r in delta.select(bucket_of(key, buckets).alias("b")).distinct().collect()}
    merged = merge(read(spark, path, schema, touched, version), delta).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    # a bucket is one task and one file; keys, not rows, decide how large it is
    rows = merged.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/v={version}")
    return touched


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes versions of which no bucket is the latest, for readers that are done with them; gives their number."""
    used, last, gone = set(versions(spark, path).values()), latest(spark, path), 0
    for name in folders.names(spark, path):
        if name.startswith("v=") and int(name[2:]) not in used and int(name[2:]) < last:
            folders.remove(spark, f"{path}/{name}")
            gone += 1
    return gone
