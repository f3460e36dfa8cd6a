"""Session settings and lineage cutting shared by every operator."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot join key is split even where that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a Parquet file is smaller than its rows in memory: what is broadcast for its size must be small there
    "spark.sql.sources.fileCompressionFactor": "10.0",
    # folders are listed in some hundred tasks, however many they are
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    # the shuffle files of a job go when it ends, not when the driver happens to collect garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: `spark.checkpoint.dir` of the session.

    A local session (tests, bench) may leave it unset and gets a scratch folder; a cluster may not,
    because a machine-local folder is lost with its machine.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        found = tempfile.mkdtemp(prefix="attesta-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession) -> str:
    """A folder of this application in the shared folder, deleted when the driver's Python ends."""
    sc = spark.sparkContext
    path = f"{shared_dir(spark)}/attesta-{sc.applicationId}"
    if path not in _scratch:
        _scratch.add(path)
        atexit.register(_remove, sc, path)
    return path


_scratch: set[str] = set()


def _remove(sc, path: str) -> None:
    with contextlib.suppress(Exception):  # a session that has ended takes nothing more
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


#: rows of a bucket of `land_by`: some hundred bytes each, so that a task sorts its own in memory
BUCKET_ROWS = 250_000


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder; survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def land(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: for a frame that several later plans read in part."""
    path = f"{scratch(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_by(df: DataFrame, key: str, rows: int, made: Column | None = None) -> DataFrame:
    """`land` as a table in buckets of a string column `key`, about `BUCKET_ROWS` of its `rows` in each: frames that come from it are joined by the key without a shuffle.

    made: the key as an expression of the columns, if it is none of them; it is made once more behind the shuffle, which goes without it. There are no fewer buckets than shuffle partitions, as Spark would deal a table of fewer anew.
    """
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
    name = f"attesta_{uuid.uuid4().hex}"
    dealt = df.repartition(n, key) if made is None else df.repartition(n, made).withColumn(key, made)
    dealt.write.bucketBy(n, key).option("path", f"{scratch(spark)}/{name}").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name alone: the files stay as long as those of `land`
    return out
