"""Stored tables: typed loads, snapshot writes, CSV exchange, the run ledger."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.operators.quality import guard_shrink
from attesta.schemas import schema as schema_of
from attesta.sources import buckets

ACCRETING = {"postings", "quotes", "units", "edges"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema, in order; missing ones are null, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def load(spark: SparkSession, path: str, name: str) -> DataFrame:
    """S3: a stored table, or an empty frame of its schema when the path does not exist."""
    schema = schema_of(name)
    try:
        return conform(spark.read.parquet(path), schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def save(df: DataFrame, path: str, name: str, previous: DataFrame | None = None, allow_shrink: bool = False) -> None:
    """Write a new snapshot folder. Readers switch to it when it is complete, so no lock is needed; an accreting table
    is checked against its previous snapshot first (V6)."""
    if previous is not None and name in ACCRETING and not allow_shrink:
        guard_shrink(previous, df)
    conform(df, schema_of(name)).write.mode("errorifexists").parquet(path)


def save_changes(delta: DataFrame, path: str, name: str, key, merge=None, allow_shrink: bool = False) -> set[int]:
    """S4 by parts: only the buckets (`sources.buckets`) of the delta's keys are written, all other files stay as they are; gives the touched buckets. By default a row of the delta replaces the row of its key.

    merge(rows, delta) makes another rule of it, such as U3 or U9. An accreting table is checked against the same buckets of its last version before these count (V6).
    """
    schema, key = schema_of(name), [key] if isinstance(key, str) else list(key)
    replace = lambda rows, d: rows.join(d.select(*key).distinct(), key, "left_anti").unionByName(d)

    def merged(rows: DataFrame, d: DataFrame) -> DataFrame:
        out = (merge or replace)(rows, d)
        if name in ACCRETING and not allow_shrink:
            guard_shrink(rows, out)
        return out
    return buckets.update(conform(delta, schema), path, key, schema, merged)


def load_parts(spark: SparkSession, path: str, name: str) -> DataFrame:
    """S3: a table that `save_changes` keeps."""
    return buckets.read(spark, path, schema_of(name))


def from_text(c: str, kind: T.DataType) -> Column:
    """One CSV cell as a typed value: empty is null, both boolean spellings, pipe- or semicolon-joined lists."""
    v = F.when(F.trim(F.col(c)) != "", F.trim(F.col(c)))
    if isinstance(kind, T.ArrayType):
        return F.when(v.isNotNull(), F.split(v, r"[|;]")).cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(v) == "true", True).when(F.lower(v) == "false", False)
    return v.try_cast(kind)


def load_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """S3: a CSV exchange file of a table as typed rows."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    schema = schema_of(name)
    have = {c.lstrip("﻿"): c for c in raw.columns}
    raw = raw.select(*[F.col(f"`{c}`").alias(n) for n, c in have.items()])
    return raw.select(*[(from_text(f.name, f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def to_text(df: DataFrame) -> DataFrame:
    """The CSV form of a table: arrays pipe-joined, maps and structs as JSON, null as empty."""
    def cell(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            return F.array_join(f.name, "|")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(f.name)
        return F.col(f.name).cast("string")
    return df.select(*[F.coalesce(cell(f), F.lit("")).alias(f.name) for f in df.schema])


def counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """`df` with run counters that fill in while it is written, at no extra pass."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def log_run(spark: SparkSession, path: str, record: dict) -> None:
    """Append one run to the ledger."""
    schema = schema_of("runs")
    row = tuple(record.get(f.name) for f in schema)
    spark.createDataFrame([row], schema).write.mode("append").parquet(path)
