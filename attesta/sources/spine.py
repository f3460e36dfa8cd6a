"""Account lists and messy site spreadsheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.gates import fit_from_verdict
from attesta.functions.text import norm, slug
from attesta.sources.cells import read_cells

#: Column titles and the names they get; a sheet with other titles gives its own map.
COLUMNS = {"Account": "account", "Site": "site", "Pipeline": "pipeline", "City": "city", "Metro": "metro", "Functions": "functions", "Modality": "modality",
           "Verdict": "verdict_auto", "Manual verdict": "verdict_manual", "Manual reason": "verdict_reason", "Site head": "named_site_head", "Evidence": "evidence_titles", "Source": "source"}


def parse_spine(rows: DataFrame, required=("Account", "Site"), appendix_prefixes=None, junk=None, header_rows: int = 6, columns=None) -> DataFrame:
    """The site rows of messy exports.

    The header is the first of the first six rows holding all required names. Reading stops at the first row whose account
    starts an appendix; blank rows, junk rows and rows without a site are dropped. rows: (file, row_no, cells). The header
    and the cut are one small row per file, joined back, so rows are filtered in parallel.
    """
    is_header = F.forall(F.array(*[F.lit(r) for r in required]), lambda r: F.array_contains("cells", r))
    heads = rows.filter(is_header).groupBy("file").agg(F.min("row_no").alias("_h"), F.min_by("cells", "row_no").alias("_header"))
    firsts = rows.groupBy("file").agg(F.min("row_no").alias("_first"))
    heads = heads.join(firsts, "file").filter(F.col("_h") - F.col("_first") < header_rows).drop("_first")
    at = lambda name: F.coalesce(F.try_element_at("cells", F.nullif(F.array_position("_header", name), F.lit(0)).cast("int")), F.lit(""))
    body = rows.join(heads, "file").filter((F.col("row_no") > F.col("_h")) & F.exists("cells", lambda c: c != ""))
    body = body.select("file", "row_no", *[at(name).alias(col) for name, col in (columns or COLUMNS).items()]).withColumn("_a", norm("account"))
    starts = F.lit(False)
    for p in appendix_prefixes or cfg.APPENDIX_PREFIXES:
        starts = starts | F.startswith("_a", F.lit(p))
    stop = body.filter(starts).groupBy("file").agg(F.min("row_no").alias("_cut"))
    d = body.join(stop, "file", "left").filter(F.col("_cut").isNull() | (F.col("row_no") < F.col("_cut")))
    return d.filter((F.col("_a") != "") & ~F.col("_a").isin(list(junk or cfg.JUNK_ACCOUNTS)) & (F.col("site") != "")).drop("_a", "_cut")


def read_spine(spark: SparkSession, path: str, **rules) -> DataFrame:
    """S1 over files."""
    return parse_spine(read_cells(spark, path), **rules)


def spine_fit() -> Column:
    """The fit of a spine row: the manual verdict, else the automatic one."""
    manual = F.coalesce("verdict_manual", F.lit(""))
    return fit_from_verdict(F.when(manual != "", manual).otherwise(F.col("verdict_auto")))


def accounts_from(raw: DataFrame) -> DataFrame:
    """Typed account rows; `Exclude` = x makes an account inactive."""
    cell = lambda name: F.when(F.trim(F.col(f"`{name}`")) != "", F.trim(F.col(f"`{name}`"))) if name in raw.columns else F.lit(None).cast("string")
    out = F.coalesce(F.lower(cell("Exclude")) == "x", F.lit(False))
    return raw.filter(cell("Company").isNotNull()).select(
        slug(cell("Company")).alias("account_id"), cell("Company").alias("company"), F.lit(True).alias("in_universe"),
        (~out).alias("active"), out.alias("exclude"), cell("HQ").alias("hq"), cell("Primary Modalities").alias("primary_modalities"),
        cell("Pipeline Status").alias("pipeline_status"), cell("Deal Owner").alias("deal_owner"))


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """S2 over a CSV with an optional byte-order mark."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    return accounts_from(raw.select(*[F.col(f"`{c}`").alias(c.lstrip("﻿")) for c in raw.columns]))
