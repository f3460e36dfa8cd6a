"""Typed filter queries over the records. Every function returns the limited records and the full count."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions.gates import confidence_rank


class Answer(NamedTuple):
    """records, limited, and a one-row frame with the unlimited count."""

    records: DataFrame
    count: DataFrame


def _answer(df: DataFrame, limit: int | None, *order: Column) -> Answer:
    ordered = df.orderBy(*order) if order else df
    return Answer(ordered.limit(limit) if limit else ordered, df.agg(F.count(F.lit(1)).alias("count")))


def _where(df: DataFrame, **equal) -> DataFrame:
    for col, value in equal.items():
        if value is not None:
            df = df.filter(F.col(col) == value)
    return df


def _at_least(df: DataFrame, min_confidence: str | None) -> DataFrame:
    if min_confidence is None:
        return df
    return df.filter(confidence_rank("confidence") >= confidence_rank(F.lit(min_confidence)))


def list_accounts(accounts: DataFrame, coverage: DataFrame, units: DataFrame, postings: DataFrame) -> Answer:
    """Q1: active accounts of the universe with sites, covered sites, observed units and indexed postings; most units first."""
    one = F.count(F.lit(1))
    cov = coverage.groupBy("account_id").agg(one.alias("sites"), F.count_if(F.col("coverage_state") == "covered").alias("sites_covered"))
    un = units.filter(F.col("unit_kind") == "observed").groupBy("account_id").agg(one.alias("org_units"))
    po = postings.groupBy("account_id").agg(one.alias("postings_indexed"))
    d = accounts.filter("active AND in_universe").select("account_id", "company")
    for side in (cov, un, po):
        d = d.join(side, "account_id", "left")
    return _answer(d.na.fill(0), None, F.col("org_units").desc(), F.col("account_id"))


def list_org_units(units: DataFrame, account_id=None, site_id=None, min_confidence=None, include_unmapped: bool = True, limit: int | None = None) -> Answer:
    """Q2: units that were not rejected."""
    d = _at_least(_where(units.filter(F.col("status") != "rejected"), account_id=account_id, site_id=site_id), min_confidence)
    if not include_unmapped:
        d = d.filter(F.col("unit_kind") != "named_not_mapped")
    return _answer(d, limit, F.col("account_id"), F.col("n_postings").desc(), F.col("unit_id"))


def get_org_unit(units: DataFrame, edges: DataFrame, evidence: DataFrame, quotes: DataFrame, postings: DataFrame, unit_id: str) -> dict[str, DataFrame]:
    """Q3: the unit, the edges at either end of it, and its provenance, as three frames."""
    touching = edges.filter((F.col("src_unit_id") == unit_id) | (F.col("dst_unit_id") == unit_id))
    return {"unit": units.filter(F.col("unit_id") == unit_id), "edges": touching,
            "provenance": get_provenance(quotes, postings, evidence=evidence, unit_id=unit_id).records}


def list_org_edges(edges: DataFrame, account_id=None, edge_type=None, min_confidence=None, limit: int | None = None) -> Answer:
    """Q4: edges that were not rejected."""
    d = _at_least(_where(edges.filter(F.col("status") != "rejected"), account_id=account_id, edge_type=edge_type), min_confidence)
    return _answer(d, limit, F.col("account_id"), F.col("edge_type"), F.col("src_unit_id"), F.col("edge_id"))


def get_provenance(quotes: DataFrame, postings: DataFrame, quote_ids: DataFrame | None = None, evidence: DataFrame | None = None,
                   unit_id: str | None = None, edge_claims: DataFrame | None = None, edge_id: str | None = None, limit: int | None = None) -> Answer:
    """Q5: verified quotes with their posting. Asking for ids that have no quotes returns nothing; asking for none returns
    all verified quotes. quote_ids: (quote_id); evidence: (unit_id, quote_id); edge_claims: (edge_id, quote_id)."""
    asked = None
    for part in (quote_ids, evidence.filter(F.col("unit_id") == unit_id) if unit_id is not None else None,
                 edge_claims.filter(F.col("edge_id") == edge_id) if edge_id is not None else None):
        if part is not None:
            ids = part.select("quote_id")
            asked = ids if asked is None else asked.unionByName(ids)
    d = quotes.filter("verbatim_verified")
    if asked is not None:
        d = d.join(asked.distinct(), "quote_id", "left_semi")
    p = postings.select("posting_id", "role_title", "url", "site_id")
    return _answer(d.join(p, "posting_id", "left"), limit, F.col("quote_id"))


def query_postings(postings: DataFrame, extracts: DataFrame, account_id=None, site_id=None, job_family=None, seen_since=None,
                   names_tool=None, has_org_structure: bool | None = None, min_seniority=None, limit: int | None = None) -> Answer:
    """Q6: postings by score. The account matches itself or the mirror; a tool matches any part of a tool name."""
    ex = extracts.select("posting_id", "team_name", "parent_org", "tech_stack", F.lit(True).alias("has_extract"))
    d = _where(postings, site_id=site_id, job_family=job_family)
    if account_id is not None:
        d = d.filter((F.col("account_id") == account_id) | F.coalesce(F.col("mirror_account_id") == account_id, F.lit(False)))
    if seen_since is not None:
        d = d.filter(F.col("last_seen") >= F.lit(seen_since))
    if min_seniority is not None:
        d = d.filter(F.coalesce("seniority_rank", F.lit(1)) >= min_seniority)
    d = d.join(ex, "posting_id", "left").withColumn("has_extract", F.coalesce("has_extract", F.lit(False)))
    if has_org_structure is not None:
        d = d.filter(F.col("has_extract") == has_org_structure)
    if names_tool is not None:
        tools = F.coalesce("tech_stack", F.array().cast("array<string>"))
        d = d.filter(F.exists(tools, lambda t: F.contains(F.lower(t), F.lit(names_tool.lower()))))
    return _answer(d, limit, F.coalesce("tier2_score", F.lit(0)).desc(), F.col("posting_id"))


def get_hiring_mix(rollup: DataFrame, account_id, scope: str = "account_period_family") -> Answer:
    """Q7: rollup rows of an account and scope."""
    return _answer(rollup.filter((F.col("account_id") == account_id) & (F.col("scope") == scope)), None)


def list_gaps(units: DataFrame, coverage: DataFrame, account_id=None, limit: int | None = None) -> tuple[Answer, Answer]:
    """Q8: (units with gap flags, sites that are not covered)."""
    u = _where(units.filter(F.size("gap_flags") > 0), account_id=account_id)
    c = _where(coverage.filter(F.col("coverage_state") != "covered"), account_id=account_id)
    return _answer(u, limit, F.col("unit_id")), _answer(c, limit, F.col("site_id"))


def get_vocabulary(quotes: DataFrame, units: DataFrame, phrases: DataFrame, unit_postings: DataFrame | None = None, account_id=None, unit_id=None,
                   limit: int | None = None) -> Answer:
    """Q9: verified vocabulary quotes, then the phrases of the units. phrases: output of `unit_phrases`."""
    q = _where(quotes.filter("verbatim_verified AND claim_type = 'vocabulary'"), account_id=account_id)
    if unit_id is not None:
        q = q.join(unit_postings.filter(F.col("unit_id") == unit_id).select("posting_id").distinct(), "posting_id", "left_semi")
    u = _where(units, account_id=account_id, unit_id=unit_id).select("unit_id", "last_evidence_date")
    said = phrases.join(u, "unit_id").select(F.lit("").alias("quote_id"), F.lit("").alias("posting_id"), F.col("phrase").alias("quote_text"),
                                             F.col("last_evidence_date").cast("string").alias("display_date"))
    both = q.select("quote_id", "posting_id", "quote_text", F.col("display_date").cast("string").alias("display_date")).unionByName(said)
    return _answer(both, limit, (F.col("quote_id") == "").asc(), F.col("quote_id"), F.col("quote_text"))


def filter_corpus(index: DataFrame, site=None, family=None, since=None, tool=None, has_org: bool = False, limit: int | None = None) -> Answer:
    """Q10: the exported corpus filtered by site, family, window, tool substring and org structure; best scores first."""
    d = _where(index, site=site, family=family)
    if since is not None:
        d = d.filter(F.col("last_seen") >= F.lit(since))
    if has_org:
        d = d.filter("has_extract")
    if tool is not None:
        d = d.filter(F.contains(F.lower(F.coalesce("tech", F.lit(""))), F.lit(tool.lower())))
    return _answer(d, limit, F.col("score").desc(), F.col("posting_id"))
