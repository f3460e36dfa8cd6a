"""Dedupe and spine identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions.text import collapse, dkey, nname, norm, split_head
from attesta.operators.skew import first_per_group, rank_within


def dedupe_spine(df: DataFrame, row: str = "row_no") -> DataFrame:
    """One row per (account, site name without parentheticals, city).

    The first row wins unless it lacks a named head and a later one has it; `row_no` keeps the first position.
    Pre-aggregated per partition, so a group of copies never travels whole.
    """
    site = norm(F.regexp_replace("site", r"\(.*?\)", ""))
    headless = F.coalesce(F.trim("named_site_head"), F.lit("")) == ""
    whole = F.struct(*[F.col(c) for c in df.columns if c != row])
    out = df.groupBy(F.col("account_id").alias("_a"), site.alias("_s"), norm(F.coalesce("city", F.lit(""))).alias("_c")).agg(
        F.min_by(whole, F.struct(headless, F.col(row))).alias("_row"), F.min(row).alias(row))
    return out.select(F.col("_row.*"), row)


def ordinal_ids(df: DataFrame, by: str, order, fmt: str = "%s--s%02d", out: str = "site_id") -> DataFrame:
    """`{group}--s01`, `--s02`, … by position within the group."""
    ranked = rank_within(df, [by], order, "_ord")
    return ranked.withColumn(out, F.format_string(fmt, F.col(by), F.col("_ord"))).drop("_ord")


def add_missing_parents(accounts: DataFrame, sites: DataFrame) -> DataFrame:
    """Companies seen only in sites join the accounts with in_universe and active false."""
    extra = (sites.groupBy("account_id").agg(F.min("company").alias("company"))
             .join(accounts.select("account_id"), "account_id", "left_anti"))
    off = F.lit(False)
    cols = {"account_id": F.col("account_id"), "company": F.col("company"), "in_universe": off, "active": off, "exclude": off}
    return accounts.unionByName(extra.select(*[
        cols.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in accounts.schema]))


def people_from_heads(sites: DataFrame) -> DataFrame:
    """The named site heads as people rows."""
    return (sites.withColumn("_h", split_head("named_site_head")).filter(F.col("_h").isNotNull())
            .select("account_id", "site_id", F.col("_h.name").alias("name"), F.col("_h.title").alias("title")))


def dedupe_url(df: DataFrame, owner: Column, url: str = "url", row: str = "posting_id") -> DataFrame:
    """One row per url; a row whose account owns the host first, then the lowest row id."""
    return first_per_group(df, [url], [F.coalesce(owner, F.lit(False)).desc(), F.col(row).asc()])


def append_dedupe(state: DataFrame, new: DataFrame, key, order) -> DataFrame:
    """U4: rows of `new` with an unseen natural key join the state; the first of equal new keys stays."""
    fresh = first_per_group(new, key, order).join(state.select(*key).distinct(), key, "left_anti")
    return state.unionByName(fresh)


def quote_key() -> list[Column]:
    """The four-part natural key of a quote; the text as its hash."""
    return [F.col("posting_id"), F.col("claim_type"), F.col("subject_slug"), F.sha2("quote_text", 256).alias("quote_hash")]


def prefer_site_rows(df: DataFrame, kind: str = "query_kind", seq: str = "seq") -> DataFrame:
    """Per (account, item) the first row wins, except that a site row replaces an account row."""
    return first_per_group(df, ["account_id", "item_id"], [(F.col(kind) == "site").desc(), F.col(seq).asc()])


def append_signals(state: DataFrame, new: DataFrame, seq: str = "seq", prefix: str = "sig") -> DataFrame:
    """Signals with an unseen (account, type, title+url) key; ids are hashes of the key, so a rerun or a second writer gives the same."""
    keyed = lambda d: d.withColumn("_k", dkey("title", "url"))
    fresh = first_per_group(keyed(new.filter(F.coalesce(F.col("title"), F.lit("")) != "")),
                            ["account_id", "signal_type", "_k"], [F.col(seq).asc()])
    fresh = fresh.join(keyed(state).select("account_id", "signal_type", "_k").distinct(),
                       ["account_id", "signal_type", "_k"], "left_anti")
    return state.unionByName(fresh.withColumn("signal_id", _key_id(prefix, "account_id", "signal_type", "_k")).select(*state.columns))


def append_people(state: DataFrame, new: DataFrame, seq: str = "seq", prefix: str = "p") -> DataFrame:
    """People with an unseen (account, letters of the name) key."""
    keyed = lambda d: d.withColumn("_k", nname("name"))
    fresh = first_per_group(keyed(new.filter(F.coalesce(F.col("name"), F.lit("")) != "")), ["account_id", "_k"], [F.col(seq).asc()])
    fresh = fresh.join(keyed(state).select("account_id", "_k").distinct(), ["account_id", "_k"], "left_anti")
    return state.unionByName(fresh.withColumn("person_id", _key_id(prefix, "account_id", "_k")).select(*state.columns))


def _key_id(prefix: str, *key: str) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *key), 256), 1, 16))


def named_people(df: DataFrame, names: str, cap: int | None = None, seq: str = "seq") -> DataFrame:
    """One row per named person, or per first `cap` of each item."""
    rest = [c for c in df.columns if c not in (names, seq)]
    listed = df.select(*rest, F.col(seq), F.posexplode(F.slice(F.col(names), 1, cap) if cap else F.col(names)).alias("_pos", "name"))
    return listed.withColumn(seq, F.format_string("%s.%06d", F.col(seq).cast("string"), F.col("_pos"))).drop("_pos")


def roster(*sources: DataFrame) -> DataFrame:
    """Distinct person names with at least two tokens, longest first.

    sources: single-column frames of names.
    """
    one = [d.select(F.trim(F.col(d.columns[0])).alias("name")) for d in sources]
    names = one[0]
    for d in one[1:]:
        names = names.unionByName(d)
    return names.filter(F.size(F.split(collapse("name"), " ")) >= 2).distinct().orderBy(F.length("name").desc(), "name")
