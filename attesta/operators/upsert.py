"""Accreting state: windows that only widen, tiers that never fall, edits that touch only known keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.dates import quarter
from attesta.functions.gates import pipeline_priority, tier_rank
from attesta.functions.ids import posting_id, role_head_id, target_id
from attesta.functions.places import city_proper
from attesta.functions.text import ckey, nname, unescape
from attesta.operators.parse import names_in
from attesta.operators.resolve import mirror, resolve
from attesta.operators.rules import admit, classify, score
from attesta.operators.skew import first_per_group, top_per_group


def per_run(sightings: DataFrame, key, run: str = "run_id", ts: str = "seen_at") -> DataFrame:
    """(key, run, first_seen, last_seen): the sightings of each key in each run. The durable form of U1: unions of such logs, in any order and with
    repeats, reduce to the same log.
    """
    return sightings.groupBy(*key, run).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def _from_log(log: DataFrame, key, run: str) -> DataFrame:
    """The accreted state of a log with one row per (key, run)."""
    d = log.groupBy(*key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
                              F.count(F.lit(1)).alias("seen_count"), F.max(run).alias("last_run_id"))
    return d.withColumn("period_first", quarter("first_seen")).withColumn("period_last", quarter("last_seen"))


def accrete(sightings: DataFrame, key, run: str = "run_id", ts: str = "seen_at") -> DataFrame:
    """U1 over all sightings: first_seen = min, last_seen = max, seen_count = distinct runs, with their quarters.

    Partial aggregation runs before each shuffle, so a key with a third of all sightings is one row per run and partition.
    """
    key = [key] if isinstance(key, str) else list(key)
    return _from_log(per_run(sightings, key, run, ts), key, run)


def accrete_into(state: DataFrame, log: DataFrame, sightings: DataFrame, key, run: str = "run_id", ts: str = "seen_at") -> tuple[DataFrame, DataFrame]:
    """U1 incremental: (state, additions to the log). Only keys that were sighted again are accreted anew, from their rows of the log.

    log: `per_run` rows of everything that `state` holds, appended to, never rewritten; a replay of any old run, late sightings of one, or
    a file read twice leaves the counts as they are.
    """
    key = [key] if isinstance(key, str) else list(key)
    new = per_run(sightings, key, run, ts)
    touched = new.select(*key).distinct()
    both = log.join(touched, key, "left_semi").select(*new.columns).unionByName(new)
    merged = both.groupBy(*key, run).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return state.join(touched, key, "left_anti").unionByName(_from_log(merged, key, run).select(*state.columns)), new


def fold_duplicates(df: DataFrame) -> DataFrame:
    """Adds posting_id. A row without a request id takes the id of the request with the same account, city and role
    when there is one (lowest id), else its own hash id."""
    own = posting_id("account_id", "req_id", "city_slug", "role_slug")
    d = df.withColumn("_own", own)
    role = ["account_id", "city_slug", "role_slug"]
    canon = d.filter(F.coalesce("req_id", F.lit("")) != "").groupBy(*role).agg(F.min("_own").alias("_canon"))
    pid = F.when(F.coalesce("req_id", F.lit("")) != "", F.col("_own")).otherwise(F.coalesce("_canon", "_own"))
    return d.join(canon, role, "left").select(*df.columns, pid.alias("posting_id"))


def tier_upsert(state: DataFrame, new: DataFrame, key, tier: str = "extraction_tier", seq: str = "run_seq") -> DataFrame:
    """Per key the row of the highest tier, the later run on equal tiers; a cheaper row never replaces a richer one."""
    key = [key] if isinstance(key, str) else list(key)
    whole = F.struct(*[c for c in state.columns if c not in key])
    both = state.unionByName(new)
    best = both.groupBy(*key).agg(F.max_by(whole, F.struct(tier_rank(tier), F.col(seq))).alias("_row"))
    return best.select(*key, "_row.*").select(*state.columns)


def fill_empty(df: DataFrame, new: DataFrame, key: str, cols, only_empty=(), append=()) -> DataFrame:
    """U8: a present new value replaces the old one; `only_empty` columns change only when the old one is empty; `append`
    columns get the new text after a semicolon."""
    names = [*cols, *only_empty, *append]
    n = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in names])
    d = df.join(n, key, "left")
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    for c in names:
        old, got = F.col(c), F.col(f"_n_{c}")
        if c in only_empty:
            value = F.when(empty(old) & ~empty(got), got).otherwise(old)
        elif c in append:
            value = F.when(empty(got), old).when(empty(old), got).otherwise(F.concat(old, F.lit("; "), got))
        else:
            value = F.when(empty(got), old).otherwise(got)
        d = d.withColumn(c, value)
    return d.select(*df.columns)


def patch(df: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Per-row field updates by key; null leaves a field alone, an unknown key is ignored."""
    cols = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_u_{c}") for c in cols])
    return df.join(u, key, "left").select(*[F.coalesce(f"_u_{c}", c).alias(c) if c in cols else F.col(c) for c in df.columns])


def upsert_hosts(state: DataFrame, new: DataFrame) -> DataFrame:
    """API hosts join the source registry. An account with a working archive host keeps it and gains the API host
    beside it; any other account takes the API host as its source."""
    n = new.select("account_id", F.col("host").alias("_h"), F.col("tenant_site").alias("_t"), F.col("note").alias("_n"),
                   F.col("n_postings").cast("string").alias("_c"))
    d = state.join(n, "account_id", "full_outer")
    keep = (F.col("probe_status") == "ok") & ~F.coalesce("pattern_kind", F.lit("")).isin("", "workday_api")
    take = F.col("_h").isNotNull() & ~F.coalesce(keep, F.lit(False))
    noted = F.contains(F.coalesce("notes", F.lit("")), F.col("_n"))
    notes = (F.when(F.col("_h").isNull() | (keep & noted), F.col("notes"))
             .when(take | (F.coalesce("notes", F.lit("")) == ""), F.col("_n")).otherwise(F.concat_ws(" | ", "notes", "_n")))
    out = {"careers_host": F.when(take, F.col("_h")).otherwise(F.col("careers_host")),
           "pattern_kind": F.when(take, "workday_api").otherwise(F.col("pattern_kind")),
           "req_urls_found": F.when(take, F.col("_c")).otherwise(F.col("req_urls_found").cast("string")),
           "probe_status": F.when(take, "ok").otherwise(F.col("probe_status")),
           "workday_host": F.coalesce("_h", "workday_host"), "workday_site": F.coalesce("_t", "workday_site"), "notes": notes}
    return d.select(*[out.get(c, F.col(c)).alias(c) for c in state.columns])


DERIVED = ["site_id", "site_resolution", "n_site_candidates", "mirror_account_id", "mirror_site_id", "mirror_basis", "icp_fit",
           "job_family", "job_family_rule", "seniority_rank", "seniority_rule", "excluded", "tier2_admit", "tier2_score"]


def rescore(postings: DataFrame, index: DataFrame, sites: DataFrame, as_of, overrides: DataFrame | None = None,
            subsidiaries: DataFrame | None = None, families=None) -> DataFrame:
    """Every derived column again from the durable city_slug and role_slug. Site ids are not durable, so they are
    resolved on every run."""
    d = postings.drop(*[c for c in DERIVED if c in postings.columns])
    d = resolve(d, index, overrides, key="city_slug")
    if subsidiaries is not None:
        d = mirror(d, index, subsidiaries, key="city_slug")
    fit = sites.select("site_id", "icp_fit")
    d = d.join(fit, "site_id", "left").withColumn("icp_fit", F.coalesce("icp_fit", F.lit("unknown")))
    d = classify(d, families=families)
    return d.withColumn("tier2_admit", admit()).withColumn("tier2_score", score(as_of))


def site_targets(sites: DataFrame, verdicts: DataFrame, cap: int = cfg.SITE_QUERY_CAP, order: str = "site_id") -> DataFrame:
    """(account_id, rank, city_key, city, site_id): KEEP sites before FLAG sites, at most `cap` distinct cities per
    account. Later sites of a picked city join it, after the cap too; manually dropped and closed sites are out.

    verdicts: (site_id, verdict, closed).
    """
    d = sites.join(verdicts, "site_id").withColumn("city", city_proper("city")).withColumn("city_key", ckey("city"))
    manual = F.lower(F.coalesce("verdict_manual", F.lit(""))) == "drop"
    d = d.filter(F.col("verdict").isin("KEEP", "FLAG") & ~manual & ~F.coalesce("closed", F.lit(False)) & F.col("city").isNotNull())
    at = F.struct((F.col("verdict") == "FLAG").cast("int").alias("late"), F.col(order).alias("o"))
    keys = d.groupBy("account_id", "city_key").agg(F.min(at).alias("_at"), F.min_by("city", at).alias("_city"))
    picks = top_per_group(keys, ["account_id"], [F.col("_at").asc()], cap, "rank")
    return d.join(picks, ["account_id", "city_key"]).select("account_id", "rank", "city_key", F.col("_city").alias("city"), "site_id")


def people_targets(sites: DataFrame, accounts: DataFrame, order: str = "site_id") -> tuple[DataFrame, DataFrame]:
    """(targets, links). Distinct people named on KEEP sites of active accounts in the universe, with the lookup
    priority of the account; links: (target_id, site_id)."""
    live = accounts.filter("active AND in_universe").select("account_id", "company", "pipeline_status")
    keep = F.coalesce(F.when(F.col("verdict_manual") != "", F.col("verdict_manual")), "verdict_auto") == "KEEP"
    named = names_in(sites.filter(keep).join(live, "account_id"), "named_site_head").filter(nname("name") != "")
    d = named.withColumn("_n", nname("name")).withColumn("target_id", target_id("account_id", "name"))
    first = F.struct(F.col(order), "title_hint")
    targets = d.groupBy("account_id", "_n").agg(
        F.min("target_id").alias("target_id"), F.min("company").alias("company"), F.min("pipeline_status").alias("pipeline_status"),
        F.min_by("name", first).alias("name"), F.min_by("title_hint", first).alias("title_hint"),
        F.min_by("site_id", first).alias("first_site_id"), F.count_distinct("site_id").alias("n_sites"))
    targets = targets.drop("_n").withColumn("priority", pipeline_priority("pipeline_status"))
    return targets, d.select("target_id", "site_id").distinct()


def fold_people(targets: DataFrame, links: DataFrame, found: DataFrame) -> DataFrame:
    """One row per (target, site): the lookup result of a named head on every site that names the person. A person who
    was not found stays, with found = false."""
    looked = first_per_group(found, ["target_id"], [F.col("batch").desc()])
    cols = [c for c in looked.columns if c not in ("target_id", "batch", "name")]
    d = targets.select("target_id", "account_id", "name", "title_hint").join(
        looked.select("target_id", *[unescape(c).alias(c) if dict(looked.dtypes)[c] == "string" else F.col(c) for c in cols]), "target_id")
    return d.join(links, "target_id").withColumnRenamed("target_id", "site_head_id")


def fold_roles(state: DataFrame, searches: DataFrame) -> DataFrame:
    """Chosen candidates of role searches join the site heads, a later search replacing the same id.

    searches: (site_id, account_id, query, ran_at, candidates array<struct>); state: (site_head_id, account_id, site_id, name,
    title, email, source, checked_at).
    """
    rows = searches.select("site_id", "account_id", "ran_at", F.explode("candidates").alias("c")).filter("c.chosen")
    new = rows.select(role_head_id("site_id", "c.name").alias("site_head_id"), "account_id", "site_id",
                      unescape("c.name").alias("name"), unescape("c.title").alias("title"), F.trim("c.email").alias("email"),
                      F.lit("role_search").alias("source"), F.substring("ran_at", 1, 10).alias("checked_at"))
    both = state.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return first_per_group(both, ["site_head_id"], [F.col("_new").desc(), F.col("checked_at").desc(), F.col("email").desc()]).drop("_new")


def drop_stale(layers: dict[str, tuple[DataFrame, list[str]]], sites: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """(layers without stale sites, stale site ids). A derived row is stale when its site id, account and any further
    listed column no longer match the spine; a site stale in one layer leaves all of them."""
    stale = None
    for df, cols in layers.values():
        spine = sites.select("site_id", *cols)
        bad = df.select("site_id", *cols).join(spine, ["site_id", *cols], "left_anti").select("site_id")
        stale = bad if stale is None else stale.unionByName(bad)
    stale = stale.distinct()
    return {name: df.join(stale, "site_id", "left_anti") for name, (df, _) in layers.items()}, stale
