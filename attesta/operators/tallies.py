"""Hiring, location, title, publication and news rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.text import title_key
from attesta.operators.skew import first_per_group, modal, rank_within, top_per_group
from attesta.session import cut

BUCKETS = cfg.FAMILY_NAMES + ["other", "unsure", "excluded", "not_labeled"]


def hiring_tally(df: DataFrame, by: str, buckets=None, window: int = cfg.HIRING_WINDOW_DAYS, newest: Column | None = None) -> DataFrame:
    """A3: counts per family bucket, of digital and bioprocess rows, of the last `window` days before the newest row of the
    whole corpus, and per label source. Rows without the grouping key are out.

    df: output of `resolve_label` with last_seen (date). One grouped pass with conditional counts. newest: the newest date, where the caller has
    it from a plainer table; else the columns that count are materialised once, and it is taken from them.
    """
    if newest is None:
        df = cut(df.select(by, "family", "is_digital", "is_bioprocess", "last_seen", "label_source"))
        newest = df.agg(F.max("last_seen")).scalar()
    cutoff = F.date_sub(newest, window)
    recent = F.coalesce(F.col("last_seen") >= cutoff, F.lit(False))
    named = F.col("family").isin(cfg.FAMILY_NAMES if buckets is None else buckets)
    count = F.count_if
    aggs = [F.count(F.lit(1)).alias("postings")]
    aggs += [count(F.col("family") == b).alias(f"n_{b}") for b in (buckets or BUCKETS)]
    aggs += [count("is_digital").alias("n_digital_data_it"), count("is_bioprocess").alias("n_bioprocess_core"),
             count(recent).alias("n_recent"), count(F.col("is_digital") & recent).alias("n_digital_recent"),
             count(F.col("is_bioprocess") & recent).alias("n_bioprocess_recent"),
             F.max("last_seen").alias("newest_last_seen"),
             count((F.col("label_source") == "rule") & named).alias("family_from_rule"),
             count((F.col("label_source") == "model") & named).alias("family_from_model")]
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(*aggs).withColumn("window_from", cutoff)


def account_hiring(df: DataFrame, buckets=None, newest: Column | None = None) -> DataFrame:
    """A3 per account, with the distinct sites and the rows that mirror into it from another account."""
    tally = hiring_tally(df, "account_id", buckets, newest=newest)
    sites = df.groupBy("account_id").agg(F.count_distinct("site_id").alias("sites_with_postings"))
    mirrors = (df.filter(F.col("mirror_account_id").isNotNull()).groupBy(F.col("mirror_account_id").alias("account_id"))
               .agg(F.count(F.lit(1)).alias("mirror_postings")))
    return (tally.join(sites, "account_id").join(mirrors, "account_id", "left")
            .withColumn("mirror_postings", F.coalesce("mirror_postings", F.lit(0))))


def location_concentration(df: DataFrame, by: str, loc: str, min_n: int = cfg.LOCATION_MIN_N, top: float = cfg.LOCATION_TOP_SHARE,
                           cov: float = cfg.LOCATION_COVERAGE, kind: str = "loc_kind") -> DataFrame:
    """A4: where a group's rows sit. Thin below `min_n` located rows or below `cov` located; concentrated when the top
    location holds `top` of the located rows; else spread. `location_shares` lists the locations.

    Counted per (group, location) first; ranks run over locations, not rows.
    """
    placed = F.col(kind).isin("site", "city")
    base = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(placed).alias("n_located"),
                              F.count_if(F.col(kind) == "remote").alias("n_remote"),
                              F.count_if(F.col(kind) == "none").alias("n_no_location"))
    per = df.filter(placed).groupBy(by, loc, kind).agg(F.count(F.lit(1)).alias("n"))
    spread = per.groupBy(by).agg(F.count(F.lit(1)).alias("n_locations"), F.count_if(F.col(kind) == "site").alias("n_sites"),
                                 F.count_if(F.col(kind) == "city").alias("n_cities"))
    ranked = top_per_group(per, [by], [F.col("n").desc(), F.col(loc).asc()], 3, "rn")
    total = F.col("n_located")
    tops = ranked.groupBy(by).agg(
        F.max(F.when(F.col("rn") == 1, F.col(loc))).alias("top_id"), F.max(F.when(F.col("rn") == 1, F.col(kind))).alias("top_kind"),
        F.max(F.when(F.col("rn") == 1, F.col("n"))).alias("top_n"),
        F.sum("n").alias("_top3"))
    d = base.join(spread, by, "left").join(tops, by, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    for c in ("n_locations", "n_sites", "n_cities", "top_n"):
        d = d.withColumn(c, zero(c))
    d = (d.withColumn("top_share", F.coalesce(F.try_divide("top_n", "n_located"), F.lit(0.0)))
         .withColumn("top3_share", F.try_divide("_top3", "n_located")).drop("_top3"))
    thin = (total < min_n) | (total < cov * F.col("n_rows"))
    label = (F.when(thin, "thin evidence").when(F.col("top_share") >= top, F.concat(F.lit("concentrated at "), "top_id"))
             .otherwise(F.format_string("spread over %d locations", F.col("n_locations"))))
    gone = F.col("n_no_location") + F.col("n_remote")
    return d.withColumn("location_label", label).withColumn(
        "caveat", F.when(gone > 0, F.format_string("no location on %d of %d", gone, F.col("n_rows"))).otherwise(""))


def location_shares(df: DataFrame, by: str, loc: str, kind: str = "loc_kind", shown: int | None = None) -> DataFrame:
    """A4: (group, location, kind, n, share): every location of a group with its share of the located rows, or the `shown` largest."""
    per = df.filter(F.col(kind).isin("site", "city")).groupBy(by, loc, kind).agg(F.count(F.lit(1)).alias("n"))
    d = per.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by)))
    return top_per_group(d, [by], [F.col("n").desc(), F.col(loc).asc()], shown) if shown else d


def scope_shares(df: DataFrame, scope: DataFrame, by: str, min_n: int = cfg.LOCATION_MIN_N, title: str = "role_title") -> DataFrame:
    """A4: shares and means of the title scope answers over a group's rows; shown only from `min_n` rows."""
    s = scope.select(F.col("title_key").alias("_tk"), "global_scope_p", "global_scope_gated", "site_scope_p", "site_scope_gated")
    d = df.withColumn("_k", title_key(title)).join(s, F.col("_k") == F.col("_tk"), "left")
    yes = lambda q: F.count_if(F.col(f"{q}_gated") == "yes")
    out = d.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), yes("global_scope").alias("n_global_titled"),
        F.count_if(F.col("global_scope_gated") == "unsure").alias("n_global_unsure"), yes("site_scope").alias("n_site_titled"),
        F.avg("global_scope_p").alias("global_scope_p_mean"), F.avg("site_scope_p").alias("site_scope_p_mean"))
    return (out.withColumn("global_titled_share", F.col("n_global_titled") / F.col("n_rows"))
            .withColumn("site_titled_share", F.col("n_site_titled") / F.col("n_rows"))
            .withColumn("global_titled_display", F.when(F.col("n_rows") >= min_n, F.format_string(
                "%.0f%%", F.round(100 * F.col("global_titled_share"))))))


def account_profile(profile: DataFrame, labels=None) -> DataFrame:
    """Per account and label the number of sites that say yes and unsure, long form.

    profile: output of `site_profile` with account_id.
    """
    labels = labels or cfg.PROFILE_LABELS
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(key).alias("label"), F.lit(name).alias("name"),
                              F.col(f"{k}_{key}").alias("state")) for k, key, name in labels])
    return profile.select("account_id", F.inline(rows)).groupBy("account_id", "kind", "label", "name").agg(
        F.count_if(F.col("state") == "yes").alias("n_yes"), F.count_if(F.col("state") == "unsure").alias("n_unsure"))


def footprints(counts: DataFrame, n: str = "n_yes") -> DataFrame:
    """Per (account, kind) the `name:count` list of labels with a count, largest first. Bounded by the label set."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col(n)).alias("neg"), "name")))
    return counts.filter(F.col(n) > 0).groupBy("account_id", "kind").agg(F.array_join(F.transform(
        ordered, lambda s: F.concat(s["name"], F.lit(":"), (-s["neg"]).cast("string"))), "|").alias("footprint"))


def publication_rollup(df: DataFrame, bands=None) -> DataFrame:
    """A10: per account the counts of publications, kept ones, bands, process-data yes and low source confidence."""
    names = list(bands or cfg.RELEVANCE_BANDS) + ["unsure"]
    return df.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("keep").alias("kept"),
        *[F.count_if(F.col("relevance_band") == b).alias(f"band_{b}") for b in names],
        F.count_if(F.col("process_data") == "yes").alias("process_data_yes"),
        F.count_if(F.col("source_confidence") == "low").alias("source_low"),
        F.count_if((F.col("source_confidence") == "low") & ~F.col("keep")).alias("source_low_below_bar"))


def _kept_news(labels: DataFrame, by: str) -> tuple[DataFrame, list[Column]]:
    return labels.filter("keep").filter(F.col(by).isNotNull()), [F.col("published").desc(), F.col("item_id").asc()]


def newest_items(labels: DataFrame, by: str, top: int | None = None) -> DataFrame:
    """(group, rn, item_id, published, trigger, title, source, url): the kept items of each group, newest first, or the `top` newest."""
    kept, order = _kept_news(labels, by)
    d = top_per_group(kept, [by], order, top, "rn") if top else rank_within(kept, [by], [("published", "desc"), "item_id"], "rn")
    return d.select(by, F.col("rn").cast("long").alias("rn"), "item_id", "published", "trigger", "title", "source", "url")


def news_rollup(labels: DataFrame, by: str) -> DataFrame:
    """Per group the kept items, the fields of the latest one, and `trigger:count` pairs. The items are in `newest_items`."""
    kept, order = _kept_news(labels, by)
    newest = first_per_group(kept, [by], order).select(by, *[F.col(c).alias(f"latest_{o}") for c, o in (
        ("published", "date"), ("trigger", "trigger"), ("title", "title"), ("url", "url"), ("source", "source"))])
    per = kept.groupBy(by, "trigger").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "trigger")))
    counts = per.groupBy(by).agg(F.sum("n").alias("n_items"), F.array_join(F.transform(
        pairs, lambda s: F.concat(s["trigger"], F.lit(":"), (-s["neg"]).cast("string"))), "|").alias("triggers"))
    return counts.join(newest, by)


def title_groups(df: DataFrame, title: str = "role_title") -> DataFrame:
    """Per title key the rows, distinct accounts, modal spelling, modal account (lowest on ties) and modal family."""
    d = df.withColumn("title_key", title_key(title)).filter(F.col("title_key") != "").withColumn("_t", F.trim(title))
    base = d.groupBy("title_key").agg(F.count(F.lit(1)).alias("n_postings"), F.count_distinct("account_id").alias("n_accounts"))
    fam = modal(d.filter(F.col("job_family") != ""), ["title_key"], "job_family", "rule_family")
    return (base.join(modal(d, ["title_key"], "_t", "title"), "title_key")
            .join(modal(d, ["title_key"], "account_id", "modal_account"), "title_key").join(fam, "title_key", "left")
            .withColumn("rule_family", F.coalesce("rule_family", F.lit(""))))


def central_ledger(postings: DataFrame, extracts: DataFrame, sites: DataFrame, core=None) -> DataFrame:
    """Per account four counted observations on who owns the tooling, and a 0..4 meter from site to central."""
    d = postings.filter(F.col("job_family").isin(core or cfg.CORE_FAMILIES))
    d = (d.join(sites.select("site_id", F.lower(F.coalesce("functions", F.lit(""))).alias("_f")), "site_id", "left")
         .join(extracts.select("posting_id", "autonomy_flag"), "posting_id", "left"))
    hq = F.contains(F.col("_f"), F.lit("commercial")) | F.contains(F.col("_f"), F.lit("hq"))
    has = F.col("site_id").isNotNull()
    out = d.groupBy("account_id").agg(
        F.count_if(F.col("autonomy_flag") == "central_owned").alias("n_central"),
        F.count_if(F.col("autonomy_flag") == "site_autonomous").alias("n_local"),
        F.count_if(has & F.coalesce(hq, F.lit(False))).alias("n_hq_core"),
        F.count_if(has & ~F.coalesce(hq, F.lit(False))).alias("n_site_core"))
    total = F.col("n_central") + F.col("n_local") + F.col("n_hq_core") + F.col("n_site_core")
    return (out.withColumn("n_observations", total).filter(F.col("n_observations") > 0)
            .withColumn("meter", F.bround(4 * (F.col("n_central") + F.col("n_hq_core")) / F.col("n_observations")).cast("int")))


def census(df: DataFrame, by: str, blank: str = "needs_work", measures=()) -> DataFrame:
    """Rows per value of a probe column, blanks named, with medians of further columns."""
    key = F.when(F.coalesce(F.col(by), F.lit("")) == "", blank).otherwise(F.col(by))
    return df.groupBy(key.alias(by)).agg(F.count(F.lit(1)).alias("n"), *[F.median(m).alias(f"median_{m}") for m in measures])


def probe_verdict(n_jobs, n_structured):
    """What a careers site offers."""
    return (F.when((F.col(n_jobs) > 0) & (F.col(n_structured) > 0), "scrapeable_structured")
            .when(F.col(n_jobs) > 0, "scrapeable_unstructured").otherwise("no_html_listing"))


def best_host(parsed: DataFrame, account: str = "account_id", host: str = "host", glob: str = "glob", form: str = "url_form",
              req: str = "req_id") -> DataFrame:
    """Per account the (host, path glob) with most posting-shaped URLs and its modal shape; a date path counts as the
    shape it duplicates."""
    ok = (F.coalesce(F.col(req), F.lit("")) != "") | F.col(form).isin("slug_only", "phenom_datepath")
    shape = F.when(F.col(form) == "phenom_datepath", "phenom").otherwise(F.col(form))
    per = parsed.filter(ok).groupBy(account, host, glob, shape.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    both = per.groupBy(account, host, glob).agg(F.sum("n").alias("req_urls_found"), F.min(
        F.struct((-F.col("n")).alias("neg"), "kind"))["kind"].alias("pattern_kind"))
    best = both.groupBy(account).agg(F.min(F.struct((-F.col("req_urls_found")).alias("neg"), F.col(host).alias("host"),
                                                    F.col(glob).alias("glob"), "pattern_kind")).alias("_b"))
    return best.select(account, F.col("_b.host").alias("careers_host"), F.col("_b.glob").alias("req_path_glob"),
                       "_b.pattern_kind", (-F.col("_b.neg")).alias("req_urls_found"),
                       F.col("_b.pattern_kind").isin("phenom", "workday").alias("city_from_url"))


def corpus_stats(postings: DataFrame, facets=("site_resolution", "job_family", "extraction_tier", "mirror_basis"), top: int | None = None) -> DataFrame:
    """(facet, value, n): rows per value of each facet, or of the `top` largest per facet."""
    rows = F.array(*[F.struct(F.lit(f).alias("facet"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value")) for f in facets])
    n = postings.select(F.inline(rows)).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(n, ["facet"], [F.col("n").desc(), F.col("value").asc()], top) if top else n


def query_stats(queries: DataFrame, items: DataFrame) -> DataFrame:
    """Per account the queries run, those without an item, and the items kept."""
    q = queries.groupBy("account_id").agg(F.count(F.lit(1)).alias("n_queries"), F.count_if(F.col("items_in_window") == 0).alias("n_empty"))
    i = items.groupBy("account_id").agg(F.count(F.lit(1)).alias("n_items"), F.count_if(F.col("query_kind") == "site").alias("n_site_items"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return q.join(i, "account_id", "left").select("account_id", "n_queries", "n_empty", zero("n_items"), zero("n_site_items"))


def gate_stats(verified: DataFrame) -> DataFrame:
    """Quotes per match method with the overall pass rate and the quotes whose body is missing."""
    n = verified.groupBy("match_method").agg(F.count(F.lit(1)).alias("n"), F.count_if("verbatim_verified").alias("n_ok"),
                                             F.count_if(~F.col("has_body")).alias("n_no_body"))
    w = Window.partitionBy()
    return n.select("match_method", "n", (100.0 * F.sum("n_ok").over(w) / F.sum("n").over(w)).alias("pass_rate"),
                    F.sum("n_no_body").over(w).alias("n_no_body"))


def rank_publications(df: DataFrame, score: float = cfg.KEEP_SCORE, conf: float = cfg.KEEP_CONFIDENCE) -> DataFrame:
    """C20: adds keep and rank_in_account by keep, score, process-data probability, year; the signal id breaks ties."""
    d = df.withColumn("keep", (F.col("relevance_score") >= score) & (F.col("relevance_conf") >= conf))
    order = [("keep", "desc"), ("relevance_score", "desc"), ("process_data_p", "desc"), (F.coalesce("year", F.lit(0)), "desc"), "signal_id"]
    return rank_within(d, ["account_id"], order, "rank_in_account")
