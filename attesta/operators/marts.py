"""Gold tables for reading: sites, accounts, signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.gates import pipeline_group
from attesta.functions.text import head_text
from attesta.operators.skew import rank_within, top_per_group


def map_verdict() -> Column:
    """The manual verdict when there is one, else the automatic one, upper case."""
    manual = F.coalesce("verdict_manual", F.lit(""))
    return F.upper(F.coalesce(F.when(manual != "", manual), F.col("verdict_auto"), F.lit("")))


def verdict_rank(c) -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in cfg.VERDICT_RANK.items() for x in kv])
    return F.coalesce(F.try_element_at(ranks, c), F.lit(4))


def shown_fit(verdict: str, tag: str) -> Column:
    """struct(verdict, tag): REVIEW shows no tag, nor does a question or a repeat of the verdict."""
    v, t = F.upper(F.col(verdict)), F.coalesce(tag, F.lit(""))
    hide = (v == "REVIEW") | t.endswith("?") | (F.lower(t) == F.lower(v))
    return F.struct(v.alias("verdict"), F.when(~hide & (t != ""), t).alias("tag"))


def hiring_text(labels=None) -> Column:
    """Named-family counts only; other, unsure and excluded rows are never shown as a function."""
    parts = [F.when(F.coalesce(f"n_{key}", F.lit(0)) > 0, F.concat(F.lit(name + " "), F.col(f"n_{key}").cast("string")))
             for key, name in (labels or cfg.HIRING_LABELS)]
    return F.array_join(F.array_compact(F.array(*parts)), " · ")


def site_mart(sites: DataFrame, fit: DataFrame, final: DataFrame, profile: DataFrame, hiring: DataFrame, news: DataFrame,
              heads: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row per site, in display order (verdict, indexed postings, city).

    The final verdict wins over the raw reading. Only decisive chips show. Hiring shows only at sites that make or develop
    product, because postings reach a site by city. Every layer holds one row per site, so the joins do not multiply;
    heads: (site_head_id, site_id, found).
    """
    f = fit.select("site_id", F.col("verdict").alias("_mv"), F.col("reason_tag").alias("_mt"))
    n = final.select("site_id", F.col("verdict").alias("_fv"), F.col("reason").alias("_ft"))
    p = profile.select("site_id", "function_chips", "modality_chips")
    h = hiring.select("site_id", hiring_text().alias("_hiring"))
    w = news.select("site_id", "latest_date", "latest_trigger", "latest_title", F.col("n_items").alias("n_news"))
    c = coverage.select("site_id", "n_indexed", "n_units", "coverage_state")
    k = heads.filter("found").groupBy("site_id").agg(F.count_distinct("site_head_id").alias("n_heads"))
    d = sites.select("site_id", "account_id", "site", "city", map_verdict().alias("map_verdict"), head_text("named_site_head").alias("head"))
    for side in (f, n, p, h, w, c, k):
        d = d.join(side, "site_id", "left")
    d = d.withColumn("_v", F.coalesce("_fv", "_mv")).withColumn("_s", F.when(
        F.col("_fv").isNotNull(), shown_fit("_fv", "_ft")).when(F.col("_mv").isNotNull(), shown_fit("_mv", "_mt")))
    makes = (F.col("_v") == "KEEP") | ((F.col("_v") == "FLAG") & F.col("_mt").isin("small-mol", "mixed", "non-core"))
    zero = lambda x: F.coalesce(x, F.lit(0)).alias(x)
    return d.select(
        "account_id", "site_id", "site", "city", "map_verdict", F.col("_s.verdict").alias("fit_verdict"), F.col("_s.tag").alias("fit_tag"),
        "head", zero("n_heads"), "function_chips", "modality_chips", F.when(makes, F.col("_hiring")).alias("hiring"),
        "latest_date", "latest_trigger", "latest_title", zero("n_news"), zero("n_indexed"), zero("n_units"), "coverage_state",
        verdict_rank(F.col("map_verdict")).alias("verdict_rank")).orderBy(
            "account_id", "verdict_rank", F.col("n_indexed").desc(), "city", "site_id")


def location_display(label: str = "location_label") -> Column:
    """Thin or missing evidence is not a finding, so it shows nothing."""
    return F.when(~F.col(label).rlike("^(no postings|no digital|thin)"), F.col(label))


def account_mart(accounts: DataFrame, sites: DataFrame, heads: DataFrame, signals: DataFrame, ranks: DataFrame, postings: DataFrame,
                 units: DataFrame, final: DataFrame, footprint: DataFrame, location: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row per active account of the universe, in display order (pipeline group, keep sites, units, company).

    Every count is aggregated per account before its join.
    """
    live = accounts.filter("active AND in_universe")
    count = lambda df, **named: df.groupBy("account_id").agg(*[c.alias(n) for n, c in named.items()])
    one = F.count(F.lit(1))
    pubs = signals.filter(F.col("signal_type") == "publication")
    sides = [
        count(sites, n_sites=one, n_keep=F.count_if(map_verdict() == "KEEP"), n_named=F.count(head_text("named_site_head"))),
        count(heads.filter("found"), n_linked=F.count_distinct("site_head_id")), count(pubs, n_publications=one),
        count(ranks.filter("keep"), n_publications_kept=one), count(postings, n_postings=one),
        count(units.filter(F.col("unit_kind") == "observed"), n_units=one),
        count(final, n_fit_keep=F.count_if(F.col("verdict") == "KEEP"), n_review=F.count_if(F.col("verdict") == "REVIEW")),
        count(coverage, n_covered=F.count_if(F.col("coverage_state") == "covered"))]
    d = live.select("account_id", "company", F.col("pipeline_status"), pipeline_group("pipeline_status").alias("_g"))
    for side in sides:
        d = d.join(side, "account_id", "left")
    d = d.na.fill(0)
    mods = footprint.filter(F.col("kind") == "mod").select("account_id", "footprint")
    loc = location.select("account_id", location_display().alias("location_label"))
    d = d.join(mods, "account_id", "left").join(loc, "account_id", "left")
    return (d.withColumn("group_rank", F.col("_g.rank")).withColumn("group_name", F.col("_g.name")).drop("_g")
            .orderBy("group_rank", F.col("n_keep").desc(), F.col("n_units").desc(), "company"))


def signal_mart(signals: DataFrame, ranks: DataFrame, per_kind: int | None = None, kinds=None) -> DataFrame:
    """Signals in display order. Kinds come in a fixed order, each whole or with its first `per_kind`; publications are all
    listed, kept ones by rank, unscored ones next, those below the bar last and marked.

    ranks: (signal_id, keep, rank_in_account). Signals need seq, their order on file.
    """
    kinds = list(kinds or cfg.SIGNAL_KINDS)
    order = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("signal_type"))
    s = signals.withColumn("kind_order", order.cast("int")).filter(F.col("kind_order") > 0)
    pubs = s.filter(F.col("signal_type") == "publication").join(ranks.select("signal_id", "keep", "rank_in_account"), "signal_id", "left")
    tier = F.when(F.col("keep").isNull(), 1).when(F.col("keep"), 0).otherwise(2)
    place = ["tier", F.coalesce("rank_in_account", F.lit(1 << 60)), "seq"]
    pubs = rank_within(pubs.withColumn("tier", tier), ["account_id"], place, "position")
    rest, by = s.filter(F.col("signal_type") != "publication"), ["account_id", "signal_type"]
    others = top_per_group(rest, by, [F.col("seq").asc()], per_kind, "position") if per_kind else rank_within(rest, by, ["seq"], "position")
    cols = ["account_id", "kind_order", "signal_type", "position", "signal_id", "title"]
    return (pubs.select(*cols, (F.col("tier") == 2).alias("below_bar"))
            .unionByName(others.select(*cols, F.lit(False).alias("below_bar"))))
