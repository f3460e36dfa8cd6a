"""Entity resolution: tiered, unambiguous, never guessing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.places import city_keys, city_place, metro_keys
from attesta.functions.text import ckey, norm, title_key
from attesta.operators.skew import first_per_group

TIER_NAMES = {1: "exact_city", 2: "alias", 3: "metro"}


def build_site_index(sites: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """(account_id, tier, key, site_id), tier 1 city, 2 alias, 3 metro.

    synonyms (synonym, target): a synonym joins the alias tier of every site whose city is its target, unless
    the synonym is itself a city key of the account.
    """
    keyed = sites.select("account_id", "site_id", city_keys("city").alias("_c"), metro_keys("metro").alias("_m"))
    tier = lambda n, keys: keyed.select("account_id", F.lit(n).alias("tier"), F.explode(keys).alias("key"), "site_id")
    city = tier(1, F.col("_c.primary"))
    index = city.unionByName(tier(2, F.col("_c.alias"))).unionByName(tier(3, F.col("_m")))
    if synonyms is not None:
        named = city.select("account_id", F.col("key").alias("synonym"))
        more = (city.join(synonyms, F.col("key") == F.col("target"))
                .select("account_id", "synonym", "site_id").distinct()
                .join(named, ["account_id", "synonym"], "left_anti"))
        index = index.unionByName(more.select("account_id", F.lit(2).alias("tier"), F.col("synonym").alias("key"), "site_id"))
    return index.distinct()


def best_tier(index: DataFrame) -> DataFrame:
    """One row per (account_id, key): the best tier with a hit, the number of its sites and the lowest of them."""
    per = index.groupBy("account_id", "key", "tier").agg(F.count_distinct("site_id").alias("n"), F.min("site_id").alias("site"))
    return per.groupBy("account_id", "key").agg(F.min("tier").alias("tier"), F.min_by("n", "tier").alias("n"), F.min_by("site", "tier").alias("site"))


def site_candidates(index: DataFrame) -> DataFrame:
    """(account_id, key, site_id): every site of the best tier of a place key; what an `ambiguous` row stands between."""
    best = best_tier(index).select("account_id", "key", "tier")
    return index.join(best, ["account_id", "key", "tier"]).select("account_id", "key", "site_id").distinct()


def resolve(df: DataFrame, index: DataFrame, overrides: DataFrame | None = None, account: str = "account_id",
            key: str = "city_key") -> DataFrame:
    """Adds site_id, site_resolution, n_site_candidates.

    A human pick wins; else the best tier with any hit: one candidate resolves, more are `ambiguous`; no hit is `city_not_in_sites`; an empty key is
    `unmatched`. The candidates themselves stay in `site_candidates`, by place key, as a metro may have any number. The index is reduced to one row
    per (account, key) first, so the join never multiplies postings.
    """
    k = F.coalesce(F.col(f"d.{key}"), F.lit(""))
    hits = best_tier(index).alias("h")
    d = df.alias("d").join(hits, (F.col(f"d.{account}") == F.col("h.account_id")) & (k == F.col("h.key")), "left")
    if overrides is not None:
        picks = overrides.select(F.col("account_id").alias("_pa"), F.col("city_key").alias("_pk"), F.col("site_id").alias("_pick"))
        d = d.join(picks, (F.col(f"d.{account}") == F.col("_pa")) & (k == F.col("_pk")), "left")
        pick = F.when(k != "", F.col("_pick"))
    else:
        pick = F.lit(None).cast("string")
    n = F.coalesce("h.n", F.lit(0))
    name = F.lit(None).cast("string")
    for t, label in TIER_NAMES.items():
        name = F.when(F.col("h.tier") == t, label).otherwise(name)
    site = F.coalesce(pick, F.when(n == 1, F.col("h.site")))
    outcome = (F.when(k == "", "unmatched").when(pick.isNotNull(), "human").when(n == 0, "city_not_in_sites")
               .when(n > 1, "ambiguous").otherwise(name))
    shown = F.when(pick.isNotNull(), 1).when(k != "", n).otherwise(0).cast("long")
    return d.select("d.*", F.when(k != "", site).alias("site_id"), outcome.alias("site_resolution"),
                    shown.alias("n_site_candidates"))


def mirror(df: DataFrame, index: DataFrame, subsidiaries: DataFrame, account: str = "account_id",
           key: str = "city_key", row: str = "posting_id") -> DataFrame:
    """Adds mirror_account_id, mirror_site_id, mirror_basis; rows are not duplicated.

    A subsidiary hit must be an exact or alias site; the first subsidiary in list order wins. The answer only
    depends on (account, key), so it is computed once per distinct pair and joined back.
    subsidiaries: (parent, child, ord).
    """
    pairs = df.select(F.col(account).alias("_a"), F.coalesce(F.col(key), F.lit("")).alias("_k")).distinct()
    strong = ["exact_city", "alias"]
    own = resolve(pairs, index, None, "_a", "_k").select("_a", "_k", F.col("site_resolution").isin(strong).alias("_own"))
    subs = pairs.join(subsidiaries, F.col("_a") == F.col("parent"))
    found = resolve(subs, index, None, "child", "_k").filter(F.col("site_resolution").isin(strong))
    best = first_per_group(found, ["_a", "_k"], [F.col("ord").asc()]).join(own, ["_a", "_k"])
    dim = best.select("_a", "_k", F.col("child").alias("mirror_account_id"), F.col("site_id").alias("mirror_site_id"),
                      F.when(F.col("_own"), "dual_registered").otherwise("subsidiary_only").alias("mirror_basis"))
    on = (F.col(account) == F.col("_a")) & (F.coalesce(F.col(key), F.lit("")) == F.col("_k"))
    return df.join(dim, on, "left").drop("_a", "_k")


def unmatched(df: DataFrame, synonyms: DataFrame | None = None, non_places=None) -> DataFrame:
    """Unresolved, non-ambiguous rows per (account, raw city) with counts, dates and a verdict.

    no_place: names no place; needs_alias: a known synonym of a place; missing_site: a real gap in the spine.
    """
    open_rows = df.filter(F.col("site_id").isNull() & (F.col("site_resolution") != "ambiguous"))
    out = open_rows.groupBy("account_id", F.trim(F.coalesce("city_raw", F.lit(""))).alias("city_raw")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("tier2_admit").alias("n_admitted"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    out = out.withColumn("key", ckey(F.split_part("city_raw", F.lit(","), F.lit(1))))
    known = F.lit(False)
    if synonyms is not None:
        names = synonyms.select(F.col("synonym").alias("key")).distinct().withColumn("_known", F.lit(True))
        out = out.join(names, "key", "left")
        known = F.coalesce("_known", F.lit(False))
    places = non_places if non_places is not None else cfg.NON_PLACES
    verdict = F.when(F.col("key").isin(places), "no_place").when(known, "needs_alias").otherwise("missing_site")
    return out.select("account_id", "city_raw", "key", "n", "n_admitted", "first_seen", "last_seen", verdict.alias("verdict"))


def _bare(c) -> Column:
    return norm(F.regexp_replace(c, r"\(.*?\)", ""))


def canonicalize(df: DataFrame, aliases: DataFrame, canon: DataFrame, col: str = "account_raw",
                 out: str = "company") -> DataFrame:
    """E5: alias, then exact name, then both without parentheticals, then without corporate suffixes, else as is.

    aliases (alias, company); canon (company). All keys go into one lookup with a priority, and names are
    resolved once per distinct spelling.
    """
    plain = lambda c: F.trim(F.regexp_replace(c, cfg.CORPORATE_SUFFIXES, ""))
    entry = lambda src, key, rank: src.select(F.lit(rank).alias("form"), key.alias("key"), F.col("company").alias("hit"))
    by_alias = entry(aliases, F.col("alias"), 1)
    by_name = entry(canon, norm("company"), 2)
    by_base = entry(canon, plain(norm("company")), 5).filter(F.col("key") != "")
    again = by_alias.withColumn("form", F.lit(3)).unionByName(by_name.withColumn("form", F.lit(4)))
    lookup = by_alias.unionByName(by_name).unionByName(again).unionByName(by_base).groupBy("form", "key").agg(F.min("hit").alias("hit"))
    names = df.select(F.col(col).alias("_raw")).distinct()
    raw, bare = norm("_raw"), _bare(F.col("_raw"))
    forms = F.array(*[F.struct(F.lit(i).alias("form"), k.alias("key")) for i, k in
                      ((1, raw), (2, raw), (3, bare), (4, bare), (5, plain(bare)))])
    tried = names.select("_raw", F.inline(forms)).join(lookup, ["form", "key"])
    best = tried.groupBy("_raw").agg(F.min_by("hit", "form").alias("_hit"))
    return (df.join(best, F.col(col) == F.col("_raw"), "left")
            .withColumn(out, F.coalesce("_hit", F.trim(col))).drop("_raw", "_hit"))


def site_keys(sites: DataFrame) -> DataFrame:
    """(account_id, key, site_id) over primary and alias city keys."""
    c = city_keys("city")
    return sites.select("account_id", "site_id", F.explode(F.array_union(c["primary"], c["alias"])).alias("key")).distinct()


def title_site(df: DataFrame, keys: DataFrame, id: str = "posting_id", title: str = "role_title", runs: int = 4) -> DataFrame:
    """(id, title_site_id) where 1..runs-word runs of the title name exactly one of the account's sites."""
    distinct = df.select("account_id", title_key(title).alias("_t")).distinct()
    words = F.split("_t", " ")
    run = lambda n: F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), ""))
    grams = F.flatten(F.array(*[F.when(F.size(words) >= n, run(n)).otherwise(F.array().cast("array<string>"))
                                for n in range(1, runs + 1)]))
    hits = (distinct.withColumn("key", F.explode(F.array_distinct(grams))).join(keys, ["account_id", "key"])
            .groupBy("account_id", "_t").agg(F.count_distinct("site_id").alias("_n"), F.min("site_id").alias("title_site_id"))
            .filter(F.col("_n") == 1).drop("_n"))
    return df.select(id, "account_id", title_key(title).alias("_t")).join(hits, ["account_id", "_t"]).select(id, "title_site_id")


def location(df: DataFrame, sites: DataFrame, id: str = "posting_id") -> DataFrame:
    """Adds loc_kind, loc_id, loc_source: the resolved site, else city, else remote, else a site named in the title.

    The title only speaks where the URL carried no city at all.
    """
    place = city_place("city_raw")
    blank = F.coalesce(F.col("city_slug"), F.lit("")) == ""
    d = df.withColumn("_place", place)
    silent = d.filter(F.col("site_id").isNull() & F.col("_place").isNull() & blank)
    d = d.join(title_site(silent, site_keys(sites), id), id, "left")
    s, p, t = F.col("site_id"), F.col("_place"), F.col("title_site_id")
    kind = (F.when(s.isNotNull(), "site").when(p == "remote", "remote").when(p.isNotNull(), "city")
            .when(t.isNotNull(), "site").otherwise("none"))
    ident = (F.when(s.isNotNull(), s).when(p == "remote", p).when(p.isNotNull(), F.concat(F.lit("city:"), p))
             .otherwise(F.coalesce(t, F.lit(""))))
    source = F.when(s.isNotNull() | p.isNotNull(), "url").when(t.isNotNull(), "title").otherwise("")
    return d.select(*df.columns, kind.alias("loc_kind"), ident.alias("loc_id"), source.alias("loc_source"))


def enrich(df: DataFrame, dim: DataFrame, on, order) -> DataFrame:
    """Keyed left join that never multiplies rows: of a key that the dimension holds more than once the first row by `order` counts."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(first_per_group(dim, on, order), on, "left")
