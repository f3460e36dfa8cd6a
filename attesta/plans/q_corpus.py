"""Queries over the posting corpus: classification, resolution, accretion, share of mix."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.dates import in_window, quarter
from attesta.operators import dedupe, mix, parse, resolve, rules, tallies, upsert
from attesta.plans import derive as dv
from attesta.plans.base import query
from attesta.plans.derive import with_
from attesta.session import scratch
from attesta.sources import buckets, exports, feeds, spine

FACTS_SQL = """facts AS (SELECT n_name AS account_id, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period, o_orderpriority AS dim_key,
  o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
MIX_SQL = """cell AS (SELECT account_id, period, dim_key, count(*) AS n FROM facts GROUP BY ALL),
denoms AS (SELECT *, CAST(sum(n) OVER (PARTITION BY account_id, period) AS BIGINT) AS denom,
  sum(n) OVER (PARTITION BY account_id) AS alln, sum(n) OVER (PARTITION BY account_id, dim_key) AS fam FROM cell),
typical AS (SELECT account_id, median(d) AS md FROM (SELECT account_id, period, sum(n) AS d FROM cell GROUP BY ALL) GROUP BY 1),
peers AS (SELECT period, dim_key, median(n / denom) FILTER (denom >= 25) AS pm, count(*) FILTER (denom >= 25) AS pn FROM denoms GROUP BY ALL),
mix AS (SELECT account_id, period, dim_key, n, denom, n / denom AS share, fam / alln AS alltime, coalesce(pm, 0) AS pm, pn AS peer_n_accounts, md,
  CASE WHEN denom < 25 THEN 'low_n' WHEN md > 0 AND denom > 1.5 * md THEN 'crawl_burst' ELSE '' END AS bias_flag
  FROM denoms JOIN typical USING (account_id) JOIN peers USING (period, dim_key))"""


def facts(t):
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return d.select(F.col("n_name").alias("account"), quarter("o_orderdate").alias("period"), F.col("o_orderpriority").alias("family"))


def rounded(df, **places):
    return df.withColumns({c: F.round(F.col(c), p) for c, p in places.items()})


def rollup(t):
    return mix.share_of_mix(facts(t), "account", "period", "family", burst=1.5)


SHARE_SQL = with_(FACTS_SQL, MIX_SQL) + """SELECT account_id, period, dim_key, n, denom, round(share, 6) AS share,
  round(alltime, 6) AS account_alltime_share, round(share / alltime, 6) AS self_index, round(pm, 6) AS peer_median_share, peer_n_accounts,
  CASE WHEN pm > 0 THEN round(share / pm, 6) ELSE 0e0 END AS peer_index, bias_flag, bias_flag <> '' AS has_note FROM mix"""


def show_mix(d):
    d = d.withColumn("has_note", F.col("bias_note") != "").drop("bias_note")
    return rounded(d, share=6, account_alltime_share=6, self_index=6, peer_median_share=6, peer_index=6)


@query("share_of_mix", SHARE_SQL)
def share_of_mix(t):
    return show_mix(rollup(t))


@query("hiring_mix_matrix", with_(FACTS_SQL, MIX_SQL) + """, last AS (SELECT account_id, period FROM (SELECT DISTINCT account_id, period FROM mix)
  QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY period DESC) <= 8),
sums AS (SELECT account_id, dim_key, round(sum(share), 9) AS s FROM mix GROUP BY 1, 2),
dims AS (SELECT account_id, dim_key, row_number() OVER (PARTITION BY account_id ORDER BY s DESC, dim_key) AS dim_rank FROM sums QUALIFY dim_rank <= 3)
SELECT account_id, dim_key, dim_rank, period, round(share, 6) AS share, bias_flag FROM mix JOIN last USING (account_id, period) JOIN dims USING (account_id, dim_key)""")
def hiring_mix_matrix(t):
    d = mix.mix_matrix(rollup(t), periods=8, top=3)
    return rounded(d, share=6).select("account_id", "dim_key", F.col("dim_rank").cast("long").alias("dim_rank"), "period", "share", "bias_flag")


@query("period_series", with_(FACTS_SQL) + """, c AS (SELECT account_id, period, count(*) AS n FROM facts GROUP BY ALL),
l AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY period DESC) AS back FROM c QUALIFY back <= 8),
m AS (SELECT account_id, list_sort(list(n)) AS ns, max(n) AS mx FROM l GROUP BY 1)
SELECT account_id, period, n, back, n = mx AND n > ns[1 + len(ns) // 2] AS hot FROM l JOIN m USING (account_id)""")
def period_series(t):
    d = mix.period_series(facts(t).withColumnRenamed("account", "account_id"), "account_id")
    return d.withColumn("back", F.col("back").cast("long"))


@query("power_concentration", """SELECT n_name AS account_id, CAST(l_suppkey AS VARCHAR) AS site_id, count(*) AS n,
  CAST(sum(count(*)) OVER (PARTITION BY n_name) AS BIGINT) AS denom, round(count(*) / sum(count(*)) OVER (PARTITION BY n_name), 6) AS share,
  CASE WHEN sum(count(*)) OVER (PARTITION BY n_name) < 25 THEN 'low_n' ELSE '' END AS bias_flag
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE l_quantity >= 40 OR l_returnflag = 'R' GROUP BY n_name, l_suppkey""")
def power_concentration(t):
    d = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    d = d.select(F.col("n_name").alias("account"), F.col("l_suppkey").cast("string").alias("site"), "l_quantity", "l_returnflag")
    out = mix.power_concentration(d, "account", "site", (F.col("l_quantity") >= 40) | (F.col("l_returnflag") == "R"))
    return rounded(out, share=6).drop("bias_note")


# ---------------------------------------------------------------- rules
@query("first_match_rules", with_(dv.POSTINGS_SQL, dv.CLASSIFIED_SQL) + """SELECT posting_id, role_slug, job_family, job_family_rule, seniority_rank,
  seniority_rule, excluded FROM classified""")
def first_match_rules(t):
    return rules.classify(dv.postings(t)).select("posting_id", "role_slug", "job_family", "job_family_rule", "seniority_rank", "seniority_rule", "excluded")


def resolved(t):
    return resolve.resolve(dv.postings(t), resolve.build_site_index(dv.sites(t)), key="city_slug")


def scored(t):
    s = dv.sites(t)
    return upsert.rescore(dv.postings(t), resolve.build_site_index(s), s, F.lit(dv.AS_OF))


CORPUS = (dv.POSTINGS_SQL, dv.SITES_SQL, dv.CLASSIFIED_SQL, dv.INDEX_SQL, dv.SCORED_SQL)


@query("admit_score", with_(*CORPUS) + "SELECT posting_id, icp_fit, job_family, tier2_admit, tier2_score FROM scored")
def admit_score(t):
    return scored(t).select("posting_id", "icp_fit", "job_family", "tier2_admit", "tier2_score")


@query("resolve_sites", with_(*CORPUS) + """SELECT posting_id, account_id, coalesce(site_id, '') AS site_id, site_resolution, n_site_candidates FROM scored""")
def resolve_sites(t):
    return resolved(t).select("posting_id", "account_id", F.coalesce("site_id", F.lit("")).alias("site_id"), "site_resolution", "n_site_candidates")


@query("site_candidates", with_(dv.SITES_SQL, dv.INDEX_SQL) + "SELECT account_id, key, site_id FROM best JOIN site_index USING (account_id, key, tier) GROUP BY ALL")
def site_candidates(t):
    """What an ambiguous place stands between, by place key."""
    return resolve.site_candidates(resolve.build_site_index(dv.sites(t)))


@query("unmatched_places", with_(*CORPUS) + """SELECT account_id, city_slug AS city_raw, city_slug AS key, count(*) AS n, count(*) FILTER (tier2_admit) AS n_admitted,
  CAST(min(first_seen) AS VARCHAR) AS first_seen, CAST(max(last_seen) AS VARCHAR) AS last_seen,
  CASE WHEN city_slug = '' THEN 'no_place' WHEN starts_with(city_slug, 'metro') THEN 'needs_alias' ELSE 'missing_site' END AS verdict
  FROM scored WHERE site_id IS NULL AND site_resolution <> 'ambiguous' GROUP BY ALL""")
def unmatched_places(t):
    p = scored(t)
    names = p.filter(F.startswith("city_slug", F.lit("metro"))).select(F.col("city_slug").alias("synonym")).distinct()
    d = resolve.unmatched(p, names)
    return d.withColumns({c: F.col(c).cast("string") for c in ("first_seen", "last_seen")})


@query("mirror", with_(*CORPUS) + """, subs AS (SELECT a.account_id AS parent, b.account_id AS child, b.n_nationkey AS ord FROM
  (SELECT lower(n_name) AS account_id, * FROM nation) a JOIN (SELECT lower(n_name) AS account_id, * FROM nation) b
  ON a.n_regionkey = b.n_regionkey AND b.n_nationkey > a.n_nationkey AND b.n_nationkey <= a.n_nationkey + 10),
hit AS (SELECT p.posting_id, s.child, s.ord, c.one FROM resolved p JOIN subs s ON p.account_id = s.parent
  JOIN best c ON c.account_id = s.child AND c.key = p.city_slug WHERE c.n = 1 AND c.tier <= 2),
pick AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY ord) = 1)
SELECT posting_id, coalesce(child, '') AS mirror_account_id, coalesce(one, '') AS mirror_site_id,
  CASE WHEN child IS NULL THEN '' WHEN site_resolution IN ('exact_city', 'alias') THEN 'dual_registered' ELSE 'subsidiary_only' END AS mirror_basis
  FROM resolved LEFT JOIN pick USING (posting_id)""")
def mirror(t):
    out = resolve.mirror(dv.postings(t), resolve.build_site_index(dv.sites(t)), subsidiaries(t), key="city_slug")
    return out.select("posting_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("mirror_account_id", "mirror_site_id", "mirror_basis")])


def subsidiaries(t):
    """The next nations of the same region as subsidiaries, in key order."""
    a, b = dv.accounts(t).alias("a"), dv.accounts(t).alias("b")
    near = (F.col("b.n_nationkey") > F.col("a.n_nationkey")) & (F.col("b.n_nationkey") <= F.col("a.n_nationkey") + 10)
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & near).select(
        F.col("a.account_id").alias("parent"), F.col("b.account_id").alias("child"), F.col("b.n_nationkey").alias("ord"))


@query("canonical_names", """SELECT 'c' || c_custkey AS row_id, CASE c_custkey % 5
    WHEN 0 THEN 'NATION_' || c_nationkey WHEN 1 THEN 'NATION_' || c_nationkey WHEN 2 THEN 'NATION_' || c_nationkey
    WHEN 3 THEN 'NATION_' || c_nationkey ELSE 'Other ' || c_custkey END AS company FROM customer""")
def canonical_names(t):
    """Customer company spellings: an alias, a case variant, a parenthetical, a corporate suffix, an unknown name."""
    n = F.col("c_nationkey").cast("string")
    k = F.col("c_custkey")
    raw = (F.when(k % 5 == 0, F.concat(F.lit("n."), n)).when(k % 5 == 1, F.concat(F.lit(" nation_"), n))
           .when(k % 5 == 2, F.concat(F.lit("Nation_"), n, F.lit(" (now part)"))).when(k % 5 == 3, F.concat(F.lit("NATION_"), n, F.lit(" Pharma")))
           .otherwise(F.concat(F.lit("Other "), k.cast("string"))))
    rows = t.customer.select(F.concat(F.lit("c"), k.cast("string")).alias("row_id"), raw.alias("account_raw"))
    canon = t.nation.select(F.col("n_name").alias("company"))
    alias = t.nation.select(F.concat(F.lit("n."), F.col("n_nationkey").cast("string")).alias("alias"), F.col("n_name").alias("company"))
    return resolve.canonicalize(rows, alias, canon).select("row_id", "company")


# ---------------------------------------------------------------- spine
SPINE_SQL = """spine AS (SELECT l_orderkey * 10 + l_linenumber AS row_no, 'b' || l_partkey AS account_id, 'Site ' || (l_suppkey % 3) AS site,
  'Town ' || (l_quantity % 2) AS city, CASE WHEN l_returnflag = 'R' THEN 'Head ' || l_orderkey ELSE '' END AS named_site_head FROM lineitem)"""
DEDUPED_SQL = """deduped AS (SELECT account_id, site, city, min(row_no) AS row_no, arg_min(named_site_head, (CASE WHEN named_site_head = '' THEN 1 ELSE 0 END) * 1000000000000 + row_no)
  AS named_site_head FROM spine GROUP BY ALL)"""


def spine_rows(t):
    # the fractional part of the quantity is always zero, so % gives 0.0 or 1.0
    return t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"), F.concat(F.lit("b"), F.col("l_partkey").cast("string")).alias("account_id"),
        F.concat(F.lit("Site "), (F.col("l_suppkey") % 3).cast("string")).alias("site"),
        F.concat(F.lit("Town "), (F.col("l_quantity") % 2).cast("string")).alias("city"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("Head "), F.col("l_orderkey").cast("string"))).otherwise("").alias("named_site_head"))


@query("spine_dedupe", with_(SPINE_SQL, DEDUPED_SQL) + "SELECT * FROM deduped")
def spine_dedupe(t):
    return dedupe.dedupe_spine(spine_rows(t))


@query("ordinal_ids", with_(SPINE_SQL, DEDUPED_SQL) + """SELECT row_no, format('{}--s{:02d}', account_id, row_number() OVER (PARTITION BY account_id ORDER BY row_no)) AS site_id
  FROM deduped""")
def ordinal_ids(t):
    d = dedupe.dedupe_spine(spine_rows(t))
    return dedupe.ordinal_ids(d, "account_id", ["row_no"]).select("row_no", "site_id")


@query("read_spine", """WITH r AS (SELECT s_suppkey AS k, s_name, s_nationkey, s_acctbal, max(s_suppkey) OVER () AS mx FROM supplier)
SELECT CASE WHEN k % 2 = 0 THEN 'a.csv' ELSE 'b.csv' END AS file, 'NATION_' || s_nationkey AS account, s_name AS site,
  CASE WHEN k % 4 < 2 THEN 'yes' ELSE 'soft' END AS fit FROM r WHERE k % 10 NOT IN (3, 7, 8) AND k < mx * 0.9""")
def read_spine(t):
    """Supplier rows as two messy exports: a banner, a header on the third row, blank, junk and site-less rows, an appendix."""
    last = t.supplier.agg(F.max("s_suppkey")).scalar()
    k = F.col("s_suppkey")
    account = F.when(k % 10 == 7, "Total").otherwise(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")))
    cells = (F.when(k % 10 == 3, F.array(F.lit(""), F.lit(""), F.lit(""), F.lit("")))
             .otherwise(F.array(account, F.when(k % 10 == 8, "").otherwise(F.col("s_name")), F.lit("Town"), pick_verdict(k))))
    cells = F.when(k >= last * 0.9, F.array(F.lit("Known limits"), F.lit("x"), F.lit(""), F.lit("KEEP"))).otherwise(cells)
    file = F.when(k % 2 == 0, "a.csv").otherwise("b.csv")
    body = t.supplier.select(file.alias("file"), (k + 10).alias("row_no"), cells.alias("cells"))
    top = t.supplier.select(file.alias("file")).distinct().select("file", F.inline(F.array(
        F.struct(F.lit(0).cast("long").alias("row_no"), F.array(F.lit("Site map"), F.lit(""), F.lit(""), F.lit("")).alias("cells")),
        F.struct(F.lit(2).cast("long").alias("row_no"), F.array(F.lit("Account"), F.lit("Site"), F.lit("City"), F.lit("Verdict")).alias("cells")))))
    d = spine.parse_spine(top.unionByName(body))
    return d.select("file", "account", "site", spine.spine_fit().alias("fit"))


def pick_verdict(k):
    return F.when(k % 4 < 2, "Keep - core").otherwise("FLAG")


@query("read_accounts", """SELECT 'nation-' || n_nationkey AS account_id, 'Nation ' || n_nationkey AS company, n_nationkey % 4 <> 0 AS active FROM nation""")
def read_accounts(t):
    raw = t.nation.select(F.concat(F.lit("Nation "), F.col("n_nationkey").cast("string")).alias("Company"),
                          F.when(F.col("n_nationkey") % 4 == 0, "X").otherwise("").alias("Exclude"), F.lit("").alias("HQ"))
    return spine.accounts_from(raw).select("account_id", "company", "active")


@query("missing_parents", """SELECT lower(n_name) AS account_id, n_regionkey <> 0 AS in_universe FROM nation
  WHERE n_regionkey <> 0 OR n_nationkey IN (SELECT s_nationkey FROM supplier)""")
def missing_parents(t):
    known = dv.accounts(t).filter(F.col("n_regionkey") != 0).select("account_id", "company", F.lit(True).alias("in_universe"), "active", "exclude")
    seen = dv.sites(t).select("account_id", F.upper("account_id").alias("company"))
    return dedupe.add_missing_parents(known, seen).select("account_id", "in_universe")


@query("url_dedupe", """WITH r AS (SELECT 'https://h' || (c_nationkey % 5) || '.example/' || o_custkey AS url, o_orderkey AS posting_id,
  (o_orderkey % 5) = (c_nationkey % 5) AS owns FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT url, posting_id, owns FROM r QUALIFY row_number() OVER (PARTITION BY url ORDER BY owns DESC, posting_id) = 1""")
def url_dedupe(t):
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    home = F.col("c_nationkey") % 5
    d = d.select(F.concat(F.lit("https://h"), home.cast("string"), F.lit(".example/"), F.col("o_custkey").cast("string")).alias("url"),
                 F.col("o_orderkey").alias("posting_id"), (F.col("o_orderkey") % 5 == home).alias("owns"))
    return dedupe.dedupe_url(d, F.col("owns"))


# ---------------------------------------------------------------- accretion
SIGHTINGS_SQL = """sightings AS (SELECT user_id || ':' || event_type AS posting_id, CAST(ts AS DATE) AS run, ts FROM events)"""
ACCRETED = with_(SIGHTINGS_SQL) + """SELECT posting_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen,
  count(DISTINCT run) AS seen_count, year(min(ts)) || 'Q' || quarter(min(ts)) AS period_first FROM sightings GROUP BY 1"""


def sightings(t):
    return t.events.select(F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("posting_id"),
                           F.date_format("ts", "yyyyMMdd").alias("run_id"), F.col("ts").alias("seen_at"), "event_id")


def show_accreted(d):
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return d.select("posting_id", at("first_seen"), at("last_seen"), F.col("seen_count").cast("long").alias("seen_count"), "period_first")


@query("accrete_sightings", ACCRETED)
def accrete_sightings(t):
    return show_accreted(upsert.accrete(sightings(t), "posting_id"))


@query("accrete_incremental", ACCRETED)
def accrete_incremental(t):
    """The same state built in three merges: the later runs, the earlier ones with some of the later again, and all of them a second time."""
    s = sightings(t)
    late = F.col("run_id") < "20240116"
    state, log = upsert.accrete(s.filter(~late), "posting_id"), upsert.per_run(s.filter(~late), ["posting_id"])
    for part in (s.filter(late | (F.col("run_id") > "20240124")), s):
        state, more = upsert.accrete_into(state, log, part, "posting_id")
        log = log.unionByName(more)
    return show_accreted(state)


@query("fold_duplicates", """WITH r AS (SELECT o_orderkey, 'a' || (o_custkey % 40) AS account_id, 'c' || (o_custkey % 7) AS city_slug, o_orderpriority AS role_slug,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS req_id FROM orders),
own AS (SELECT *, CASE WHEN req_id <> '' THEN account_id || '--jr-' || req_id ELSE account_id || '--jr-h' || substr(sha1(city_slug || '|' || role_slug), 1, 10) END AS own FROM r),
canon AS (SELECT account_id, city_slug, role_slug, min(own) AS canon FROM own WHERE req_id <> '' GROUP BY ALL)
SELECT o_orderkey, CASE WHEN req_id <> '' THEN own ELSE coalesce(canon, own) END AS posting_id FROM own LEFT JOIN canon USING (account_id, city_slug, role_slug)""")
def fold_duplicates(t):
    d = t.orders.select("o_orderkey", F.concat(F.lit("a"), (F.col("o_custkey") % 40).cast("string")).alias("account_id"),
                        F.concat(F.lit("c"), (F.col("o_custkey") % 7).cast("string")).alias("city_slug"), F.col("o_orderpriority").alias("role_slug"),
                        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string")).otherwise("").alias("req_id"))
    return upsert.fold_duplicates(d).select("o_orderkey", "posting_id")


TIERED = """WITH r AS (SELECT user_id, event_id, value, list_position(['error', 'view', 'click', 'signup', 'purchase'], event_type) AS rank FROM events)
SELECT user_id, event_id AS run_seq, round(value, 4) AS value FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank DESC, event_id DESC) = 1"""


@query("tier_upsert", TIERED)
def tier_upsert(t):
    tiers = F.create_map(*[F.lit(x) for kv in zip(["error", "view", "click", "signup", "purchase"], cfg.TIERS) for x in kv])
    d = t.events.select("user_id", "ts", F.col("event_id").alias("run_seq"), F.round("value", 4).alias("value"), tiers[F.col("event_type")].alias("extraction_tier"))
    first = F.col("ts") < "2024-01-16"
    return upsert.tier_upsert(d.filter(first), d.filter(~first), "user_id").drop("extraction_tier", "ts")


@query("tier_upsert_stored", TIERED)
def tier_upsert_stored(t):
    """U3 by parts: the same over a table in buckets, written a week at a time."""
    tiers = F.create_map(*[F.lit(x) for kv in zip(["error", "view", "click", "signup", "purchase"], cfg.TIERS) for x in kv])
    d = t.events.select("user_id", "ts", F.col("event_id").alias("run_seq"), F.round("value", 4).alias("value"), tiers[F.col("event_type")].alias("extraction_tier"))
    path, kept = f"{scratch(t.spark)}/tables/{uuid.uuid4().hex}", d.drop("ts")
    for part in (F.col("ts") < "2024-01-08", (F.col("ts") >= "2024-01-08") & (F.col("ts") < "2024-01-16"), F.col("ts") >= "2024-01-16"):
        buckets.update(d.filter(part).drop("ts"), path, "user_id", kept.schema, lambda rows, new: upsert.tier_upsert(rows, new, "user_id"))
    return buckets.read(t.spark, path, kept.schema).drop("extraction_tier")


@query("append_quotes", """WITH r AS (SELECT event_id, user_id, event_type, 'claim ' || CAST(floor(value) AS BIGINT) AS txt, ts < TIMESTAMP '2024-01-10' AS old FROM events),
st AS (SELECT * FROM r WHERE old QUALIFY row_number() OVER (PARTITION BY user_id, event_type, txt ORDER BY event_id) = 1),
nw AS (SELECT * FROM r WHERE NOT old AND NOT EXISTS (SELECT 1 FROM st WHERE st.user_id = r.user_id AND st.event_type = r.event_type AND st.txt = r.txt)
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, txt ORDER BY event_id) = 1)
SELECT event_id, old FROM st UNION ALL SELECT event_id, old FROM nw""")
def append_quotes(t):
    key = ["posting_id", "claim_type", "subject_slug", "quote_hash"]
    d = t.events.select("event_id", F.col("user_id").alias("posting_id"), F.col("event_type").alias("claim_type"), F.lit("").alias("subject_slug"),
                        F.concat(F.lit("claim "), F.floor("value").cast("string")).alias("quote_text"), (F.col("ts") < "2024-01-10").alias("old"))
    d = d.withColumn("quote_hash", dedupe.quote_key()[-1])
    order = [F.col("event_id").asc()]
    empty = d.filter(F.lit(False))
    state = dedupe.append_dedupe(empty, d.filter("old"), key, order)
    return dedupe.append_dedupe(state, d.filter("NOT old"), key, order).select("event_id", "old")


@query("prefer_site_rows", """WITH r AS (SELECT event_id AS seq, 'a' || (user_id % 20) AS account_id, sha1(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) AS item_id,
  CASE WHEN event_type = 'signup' THEN 'site' ELSE 'account' END AS query_kind FROM events)
SELECT account_id, item_id, query_kind, seq FROM r QUALIFY row_number() OVER (PARTITION BY account_id, item_id ORDER BY CASE query_kind WHEN 'site' THEN 0 ELSE 1 END, seq) = 1""")
def prefer_site_rows(t):
    return dedupe.prefer_site_rows(news_rows(t)).select("account_id", "item_id", "query_kind", "seq")


def news_rows(t):
    return t.events.select(F.col("event_id").alias("seq"), F.concat(F.lit("a"), (F.col("user_id") % 20).cast("string")).alias("account_id"),
                           F.sha1(F.floor("value").cast("string")).alias("item_id"),
                           F.when(F.col("event_type") == "signup", "site").otherwise("account").alias("query_kind"), F.col("ts").alias("published"))


@query("news_window", """SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-25' - 10""")
def news_window(t):
    return t.events.filter(in_window(F.to_date("ts"), F.lit("2024-01-25"), 10)).select("event_id")


@query("signal_append", """WITH r AS (SELECT event_id, 'a' || (user_id % 9) AS account_id, event_type, lower('T' || CAST(floor(value / 3) AS BIGINT)) AS k, ts < TIMESTAMP '2024-01-08' AS old FROM events),
st AS (SELECT * FROM r WHERE old QUALIFY row_number() OVER (PARTITION BY account_id, event_type, k ORDER BY event_id) = 1),
nw AS (SELECT * FROM r WHERE NOT old AND NOT EXISTS (SELECT 1 FROM st WHERE st.account_id = r.account_id AND st.event_type = r.event_type AND st.k = r.k)
  QUALIFY row_number() OVER (PARTITION BY account_id, event_type, k ORDER BY event_id) = 1)
SELECT event_id AS seq, 'sig' || substr(sha256(account_id || '|' || event_type || '|' || k || '|'), 1, 16) AS signal_id FROM (SELECT * FROM st UNION ALL SELECT * FROM nw)""")
def signal_append(t):
    d = t.events.select(F.lit(None).cast("string").alias("signal_id"), F.concat(F.lit("a"), (F.col("user_id") % 9).cast("string")).alias("account_id"),
                        F.col("event_type").alias("signal_type"), F.concat(F.lit("T"), F.floor(F.col("value") / 3).cast("string")).alias("title"),
                        F.lit("").alias("url"), F.col("event_id").alias("seq"), "ts")
    old = F.col("ts") < "2024-01-08"
    state = dedupe.append_signals(d.filter(F.lit(False)), d.filter(old))
    return dedupe.append_signals(state, d.filter(~old)).select("seq", "signal_id")


@query("patch_and_fill", """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'patched' ELSE c_name END AS c_name,
  CASE WHEN c_acctbal < 0 THEN c_mktsegment || '; more' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def patch_and_fill(t):
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    edits = c.filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.lit("patched").alias("c_name"))
    unknown = edits.select((-F.col("c_custkey") - 1).alias("c_custkey"), "c_name")
    out = upsert.patch(c, edits.unionByName(unknown), "c_custkey")
    more = t.customer.filter("c_acctbal < 0").select("c_custkey", F.lit("late").alias("c_name"), F.lit("more").alias("c_mktsegment"))
    return upsert.fill_empty(out, more, "c_custkey", [], only_empty=["c_name"], append=["c_mktsegment"])


@query("upsert_hosts", """SELECT lower(n_name) AS account_id, CASE WHEN n_regionkey < 3 AND n_nationkey % 3 = 0 THEN 'old' || n_nationkey
    WHEN n_regionkey < 3 THEN 'api' || n_nationkey ELSE 'old' || n_nationkey END AS careers_host,
  CASE WHEN n_regionkey < 3 THEN 'api' || n_nationkey ELSE '' END AS workday_host,
  CASE WHEN n_regionkey < 3 AND n_nationkey % 3 <> 0 THEN 'workday_api' ELSE 'phenom' END AS pattern_kind FROM nation""")
def upsert_hosts(t):
    n = F.col("n_nationkey")
    null = F.lit(None).cast("string")
    state = t.nation.select(F.lower("n_name").alias("account_id"), F.concat(F.lit("old"), n.cast("string")).alias("careers_host"),
                            F.lit("phenom").alias("pattern_kind"), F.lit("10").alias("req_urls_found"),
                            F.when(n % 3 == 0, "ok").otherwise("needs_discovery").alias("probe_status"), null.alias("workday_host"),
                            null.alias("workday_site"), null.alias("notes"))
    new = t.nation.filter("n_regionkey < 3").select(F.lower("n_name").alias("account_id"), F.concat(F.lit("api"), n.cast("string")).alias("host"),
                                             F.lit("Careers").alias("tenant_site"), F.lit("json api").alias("note"), n.alias("n_postings"))
    return upsert.upsert_hosts(state, new).select("account_id", "careers_host", F.coalesce("workday_host", F.lit("")).alias("workday_host"), "pattern_kind")


# ---------------------------------------------------------------- index, api, queue, export
@query("index_sightings", """WITH r AS (SELECT 'a' || (page_id % 5) AS account_id, url, strftime(TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * page_id, '%Y%m%d%H%M%S') AS ts FROM pages),
k AS (SELECT *, lower(regexp_replace(regexp_replace(url, '(?i)^https?://(www\\.)?', ''), '(#.*|/+)$', '')) AS urlkey FROM r)
SELECT account_id, urlkey, url, strftime(strptime(ts, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') AS seen_at FROM k
QUALIFY row_number() OVER (PARTITION BY account_id, urlkey ORDER BY ts, url) = 1""")
def index_sightings(t):
    at = F.date_format(F.timestamp_add("HOUR", F.col("page_id"), F.lit("2024-01-01").cast("timestamp")), "yyyyMMddHHmmss")
    d = t.pages.select(F.concat(F.lit("a"), (F.col("page_id") % 5).cast("string")).alias("account_id"), "url", at.alias("timestamp"))
    return feeds.sightings_from_index(d).withColumn("seen_at", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss"))


@query("api_postings", with_(dv.POSTINGS_SQL) + """SELECT account_id, role_slug, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'R-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') END AS req_id,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'Town' || (o_orderkey % 9) || ', MA' END AS city_raw,
  CASE o_orderkey % 4 WHEN 0 THEN '2026-01-10' WHEN 1 THEN '2026-01-09' WHEN 2 THEN CAST(DATE '2026-01-10' - CAST(o_orderkey % 28 AS INT) AS VARCHAR) ELSE '' END AS posted_date,
  '/job/' || o_orderkey AS path FROM postings""")
def api_postings(t):
    p, k = dv.postings(t), F.col("o_orderkey")
    posted = (F.when(k % 4 == 0, "Posted Today").when(k % 4 == 1, "Posted Yesterday")
              .when(k % 4 == 2, F.concat(F.lit("Posted "), (k % 28).cast("string"), F.lit(" Days Ago"))).otherwise("Posted 30+ Days Ago"))
    req = F.concat(F.lit("R-"), F.lpad(k.cast("string"), 6, "0"))
    bullets = F.when(k % 4 == 0, F.array(F.lit("a b"))).otherwise(F.array(F.lit("x"), req))
    place = F.when(k % 5 == 0, "2 Locations").otherwise(F.concat(F.lit("Town"), (k % 9).cast("string"), F.lit(", MA; Elsewhere")))
    row = F.struct(F.col("role_title").alias("title"), F.concat(F.lit("/job/"), k.cast("string")).alias("externalPath"),
                   place.alias("locationsText"), posted.alias("postedOn"), bullets.alias("bulletFields"))
    pages = p.select("account_id", F.to_json(F.struct(F.array(row).alias("jobPostings"))).alias("payload"))
    d = feeds.postings_from_api(pages, F.lit("2026-01-10"))
    return d.select("account_id", "role_slug", "req_id", F.coalesce("city_raw", F.lit("")).alias("city_raw"),
                    F.coalesce(F.col("posted_date").cast("string"), F.lit("")).alias("posted_date"), "path")


QUEUE_SQL = with_(*CORPUS) + """, open AS (SELECT posting_id, tier2_score AS score FROM scored WHERE tier2_admit AND o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW')
SELECT posting_id, score, row_number() OVER (ORDER BY score DESC, posting_id) AS rn,
  CAST((row_number() OVER (ORDER BY score DESC, posting_id) - 1) // 25 AS INT) AS shard, greatest((SELECT count(*) FROM open) - 200, 0) AS n_dropped
FROM open QUALIFY rn <= 200"""


@query("extraction_queue", QUEUE_SQL)
def extraction_queue(t):
    bodies = dv.postings(t).select("posting_id", F.when(F.col("o_orderstatus") == "P", "short").otherwise(F.repeat(F.col("role_title"), 400)).alias("text"))
    done = dv.postings(t).filter("o_orderpriority = '5-LOW'").select("posting_id")
    d = exports.extraction_queue(scored(t), bodies, done, shard=25, cap=8)
    return d.withColumn("rn", F.col("rn").cast("long"))


@query("jobs_index", with_(*CORPUS) + """SELECT p.account_id AS shown_account, p.posting_id, p.role_title AS title, coalesce(s.city, p.city_slug) AS city,
  p.tier2_score AS score, p.o_orderstatus = 'F' AS has_extract, CASE WHEN p.o_orderstatus = 'F' THEN 'Team ' || (p.o_orderkey % 11) ELSE '' END AS team,
  CASE WHEN p.o_orderstatus = 'F' THEN 'LIMS · SAP' ELSE '' END AS tech
FROM scored p LEFT JOIN sites s USING (site_id) WHERE p.site_id IS NOT NULL OR p.tier2_admit""")
def jobs_index(t):
    p = scored(t).withColumn("mirror_account_id", F.lit(None).cast("string"))
    return exports.jobs_index(p, corpus_extracts(t), dv.sites(t)).select(
        "shown_account", "posting_id", "title", "city", "score", "has_extract", "team", "tech")


def corpus_extracts(t):
    """Extracts of the filled postings."""
    k = F.col("o_orderkey")
    return dv.postings(t).filter("o_orderstatus = 'F'").select(
        "posting_id", "account_id", F.concat(F.lit("Team "), (k % 11).cast("string")).alias("team_name"), F.lit("").alias("parent_org"),
        F.array(F.lit("LIMS"), F.lit("SAP")).alias("tech_stack"), dv.pick(["central_owned", "site_autonomous", "mixed"], k % 9 / 3).alias("autonomy_flag"))


@query("skipped_counts", with_(*CORPUS) + """SELECT account_id AS shown_account, count(*) FILTER (site_id IS NULL AND NOT tier2_admit) AS skipped_no_site FROM scored GROUP BY 1""")
def skipped_counts(t):
    return exports.skipped_counts(scored(t).withColumn("mirror_account_id", F.lit(None).cast("string")))


@query("corpus_stats", with_(*CORPUS) + """, f AS (SELECT 'site_resolution' AS facet, site_resolution AS value FROM scored UNION ALL
  SELECT 'job_family', job_family FROM scored UNION ALL SELECT 'extraction_tier', extraction_tier FROM scored)
SELECT facet, value, count(*) AS n FROM f GROUP BY ALL""")
def corpus_stats(t):
    return tallies.corpus_stats(scored(t), ("site_resolution", "job_family", "extraction_tier"))


@query("title_to_site", with_(dv.SITES_SQL) + """, k AS (SELECT account_id, city_key AS key, site_id FROM sites UNION SELECT account_id, alias_key, site_id FROM sites),
p AS (SELECT 'p' || o_orderkey AS posting_id, lower(n_name) AS account_id, 'town' || (o_orderkey % 11) AS w FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)
SELECT posting_id, min(site_id) AS title_site_id FROM p JOIN k ON p.account_id = k.account_id AND (p.w = k.key) GROUP BY 1 HAVING count(DISTINCT site_id) = 1""")
def title_to_site(t):
    p = dv.postings(t).withColumn("role_title", F.concat(F.lit("Engineer, Town "), (F.col("o_orderkey") % 11).cast("string"), F.lit(" plant")))
    return resolve.title_site(p, resolve.site_keys(dv.sites(t)))


@query("posting_location", with_(*CORPUS) + """SELECT posting_id, CASE WHEN site_id IS NOT NULL THEN 'site' WHEN city_slug = '' THEN 'none' ELSE 'city' END AS loc_kind,
  CASE WHEN site_id IS NOT NULL THEN site_id WHEN city_slug = '' THEN '' ELSE 'city:' || city_slug END AS loc_id,
  CASE WHEN city_slug = '' THEN '' ELSE 'url' END AS loc_source FROM scored""")
def posting_location(t):
    return resolve.location(resolved(t), dv.sites(t)).select("posting_id", "loc_kind", "loc_id", "loc_source")


@query("url_parse", """SELECT page_id, CASE WHEN page_id % 5 = 4 THEN 'slug_only' WHEN page_id % 5 = 3 THEN 'slug_tail_id' WHEN page_id % 5 = 2 THEN 'id_first' WHEN page_id % 5 = 1 THEN 'phenom_datepath' ELSE 'phenom' END AS url_form,
  CASE WHEN page_id % 5 IN (0, 2, 3) THEN CAST(10000 + page_id AS VARCHAR) ELSE '' END AS req_id,
  CASE WHEN page_id % 5 < 2 THEN 'newtown' ELSE '' END AS city_slug,
  regexp_extract(url, '^https?://([^/]+)/', 1) AS host FROM pages WHERE NOT contains(url, '?')""")
def url_parse(t):
    """Page URLs with a posting path put after their host; those with a query string are no posting."""
    k = F.col("page_id")
    n = (10000 + k).cast("string")
    path = (F.when(k % 5 == 0, F.concat(F.lit("/job/New%20Town-MA/data-lead/7684/"), n)).when(k % 5 == 1, F.concat(F.lit("/job/new-town/data-lead/7684/6/12/2024"), F.lit("")))
            .when(k % 5 == 2, F.concat(F.lit("/jobs/"), n, F.lit("/data-lead"))).when(k % 5 == 3, F.concat(F.lit("/jobs/data-lead-"), n))
            .otherwise(F.lit("/job/data-lead-engineer")))
    query_part = F.regexp_extract("url", r"(\?.*)$", 1)
    host = F.regexp_extract("url", r"^https?://([^/]+)/", 1)
    d = t.pages.select("page_id", host.alias("host"), F.concat(F.lit("https://"), host, path, query_part).alias("url"))
    return parse.parse_url_shapes(d).select("page_id", "url_form", "req_id", "city_slug", "host")


@query("best_host", """WITH r AS (SELECT 'a' || (page_id % 4) AS account_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host, regexp_extract(url, '^https?://[^/]+(/[a-z]+)/', 1) AS g,
  CASE WHEN page_id % 3 = 0 THEN 'workday' ELSE 'phenom' END AS kind FROM pages WHERE page_id % 3 <> 2),
p AS (SELECT account_id, host, g, kind, count(*) AS n FROM r GROUP BY ALL),
b AS (SELECT account_id, host, g, CAST(sum(n) AS BIGINT) AS req_urls_found, arg_min(kind, (-n) * 10 + CASE kind WHEN 'phenom' THEN 0 ELSE 1 END) AS pattern_kind FROM p GROUP BY ALL)
SELECT account_id, host AS careers_host, g AS req_path_glob, pattern_kind, req_urls_found FROM b
QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY req_urls_found DESC, host, g) = 1""")
def best_host(t):
    k = F.col("page_id")
    d = t.pages.select(F.concat(F.lit("a"), (k % 4).cast("string")).alias("account_id"), F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"),
                       F.regexp_extract("url", r"^https?://[^/]+(/[a-z]+)/", 1).alias("glob"),
                       F.when(k % 3 == 0, "workday").when(k % 3 == 1, "phenom_datepath").otherwise("id_first").alias("url_form"),
                       F.when(k % 3 == 0, k.cast("string")).otherwise("").alias("req_id"))
    return tallies.best_host(d).drop("city_from_url")
