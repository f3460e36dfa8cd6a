"""Queries over label layers and gold tables: hiring, locations, titles, targets, people, marts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.gates import gate, pipeline_group
from attesta.functions.text import title_key
from attesta.operators import claims, marts, mix, org, quality, query as served, resolve, rules, scoring, stories, tallies, upsert
from attesta.operators.claims import GateFailed
from attesta.plans import derive as dv
from attesta.plans.base import query
from attesta.plans.derive import sql_byte, sql_list, sql_pick, sql_spread, with_
from attesta.plans.q_corpus import CORPUS, FACTS_SQL, MIX_SQL, corpus_extracts, facts, rollup, scored
from attesta.plans.q_org import COVERAGE_SQL, covered, site_units
from attesta.plans.q_verdicts import (FINAL_SQL, FIT_SQL, NEWS_SQL, PROFILE_SQL, SITE, final_rows, fit_rows, news, profile,
                                      ranked_publications)
from attesta.plans.q_text import GATE_SQL, VERIFIED_SQL, gate_bodies, gate_quotes
from attesta.session import land, scratch
from attesta.sources import exports, feeds, tables

# ---------------------------------------------------------------- title labels, hiring
LABELS_SQL = f"""labels_t AS (SELECT DISTINCT role_title AS title_key, {sql_list(cfg.FAMILY_NAMES + ['other', 'unsure'])}[1 + {sql_byte("role_title || '|f'")} % 9] AS f,
  {sql_spread("role_title || '|d'")} AS d, {sql_spread("role_title || '|b'")} AS b FROM scored WHERE NOT contains(role_title, 'operator')),
resolved_l AS (SELECT s.*, CASE WHEN job_family <> '' THEN job_family WHEN excluded <> '' THEN 'excluded' WHEN l.title_key IS NOT NULL THEN f ELSE 'not_labeled' END AS family,
  CASE WHEN job_family <> '' THEN job_family IN {tuple(cfg.CORE_FAMILIES)} WHEN excluded <> '' THEN false WHEN l.title_key IS NOT NULL THEN d >= 0.8 ELSE false END AS is_digital,
  CASE WHEN job_family <> '' THEN job_family IN {tuple(cfg.BIOPROCESS_CORE)} WHEN excluded <> '' THEN false WHEN l.title_key IS NOT NULL THEN b >= 0.8 ELSE false END AS is_bioprocess,
  CASE WHEN job_family <> '' THEN 'rule' WHEN excluded <> '' THEN '' WHEN l.title_key IS NOT NULL THEN 'model' ELSE '' END AS label_source
  FROM scored s LEFT JOIN labels_t l ON l.title_key = s.role_title)"""


def title_labels(t):
    b = lambda tag: dv.byte("title_key", F.lit(tag))
    keys = dv.postings(t).select(title_key("role_title").alias("title_key")).distinct()
    return keys.filter(~F.contains("title_key", F.lit("operator"))).select("title_key", dv.pick(cfg.FAMILY_NAMES + ["other", "unsure"], b("f") % 9).alias("job_family_gated"),
                                            gate(dv.spread(b("d"))).alias("digital_data_it_gated"), gate(dv.spread(b("b"))).alias("bioprocess_core_gated"))


def labeled(t):
    return rules.resolve_label(scored(t), title_labels(t))


@query("resolve_label", with_(*CORPUS, LABELS_SQL) + "SELECT posting_id, family, is_digital, is_bioprocess, label_source FROM resolved_l")
def resolve_label(t):
    return labeled(t).select("posting_id", "family", "is_digital", "is_bioprocess", "label_source")


def _tally_sql(by: str) -> str:
    named = tuple(cfg.FAMILY_NAMES)
    return f"""SELECT {by}, count(*) AS postings, {', '.join(f"count(*) FILTER (family = '{b}') AS n_{b}" for b in tallies.BUCKETS)}, count(*) FILTER (is_digital) AS n_digital_data_it,
  count(*) FILTER (is_bioprocess) AS n_bioprocess_core, count(*) FILTER (last_seen >= cut) AS n_recent, count(*) FILTER (is_digital AND last_seen >= cut) AS n_digital_recent,
  count(*) FILTER (is_bioprocess AND last_seen >= cut) AS n_bioprocess_recent, CAST(max(last_seen) AS VARCHAR) AS newest_last_seen, count(*) FILTER (label_source = 'rule' AND family IN {named}) AS family_from_rule,
  count(*) FILTER (label_source = 'model' AND family IN {named}) AS family_from_model, CAST(min(cut) AS VARCHAR) AS window_from"""


_CUT = ", r AS (SELECT *, (SELECT max(last_seen) FROM resolved_l) - 365 AS cut FROM resolved_l)\n"


@query("hiring_tally", with_(*CORPUS, LABELS_SQL) + _CUT + _tally_sql("site_id") + " FROM r WHERE site_id IS NOT NULL GROUP BY 1")
def hiring_tally(t):
    return _shown_tally(tallies.hiring_tally(labeled(t), "site_id", newest=newest_posting(t)))


def newest_posting(t):
    return dv.postings(t).agg(F.max("last_seen")).scalar()


@query("account_hiring", with_(*CORPUS, LABELS_SQL) + _CUT + _tally_sql("account_id") + ", count(DISTINCT site_id) AS sites_with_postings FROM r GROUP BY 1")
def account_hiring(t):
    d = labeled(t).withColumn("mirror_account_id", F.lit(None).cast("string"))
    return _shown_tally(tallies.account_hiring(d, newest=newest_posting(t))).drop("mirror_postings")


def _shown_tally(d):
    return d.withColumns({c: F.col(c).cast("string") for c in ("newest_last_seen", "window_from")})


@query("title_groups", with_(*CORPUS) + """, n AS (SELECT role_title AS title_key, account_id, count(*) AS n FROM scored GROUP BY ALL)
SELECT title_key, CAST(sum(n) AS BIGINT) AS n_postings, count(*) AS n_accounts, string_split(min(lpad(CAST(1000000000 - n AS VARCHAR), 12, '0') || '~' || account_id), '~')[2] AS modal_account FROM n GROUP BY 1""")
def title_groups(t):
    return tallies.title_groups(scored(t)).select("title_key", "n_postings", "n_accounts", "modal_account")


SCOPE_SQL = f"""scope AS (SELECT DISTINCT role_title, {sql_spread("role_title || '|gs'")} AS gp, {sql_spread("role_title || '|ss'")} AS sp, {sql_spread("role_title || '|di'")} AS dp, job_family <> '' AS ruled FROM scored)"""


def scopes(t):
    groups = tallies.title_groups(scored(t)).select("title_key", F.when(F.col("rule_family") != "", "rule").otherwise("model").alias("digital_source"))
    p = lambda tag: dv.spread(dv.byte("title_key", F.lit(tag)))
    answers = groups.select("title_key", p("gs").alias("global_scope_p"), p("ss").alias("site_scope_p"), p("di").alias("digital_data_it_p"))
    return rules.title_scope(groups, answers)


@query("digital_veto", with_(*CORPUS, SCOPE_SQL) + "SELECT posting_id FROM scored JOIN scope USING (role_title) WHERE NOT (ruled AND dp <= 0.2)")
def digital_veto(t):
    return rules.veto(scored(t), scopes(t)).select("posting_id")


@query("scope_shares", with_(*CORPUS, SCOPE_SQL) + """SELECT account_id, count(*) AS n_rows, count(*) FILTER (gp >= 0.8) AS n_global_titled, count(*) FILTER (sp >= 0.8) AS n_site_titled, round(avg(gp), 6) AS global_scope_p_mean,
  round(count(*) FILTER (gp >= 0.8) / count(*), 6) AS global_titled_share FROM scored JOIN scope USING (role_title) GROUP BY 1""")
def scope_shares(t):
    d = tallies.scope_shares(scored(t), scopes(t), "account_id")
    return d.select("account_id", "n_rows", "n_global_titled", "n_site_titled", F.round("global_scope_p_mean", 6).alias("global_scope_p_mean"), F.round("global_titled_share", 6).alias("global_titled_share"))


@query("location_concentration", """WITH r AS (SELECT c_mktsegment AS account, n_name AS loc, CASE WHEN c_custkey % 9 = 0 THEN 'remote' WHEN c_custkey % 11 = 0 THEN 'none' WHEN c_nationkey % 2 = 0 THEN 'site' ELSE 'city' END AS kind
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
b AS (SELECT account, count(*) AS n_rows, count(*) FILTER (kind IN ('site', 'city')) AS n_located, count(*) FILTER (kind = 'remote') AS n_remote, count(*) FILTER (kind = 'none') AS n_no_location FROM r GROUP BY 1),
p AS (SELECT account, loc, count(*) AS n, row_number() OVER (PARTITION BY account ORDER BY count(*) DESC, loc) AS rn FROM r WHERE kind IN ('site', 'city') GROUP BY 1, 2),
t AS (SELECT account, count(*) AS n_locations, max(loc) FILTER (rn = 1) AS top_id, max(n) FILTER (rn = 1) AS top_n, sum(n) FILTER (rn <= 3) AS top3 FROM p GROUP BY 1)
SELECT account, n_rows, n_located, n_remote, n_no_location, n_locations, top_id, top_n, round(top_n / n_located, 6) AS top_share, round(top3 / n_located, 6) AS top3_share,
  CASE WHEN n_located < 8 OR n_located < 0.5 * n_rows THEN 'thin evidence' WHEN top_n / n_located >= 0.05 THEN 'concentrated at ' || top_id ELSE 'spread over ' || n_locations || ' locations' END AS location_label FROM b JOIN t USING (account)""")
def location_concentration(t):
    d = located(t)
    out = tallies.location_concentration(d, "account", "loc", top=0.05)
    return out.select("account", "n_rows", "n_located", "n_remote", "n_no_location", "n_locations", "top_id", "top_n", F.round("top_share", 6).alias("top_share"),
                      F.round("top3_share", 6).alias("top3_share"), "location_label")


@query("location_shares", """WITH r AS (SELECT c_mktsegment AS account, n_name AS loc, CASE WHEN c_nationkey % 2 = 0 THEN 'site' ELSE 'city' END AS loc_kind FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 9 <> 0 AND c_custkey % 11 <> 0)
SELECT account, loc, loc_kind, n, round(n / sum(n) OVER (PARTITION BY account), 6) AS share FROM (SELECT account, loc, loc_kind, count(*) AS n FROM r GROUP BY ALL)""")
def location_shares(t):
    return tallies.location_shares(located(t), "account", "loc").withColumn("share", F.round("share", 6))


def located(t):
    c = F.col("c_custkey")
    kind = F.when(c % 9 == 0, "remote").when(c % 11 == 0, "none").when(F.col("c_nationkey") % 2 == 0, "site").otherwise("city")
    d = t.orders.join(t.customer, F.col("o_custkey") == c).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return d.select(F.col("c_mktsegment").alias("account"), F.col("n_name").alias("loc"), kind.alias("loc_kind"))


# ---------------------------------------------------------------- targets, people
TARGET_SQL = f"""v AS (SELECT *, {sql_pick(['KEEP', 'FLAG', 'DROP'], sql_byte("site_id || '|v'") + ' % 3')} AS verdict, {sql_byte("site_id || '|c'")} < 25 AS closed,
  split_part(city, ' (', 1) AS proper FROM sites),
ok AS (SELECT *, lower(proper) AS key, (CASE verdict WHEN 'FLAG' THEN '1' ELSE '0' END) || site_id AS pos FROM v WHERE verdict IN ('KEEP', 'FLAG') AND verdict_manual = '' AND NOT closed),
keys AS (SELECT account_id, key, min(pos) AS pos FROM ok GROUP BY ALL),
picks AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY pos) AS rank FROM keys QUALIFY rank <= 6)"""


@query("site_targets", with_(dv.SITES_SQL, TARGET_SQL) + "SELECT account_id, rank, key AS city_key, site_id FROM ok JOIN picks USING (account_id, key)")
def site_targets(t):
    s = dv.sites(t)
    b = lambda tag: dv.byte("site_id", F.lit(tag))
    verdicts = s.select("site_id", dv.pick(["KEEP", "FLAG", "DROP"], b("v") % 3).alias("verdict"), (b("c") < 25).alias("closed"))
    return upsert.site_targets(s, verdicts).select("account_id", F.col("rank").cast("long").alias("rank"), "city_key", "site_id")


PEOPLE_SQL = """people AS (SELECT s.account_id, regexp_replace(lower(regexp_extract(named_site_head, '^(.*), VP', 1)), '[^a-z]', '', 'g') AS n, site_id, regexp_extract(named_site_head, '^(.*), VP', 1) AS name, company, pipeline_status
  FROM sites s JOIN accounts a USING (account_id) WHERE active AND in_universe AND (CASE WHEN verdict_manual <> '' THEN verdict_manual ELSE verdict_auto END) = 'KEEP' AND s_suppkey % 6 >= 3),
targets AS (SELECT account_id || '--ct-' || substr(n, 1, 24) || '-' || substr(sha1(n), 1, 10) AS target_id, account_id, min(name) AS name, min(pipeline_status) AS pipeline_status, count(DISTINCT site_id) AS n_sites FROM people GROUP BY account_id, n)"""


@query("people_targets", with_(dv.ACCOUNTS_SQL, dv.SITES_SQL, PEOPLE_SQL) + "SELECT target_id, name, n_sites, CASE pipeline_status WHEN 'Closed Lost' THEN 3 WHEN 'No Deal Found' THEN 2 WHEN '' THEN 2 ELSE 1 END AS priority FROM targets")
def people_targets(t):
    targets, _ = upsert.people_targets(dv.sites(t), dv.accounts(t))
    return targets.select("target_id", "name", "n_sites", "priority")


@query("people_fold", with_(dv.ACCOUNTS_SQL, dv.SITES_SQL, PEOPLE_SQL) + f"""SELECT t.target_id AS site_head_id, p.site_id, {sql_byte("t.target_id || '|f'")} < 180 AS found, 'Head & Lead' AS found_title FROM targets t JOIN people p
  ON p.account_id || '--ct-' || substr(p.n, 1, 24) || '-' || substr(sha1(p.n), 1, 10) = t.target_id""")
def people_fold(t):
    targets, links = upsert.people_targets(dv.sites(t), dv.accounts(t))
    look = targets.select("target_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("batch"), (dv.byte("target_id", F.lit("f")) < 180).alias("found"), F.lit("Head &amp; Lead").alias("found_title"))
    return upsert.fold_people(targets, links, look).select("site_head_id", "site_id", "found", "found_title")


@query("role_fold", """SELECT 's' || s_suppkey || '--rh-' || substr('annlee' || translate(CAST(s_suppkey AS VARCHAR), '0123456789', 'abcdefghij'), 1, 24) || '-' || substr(sha1('annlee' || translate(CAST(s_suppkey AS VARCHAR), '0123456789', 'abcdefghij')), 1, 10) AS site_head_id, 'Plant & Site Lead' AS title,
  CASE WHEN s_acctbal < 0 THEN '2024-06-02' ELSE '2024-06-01' END AS checked_at FROM supplier""")
def role_fold(t):
    k = F.col("s_suppkey")
    name = F.concat(F.lit("Ann Lee "), F.translate(k.cast("string"), "0123456789", "abcdefghij"))
    person = lambda nm, chosen: F.struct(nm.alias("name"), F.lit("Plant &amp; Site Lead").alias("title"), F.lit("a.lee@x.example").alias("email"), F.lit(chosen).alias("chosen"))
    s = t.supplier.select(F.concat(F.lit("s"), k.cast("string")).alias("site_id"), F.lit("a").alias("account_id"), F.array(person(name, True), person(F.lit("Other One"), False)).alias("candidates"), "s_acctbal")
    first = s.withColumn("ran_at", F.lit("2024-06-01T00:00:00"))
    again = s.filter("s_acctbal < 0").withColumn("ran_at", F.lit("2024-06-02T00:00:00"))
    empty = t.spark.createDataFrame([], "site_head_id string, account_id string, site_id string, name string, title string, email string, source string, checked_at string")
    state = upsert.fold_roles(empty, first)
    return upsert.fold_roles(state, again).select("site_head_id", "title", "checked_at")


@query("email_status", """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'suspect' WHEN 1 THEN 'found' WHEN 2 THEN 'suspect_domain' WHEN 3 THEN 'found' ELSE 'not_found' END AS email_checked FROM customer""")
def email_status(t):
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    mail = (F.when(k % 5 == 0, F.concat(F.lit("a.b@corp"), n, F.lit(".com"))).when(k % 5 == 1, F.concat(F.lit("ann.lee@mail.corp"), n, F.lit(".co.jp")))
            .when(k % 5 == 2, F.lit("ann.lee@oldco.org")).when(k % 5 == 3, F.concat(F.lit("ann.lee@corp"), n, F.lit("labs.com"))).otherwise(""))
    d = t.customer.select("c_custkey", n.alias("account_id"), mail.alias("email"), F.when(k % 5 == 4, "not_found").otherwise("found").alias("email_status"))
    domains = t.nation.select(F.col("n_nationkey").cast("string").alias("account_id"), F.concat(F.lit("corp"), F.col("n_nationkey").cast("string"), F.lit(".com")).alias("domain"))
    return rules.email_status(d, domains).select("c_custkey", "email_checked")


@query("pipeline_groups", with_(dv.ACCOUNTS_SQL) + "SELECT account_id, CASE WHEN pipeline_status IN ('Active Pipeline', 'Active Prospect', 'Closed Won') THEN 'Live pipeline' WHEN pipeline_status = 'Closed Lost' THEN 'Closed lost' ELSE 'No deal yet' END AS group_name FROM accounts")
def pipeline_groups(t):
    return dv.accounts(t).select("account_id", pipeline_group("pipeline_status")["name"].alias("group_name"))


@query("stale_rejection", """WITH bad AS (SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0 UNION SELECT c_custkey FROM customer WHERE c_custkey % 11 = 0)
SELECT 'a' AS layer, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM bad) UNION ALL SELECT 'b', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM bad)""")
def stale_rejection(t):
    k = F.col("c_custkey")
    spine = t.customer.select(k.alias("site_id"), F.col("c_nationkey").alias("account_id"), F.col("c_name").alias("site"))
    moved = F.when(F.col("site_id") % 7 == 0, F.col("account_id") + 1).otherwise(F.col("account_id"))
    a = spine.select("site_id", moved.alias("account_id"))
    renamed = F.when(F.col("site_id") % 11 == 0, "other").otherwise(F.col("site"))
    b = spine.select("site_id", "account_id", renamed.alias("site"))
    out, _ = upsert.drop_stale({"a": (a, ["account_id"]), "b": (b, ["account_id", "site"])}, spine)
    return out["a"].select(F.lit("a").alias("layer"), F.col("site_id").alias("c_custkey")).unionByName(
        out["b"].select(F.lit("b").alias("layer"), F.col("site_id").alias("c_custkey")))


@query("unflagged_notes", with_(FACTS_SQL, MIX_SQL) + "SELECT account_id, period, dim_key FROM mix WHERE bias_flag <> '' AND n % 3 = 0")
def unflagged_notes(t):
    """Flagged rollup rows that lack their note: those of every third count, whose notes were taken off."""
    broken = rollup(t).withColumn("bias_note", F.when(F.col("n") % 3 != 0, F.col("bias_note")))
    return quality.unflagged_notes(broken).select("account_id", "period", "dim_key")


# ---------------------------------------------------------------- near-duplicate stories
def _stories_sql(bags: str, thr: float) -> str:
    """The newest-first rule as a recursion over the places of a block. bags: CTE `items` with id, block, newest, w (the word set)."""
    return with_(bags, f"""sized AS (SELECT * FROM items WHERE len(w) > 0), words AS (SELECT id, block, newest, len(w) AS n, unnest(w) AS word FROM sized),
pairs AS (SELECT a.id, b.id AS newer FROM words a JOIN words b ON a.block = b.block AND a.word = b.word AND (b.newest > a.newest OR (b.newest = a.newest AND b.id < a.id)) GROUP BY a.id, b.id, a.n, b.n
  HAVING count(*) / (a.n + b.n - count(*)) >= {thr}),
near AS (SELECT id, list(newer) AS newer FROM pairs GROUP BY id),
line AS (SELECT sized.id, block, coalesce(newer, []) AS newer, row_number() OVER (PARTITION BY block ORDER BY newest DESC, sized.id) AS k FROM sized LEFT JOIN near ON near.id = sized.id),
told(block, k, kept) AS (SELECT block, 1, [id] FROM line WHERE k = 1
  UNION ALL SELECT t.block, t.k + 1, CASE WHEN list_has_any(t.kept, l.newer) THEN t.kept ELSE list_append(t.kept, l.id) END FROM told t JOIN line l ON l.block = t.block AND l.k = t.k + 1),
ends AS (SELECT unnest(kept) AS id FROM told QUALIFY row_number() OVER (PARTITION BY block ORDER BY k DESC) = 1)""").replace("WITH", "WITH RECURSIVE", 1) + """SELECT id AS item_id, block FROM items WHERE len(w) = 0 UNION ALL SELECT ends.id, block FROM ends JOIN items ON items.id = ends.id"""


def _words_sql(c: str) -> str:
    stop = "', '".join(cfg.STORY_STOPWORDS)
    return f"list_distinct(list_filter(regexp_extract_all(lower({c}), '[a-z0-9$]+'), lambda w: length(w) > 2 AND w NOT IN ('{stop}')))"


@query("near_dup_stories", _stories_sql(f"""items AS (SELECT conv_id || '-' || turn AS id, role || '-' || month(DATE '2025-01-01' + CAST(conv_id % 300 AS INT)) AS block, DATE '2025-01-01' + CAST(conv_id % 300 AS INT) AS newest, {_words_sql('text')} AS w FROM conversations)""", cfg.STORY_JACCARD))
def near_dup_stories(t):
    """Conversation turns as stories: blocks of role and calendar month, whole texts as headlines, the newest copy stays."""
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("conv_id") % 300).cast("int"))
    d = t.conversations.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("item_id"),
                               F.concat_ws("-", "role", F.month(day).cast("string")).alias("block"), day.alias("published"), F.col("text").alias("title"))
    return stories.suppress_near_dups(d, "block").select("item_id", "block")


@query("near_dup_documents", _stories_sql(f"""items AS (SELECT doc_id AS id, lang || '-' || source AS block, doc_id AS newest, {_words_sql('text')} AS w FROM documents)""", 0.5))
def near_dup_documents(t):
    """Documents as stories, in blocks of language and source."""
    d = t.documents.select(F.col("doc_id").alias("item_id"), F.concat_ws("-", "lang", "source").alias("block"), F.col("doc_id").alias("published"), F.col("text").alias("title"))
    return stories.suppress_near_dups(d, "block", thr=0.5).select("item_id", "block")


# ---------------------------------------------------------------- marts
@query("central_ledger", with_(*CORPUS) + f""", p AS (SELECT s.account_id, s.site_id, CASE WHEN o_orderstatus = 'F' THEN {sql_pick(['central_owned', 'site_autonomous', 'mixed'], 'floor((o_orderkey % 9) / 3)')} END AS flag, lower(coalesce(t.functions, '')) AS f
  FROM scored s LEFT JOIN sites t USING (site_id) WHERE job_family IN {tuple(cfg.CORE_FAMILIES)}),
c AS (SELECT account_id, count(*) FILTER (flag = 'central_owned') AS n_central, count(*) FILTER (flag = 'site_autonomous') AS n_local, count(*) FILTER (site_id IS NOT NULL AND (contains(f, 'commercial') OR contains(f, 'hq'))) AS n_hq_core,
  count(*) FILTER (site_id IS NOT NULL AND NOT (contains(f, 'commercial') OR contains(f, 'hq'))) AS n_site_core FROM p GROUP BY 1)
SELECT *, n_central + n_local + n_hq_core + n_site_core AS n_observations, CAST(round_even(4 * (n_central + n_hq_core) / (n_central + n_local + n_hq_core + n_site_core), 0) AS INT) AS meter FROM c
  WHERE n_central + n_local + n_hq_core + n_site_core > 0""")
def central_ledger(t):
    return tallies.central_ledger(scored(t), corpus_extracts(t), dv.sites(t))


def signals(t):
    """Documents as signals of every kind, about the account of their source."""
    kind = dv.pick(cfg.SIGNAL_KINDS, F.col("doc_id") % 6)
    return t.documents.select(F.col("doc_id").cast("string").alias("signal_id"), F.concat(F.lit("nation_"), F.regexp_replace("source", "src", "")).alias("account_id"),
                              kind.alias("signal_type"), F.md5("text").alias("title"), F.col("doc_id").alias("seq"))


def publication_ranks(t):
    d = ranked_publications(t)
    return d.select("signal_id", F.concat(F.lit("nation_"), F.regexp_replace("account_id", "src", "")).alias("account_id"), "keep", "rank_in_account")


@query("signal_mart", with_(f"""p AS (SELECT d.doc_id, d.source AS account_id, d.n_chars % 30 AS year, coalesce(l.quality, 0) + {sql_spread("d.doc_id || '|score'")} AS score,
  CASE WHEN {sql_byte("d.doc_id || '|rc'")} < 170 THEN 0.9e0 ELSE 0.4e0 END AS conf, {sql_spread("d.doc_id || '|pd'")} AS pd FROM documents d LEFT JOIN labels l USING (doc_id)),
k AS (SELECT *, score >= 1.5 AND conf >= 0.6 AS keep FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY keep DESC, score DESC, pd DESC, year DESC, CAST(doc_id AS VARCHAR)) AS rk FROM k),
s AS (SELECT doc_id, lang, 'nation_' || replace(source, 'src', '') AS account_id, doc_id % 6 AS ko FROM documents)""") + f"""SELECT s.account_id, {sql_list(cfg.SIGNAL_KINDS)}[1 + ko] AS signal_type,
  row_number() OVER (PARTITION BY s.account_id ORDER BY CASE WHEN keep IS NULL THEN 1 WHEN keep THEN 0 ELSE 2 END, coalesce(rk, 1000000), s.doc_id) AS position, CAST(s.doc_id AS VARCHAR) AS signal_id,
  coalesce(NOT keep, false) AS below_bar FROM s LEFT JOIN r ON r.doc_id = s.doc_id WHERE ko = 0
UNION ALL SELECT account_id, {sql_list(cfg.SIGNAL_KINDS)}[1 + ko], row_number() OVER (PARTITION BY account_id, ko ORDER BY doc_id) AS position, CAST(doc_id AS VARCHAR), false FROM s WHERE ko > 0""")
def signal_mart(t):
    return marts.signal_mart(signals(t), publication_ranks(t)).select("account_id", "signal_type", F.col("position").cast("long").alias("position"), "signal_id", "below_bar")


def mart_layers(t):
    """Layers keyed by site: document readings stand for the site whose number their id is."""
    s = dv.sites(t)
    at = lambda d, c: d.withColumn("site_id", F.concat(F.lit("s"), F.col(c)))
    fit = at(fit_rows(t), "site_id").select("site_id", F.col("model_verdict").alias("verdict"), "reason_tag")
    final = at(final_rows(t), "site_id").select("site_id", "account_id", "verdict", "reason")
    prof = at(profile(t), "item_id").select("site_id", "function_chips", "modality_chips")
    hire = tallies.hiring_tally(labeled(t), "site_id", newest=newest_posting(t))
    items = news(t).withColumn("label_site", F.concat(F.lit("s"), "item_id")).withColumn("title", F.col("item_id"))
    heads = s.filter(F.col("s_suppkey") % 6 >= 3).select(F.col("site_id").alias("site_head_id"), "site_id", "account_id", (F.col("s_suppkey") % 6 >= 4).alias("found"))
    return s, fit, final, prof, hire, tallies.news_rollup(items, "label_site").withColumnRenamed("label_site", "site_id"), heads


@query("site_mart", with_(*CORPUS, LABELS_SQL, COVERAGE_SQL, *SITE, FIT_SQL, FINAL_SQL, NEWS_SQL) + f""", h AS (SELECT site_id, {', '.join(f"count(*) FILTER (family = '{k}') AS n_{k}" for k, _ in cfg.HIRING_LABELS)} FROM resolved_l WHERE site_id IS NOT NULL GROUP BY 1),
x AS (SELECT s.*, f.model_verdict AS mv, f.reason_tag AS mt, n.verdict AS fv, n.reason AS ft, CASE WHEN verdict_manual <> '' THEN upper(verdict_manual) ELSE verdict_auto END AS map_v, coalesce(n.verdict, f.model_verdict) AS v
  FROM sites s LEFT JOIN site_fit f ON 's' || f.site_id = s.site_id LEFT JOIN final n ON 's' || n.site_id = s.site_id)
SELECT x.site_id, map_v AS map_verdict, coalesce(fv, mv, '') AS fit_verdict, CASE WHEN coalesce(fv, mv) IS NULL OR coalesce(fv, mv) = 'REVIEW' THEN '' WHEN fv IS NOT NULL THEN CASE WHEN ends_with(ft, '?') OR lower(ft) = lower(fv) THEN '' ELSE ft END
    ELSE CASE WHEN ends_with(mt, '?') OR lower(mt) = lower(mv) THEN '' ELSE mt END END AS fit_tag,
  CASE WHEN s_suppkey % 6 >= 4 THEN 1 ELSE 0 END AS n_heads, CASE WHEN v = 'KEEP' OR (v = 'FLAG' AND mt IN ('small-mol', 'mixed', 'non-core')) THEN coalesce(concat_ws(' · ', {', '.join(f"CASE WHEN n_{k} > 0 THEN '{name} ' || n_{k} END" for k, name in cfg.HIRING_LABELS)}), '') ELSE '' END AS hiring,
  c.n_indexed, c.coverage_state, CASE WHEN w.keep THEN 1 ELSE 0 END AS n_news FROM x LEFT JOIN h USING (site_id) LEFT JOIN cover c USING (site_id) LEFT JOIN news w ON 's' || w.item_id = x.site_id""")
def site_mart(t):
    s, fit, final, prof, hire, site_news, heads = mart_layers(t)
    d = marts.site_mart(s, fit, final.drop("account_id"), prof, hire, site_news, heads, covered(t))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return d.select("site_id", "map_verdict", blank("fit_verdict"), blank("fit_tag"), "n_heads", blank("hiring"), "n_indexed", "coverage_state", "n_news")


@query("account_mart", with_(dv.ACCOUNTS_SQL, *CORPUS, COVERAGE_SQL, PROFILE_SQL) + """SELECT a.account_id, CASE WHEN pipeline_status IN ('Active Pipeline', 'Active Prospect', 'Closed Won') THEN 0 WHEN pipeline_status = 'Closed Lost' THEN 2 ELSE 1 END AS group_rank,
  count(s.site_id) AS n_sites, count(s.site_id) FILTER ((CASE WHEN verdict_manual <> '' THEN upper(verdict_manual) ELSE verdict_auto END) = 'KEEP') AS n_keep, count(s.site_id) FILTER (s_suppkey % 6 >= 3) AS n_named,
  count(s.site_id) FILTER (s_suppkey % 6 >= 4) AS n_linked, (SELECT count(*) FROM documents d WHERE 'nation_' || replace(d.source, 'src', '') = a.account_id AND d.doc_id % 6 = 0) AS n_publications,
  (SELECT count(*) FROM postings p WHERE p.account_id = a.account_id) AS n_postings, count(s.site_id) FILTER (s.s_acctbal > 0) AS n_units, count(s.site_id) FILTER (coverage_state = 'covered') AS n_covered
  FROM accounts a LEFT JOIN sites s USING (account_id) LEFT JOIN cover c ON c.site_id = s.site_id WHERE active AND in_universe GROUP BY ALL""")
def account_mart(t):
    s, _, final, _, _, _, heads = mart_layers(t)
    foot = tallies.footprints(tallies.account_profile(profile(t)))
    where = tallies.location_concentration(located(t).withColumnRenamed("account", "account_id"), "account_id", "loc")
    d = marts.account_mart(dv.accounts(t), s, heads, signals(t), publication_ranks(t), dv.postings(t), site_units(t), final, foot, where, covered(t))
    return d.select("account_id", F.col("group_rank").alias("group_rank"), "n_sites", "n_keep", "n_named", "n_linked", "n_publications", "n_postings", "n_units", "n_covered")


# ---------------------------------------------------------------- served tables
@query("hiring_mix", with_(FACTS_SQL, MIX_SQL) + "SELECT period, dim_key, n, denom, bias_flag FROM mix WHERE account_id = 'NATION_7'")
def hiring_mix(t):
    d = mix.share_of_mix(facts(t), "account", "period", "family", burst=1.5).withColumn("scope", F.lit("account_period_family"))
    return served.get_hiring_mix(d, "NATION_7").records.select("period", "dim_key", "n", "denom", "bias_flag")


@query("filter_corpus", with_(*CORPUS) + """SELECT posting_id, tier2_score AS score FROM scored WHERE (site_id IS NOT NULL OR tier2_admit) AND job_family = 'data_digital' AND last_seen >= DATE '1997-01-01' AND o_orderstatus = 'F'""")
def filter_corpus(t):
    p = scored(t).withColumn("mirror_account_id", F.lit(None).cast("string"))
    index = exports.jobs_index(p, corpus_extracts(t), dv.sites(t))
    return served.filter_corpus(index, family="data_digital", since="1997-01-01", tool="sap", has_org=True).records.select("posting_id", "score")


@query("query_stats", """WITH q AS (SELECT 'a' || (user_id % 20) AS account_id, user_id, count(*) FILTER (event_type = 'error') AS items FROM events GROUP BY ALL), i AS (SELECT 'a' || (user_id % 20) AS account_id, count(*) AS n, count(*) FILTER (event_type = 'signup') AS s FROM events GROUP BY 1)
SELECT account_id, count(*) AS n_queries, count(*) FILTER (items = 0) AS n_empty, any_value(n) AS n_items, any_value(s) AS n_site_items FROM q JOIN i USING (account_id) GROUP BY 1""")
def query_stats(t):
    acct = F.concat(F.lit("a"), (F.col("user_id") % 20).cast("string")).alias("account_id")
    q = t.events.groupBy(acct, "user_id").agg(F.count_if(F.col("event_type") == "error").alias("items_in_window"))
    i = t.events.select(acct, F.when(F.col("event_type") == "signup", "site").otherwise("account").alias("query_kind"))
    return tallies.query_stats(q, i)


# ---------------------------------------------------------------- guards and tables
def _outcome(check, *args, **kw) -> str:
    try:
        check(*args, **kw)
    except (GateFailed, scoring.BudgetExceeded):
        return "refused"
    return "passed"


@query("guards", with_(GATE_SQL) + f"""SELECT * FROM (SELECT 'pass_rate' AS guard, 'all quotes' AS input, CASE WHEN 100.0 * count(*) FILTER ({VERIFIED_SQL}) / count(*) < {cfg.PASS_RATE} THEN 'refused' ELSE 'passed' END AS outcome, count(*) AS n FROM gated
  UNION ALL SELECT 'pass_rate', 'exact quotes', CASE WHEN 100.0 * count(*) FILTER ({VERIFIED_SQL}) / count(*) < {cfg.PASS_RATE} THEN 'refused' ELSE 'passed' END, count(*) FROM gated WHERE kind = 'exact'
  UNION ALL SELECT 'pass_rate', 'no quotes', 'refused', 0
  UNION ALL SELECT 'shrink', 'one in fifty gone', CASE WHEN count(*) FILTER (o_orderkey % 100 > 0) < count(*) * {1 - cfg.SHRINK_TOLERANCE} THEN 'refused' ELSE 'passed' END, count(*) FROM orders
  UNION ALL SELECT 'shrink', 'one in ten gone', CASE WHEN count(*) FILTER (o_orderkey % 10 > 0) < count(*) * {1 - cfg.SHRINK_TOLERANCE} THEN 'refused' ELSE 'passed' END, count(*) FROM orders
  UNION ALL SELECT 'edges', 'all', 'refused', count(*) FROM lineitem UNION ALL SELECT 'edges', 'quoted', 'passed', count(*) FROM lineitem WHERE l_returnflag <> 'N')""")
def guards(t):
    """V2, V6, V7: what each guard says to good and to broken data, and how many rows it was asked about."""
    gated = land(claims.verify_quotes(gate_quotes(t), gate_bodies(t)).select("kind", "verbatim_verified"))  # asked by every guard and count: no texts with it
    exact = gated.filter("kind = 'exact'")
    edges = t.lineitem.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("edge_id"), F.when(F.col("l_returnflag") != "N", 1).otherwise(0).alias("n_quotes"),
                              F.lit(None).cast("string").alias("human_state"))
    key = F.col("o_orderkey")
    told = [("pass_rate", "all quotes", _outcome(claims.require_pass_rate, gated), gated), ("pass_rate", "exact quotes", _outcome(claims.require_pass_rate, exact), exact),
            ("pass_rate", "no quotes", _outcome(claims.require_pass_rate, gated.limit(0)), gated.limit(0)),
            ("shrink", "one in fifty gone", _outcome(quality.guard_shrink, t.orders, t.orders.filter(key % 100 > 0)), t.orders),
            ("shrink", "one in ten gone", _outcome(quality.guard_shrink, t.orders, t.orders.filter(key % 10 > 0)), t.orders),
            ("edges", "all", _outcome(org.guard_edges, edges), edges), ("edges", "quoted", _outcome(org.guard_edges, edges.filter("n_quotes > 0")), edges.filter("n_quotes > 0"))]
    out = None
    for guard, given, outcome, df in told:
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(guard).alias("guard"), F.lit(given).alias("input"), F.lit(outcome).alias("outcome"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("table_round_trip", """SELECT CAST(doc_id AS VARCHAR) AS signal_id, 'nation_' || replace(source, 'src', '') AS account_id, md5(text) AS title, CAST(NULL AS VARCHAR) AS site_id, 2 AS n_people FROM documents""")
def table_round_trip(t):
    """A snapshot written and loaded again: the table's own columns alone, missing ones null; then its CSV form, read back typed."""
    d = signals(t).withColumn("named_people", F.array(F.lit("A B"), F.lit("C D"))).withColumn("other", F.lit(1))
    base = f"{scratch(t.spark)}/tables/{uuid.uuid4().hex}"
    tables.save(d, base + "/snapshot", "signals")
    tables.to_text(tables.load(t.spark, base + "/snapshot", "signals")).write.option("header", True).csv(base + "/csv")
    back = tables.load_csv(t.spark, base + "/csv", "signals")
    return back.select("signal_id", "account_id", "title", "site_id", F.size("named_people").alias("n_people"))


@query("table_partial_update", """SELECT CAST(o_orderkey AS VARCHAR) AS posting_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'late' ELSE o_orderstatus END AS url, round(o_totalprice) AS body_chars FROM orders""")
def table_partial_update(t):
    """S4 by parts: a table in buckets, of which one order in each hundred and then all urgent ones are written again."""
    path = f"{scratch(t.spark)}/tables/{uuid.uuid4().hex}"
    d = t.orders.select(F.col("o_orderkey").cast("string").alias("posting_id"), F.col("o_orderstatus").alias("url"), F.round("o_totalprice").cast("int").alias("body_chars"), "o_orderpriority")
    tables.save_changes(d.withColumn("url", F.lit("first")), path, "postings", "posting_id")
    tables.save_changes(d.filter("o_orderpriority != '1-URGENT'"), path, "postings", "posting_id")
    tables.save_changes(d.filter("o_orderpriority = '1-URGENT'").withColumn("url", F.lit("late")), path, "postings", "posting_id")
    return tables.load_parts(t.spark, path, "postings").select("posting_id", "url", F.col("body_chars").cast("double").alias("body_chars"))


@query("bodies_from_files", """SELECT s_name AS posting_id, s_name || chr(10) || 'from nation ' || s_nationkey || chr(10) AS text FROM supplier""")
def bodies_from_files(t):
    """A text file for each supplier, read as bodies."""
    path = f"{scratch(t.spark)}/bodies/{uuid.uuid4().hex}"
    lines = t.supplier.select(F.col("s_name").alias("posting_id"), F.concat(F.col("s_name"), F.lit("\n"), F.lit("from nation "), F.col("s_nationkey").cast("string")).alias("value"))
    # a number of tasks of its own, as small rows make many files; each task moves its files itself, so the driver does not rename them one by one
    tasks = 4 * t.spark.sparkContext.defaultParallelism
    lines.repartition(tasks, "posting_id").write.partitionBy("posting_id").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    return feeds.read_bodies(t.spark, path)


@query("run_ledger", """SELECT 'r1' AS run_id, count(*) AS urls_seen, count(*) FILTER (page_id % 3 = 0) AS new_urls FROM pages UNION ALL SELECT 'r2', NULL, NULL""")
def run_ledger(t):
    """Counters taken while the pages are written, appended to the ledger and loaded."""
    base = f"{scratch(t.spark)}/runs/{uuid.uuid4().hex}"
    d, seen = tables.counted(t.pages, f"pages-{uuid.uuid4().hex}", n=F.count(F.lit(1)), new=F.count_if(F.col("page_id") % 3 == 0))
    d.write.format("noop").mode("overwrite").save()
    tables.log_run(t.spark, base, {"run_id": "r1", "kind": "index", "urls_seen": seen.get["n"], "new_urls": seen.get["new"]})
    tables.log_run(t.spark, base, {"run_id": "r2"})
    return tables.load(t.spark, base, "runs").select("run_id", "urls_seen", "new_urls")


@query("enriched", """SELECT s_suppkey, first.c_custkey AS first_customer FROM supplier LEFT JOIN (SELECT c_nationkey, min(c_custkey) AS c_custkey FROM customer GROUP BY 1) AS first ON s_nationkey = c_nationkey""")
def enriched(t):
    """Suppliers with the first customer of their nation; a key that the dimension holds many times multiplies nothing."""
    dim = t.customer.select(F.col("c_nationkey").alias("s_nationkey"), F.col("c_custkey").alias("first_customer"))
    return resolve.enrich(t.supplier.select("s_suppkey", "s_nationkey"), dim, "s_nationkey", [F.col("first_customer").asc()]).select("s_suppkey", "first_customer")


@query("mix_pivot", with_(FACTS_SQL, MIX_SQL) + """SELECT account_id, dim_key, round(max(share) FILTER (period = '1996Q1'), 6) AS a, round(max(share) FILTER (period = '1996Q2'), 6) AS b FROM mix
  WHERE period IN ('1996Q1', '1996Q2') GROUP BY ALL""")
def mix_pivot(t):
    """A13 as one column per period."""
    two = rollup(t).filter(F.col("period").isin("1996Q1", "1996Q2"))
    d = mix.pivot_matrix(two, ["1996Q1", "1996Q2"])
    return d.select("account_id", "dim_key", F.round("1996Q1", 6).alias("a"), F.round("1996Q2", 6).alias("b"))
