"""Queries over gated answers: decision chains, reconciliation, scoring, agreement, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.gates import band, confidence, fit_from_verdict, gate, gate_choice, keyword_label
from attesta.operators import quality, rules, sampling, scoring, tallies, verdicts
from attesta.operators.parse import kw_hits
from attesta.plans import derive as dv
from attesta.plans.base import query
from attesta.plans.derive import sql_answers, sql_byte, sql_list, sql_pick, sql_spread, with_

CLOSED = "('closed', 'sold_or_divested', 'closure_announced')"


def _ask(q: str) -> str:
    return f"'REVIEW|{q}?|{q}'"


_CORE_UNSURE = "CASE " + " ".join(f"WHEN {q}_p > 0.2 THEN {_ask(q)}" for q in cfg.CORE_QUESTIONS) + " END"
_ANY = lambda op: "(" + " OR ".join(f"{q}_p {op}" for q in cfg.CORE_QUESTIONS) + ")"
CHAIN_SQL = f"""chained AS (SELECT *, CASE WHEN status IN {CLOSED} THEN status_conf ELSE 0 END AS closed, CASE WHEN status = 'planned_not_running' THEN status_conf ELSE 0 END AS planned FROM wide),
packed AS (SELECT *, CASE WHEN closed >= 0.8 THEN 'CLOSED|closed|' WHEN planned >= 0.8 THEN 'GAP|greenfield|' WHEN closed + planned > 0.2 THEN {_ask('status')}
  WHEN NOT {_ANY('>= 0.8')} THEN CASE WHEN {_ANY('> 0.2')} THEN {_CORE_UNSURE} WHEN support_p > 0.2 AND support_p < 0.8 THEN {_ask('support')} WHEN support_p >= 0.5 THEN 'DROP|support-only|'
    WHEN research_p > 0.2 AND research_p < 0.8 THEN {_ask('research')} WHEN research_p >= 0.5 THEN 'FLAG|R&D-only|' ELSE 'FLAG|unclear-mfg|' END
  WHEN business_conf < 0.8 THEN {_ask('business')} WHEN business IN ('diagnostics_or_devices', 'consumer_or_nutrition') THEN 'FLAG|non-core|'
  WHEN modality_conf < 0.8 THEN {_ask('modality')} WHEN modality = 'small_molecule_only' THEN 'FLAG|small-mol|' WHEN modality = 'mixed' THEN 'FLAG|mixed|'
  WHEN modality = 'not_stated' THEN {_ask('modality')} WHEN cdmo_p > 0.2 AND cdmo_p < 0.8 THEN {_ask('cdmo')} WHEN cdmo_p >= 0.5 THEN 'KEEP|CDMO|' ELSE 'KEEP||' END AS pk FROM chained),
verdicts AS (SELECT *, split_part(pk, '|', 1) AS verdict, split_part(pk, '|', 2) AS tag, split_part(pk, '|', 3) AS unsure_on,
  CASE WHEN lang = 'en' THEN 'US' ELSE 'EU' END AS region, {sql_pick(dv.VERDICTS, sql_byte("doc_id || '|map'") + ' % 4')} AS verdict_auto,
  CASE WHEN {sql_byte("doc_id || '|man'")} < 20 THEN 'Drop' ELSE '' END AS verdict_manual FROM packed),
labelled AS (SELECT *, CASE WHEN verdict_manual = 'Drop' THEN 'DROP' ELSE verdict_auto END AS map_verdict FROM verdicts),
policy AS (SELECT *, CASE WHEN (region = 'EU' AND map_verdict = 'KEEP' AND tag IN ('small-mol', 'mixed')) OR (map_verdict = 'DROP' AND tag = 'R&D-only') THEN 'FLAG' ELSE map_verdict END AS p0,
  CASE map_verdict WHEN 'KEEP' THEN 'yes' WHEN 'DROP' THEN 'no' ELSE 'soft' END AS icp_fit FROM labelled),
fit AS (SELECT *, CASE WHEN business = 'animal_health' AND business_conf >= 0.8 AND verdict = 'KEEP' AND p0 = 'FLAG' THEN 'KEEP' ELSE p0 END AS policy_verdict FROM policy)"""


def wide(t):
    return verdicts.wide_answers(dv.answers(t))


def judged(t):
    """Answers of each document with the spine columns a site would have."""
    b = lambda tag: dv.byte("item_id", F.lit(tag))
    spine = t.documents.select(F.col("doc_id").cast("string").alias("item_id"), F.when(F.col("lang") == "en", "US").otherwise("EU").alias("region"),
                               F.col("source").alias("account_id"), F.col("text").alias("functions"), F.col("source").alias("site"), F.col("lang").alias("modality_text"))
    d = verdicts.site_verdict(wide(t)).join(spine, "item_id")
    d = d.withColumn("verdict_auto", dv.pick(dv.VERDICTS, b("map") % 4)).withColumn("verdict_manual", F.when(b("man") < 20, "Drop").otherwise(""))
    fit = F.when(F.col("verdict_manual") == "Drop", "no").otherwise(F.when(F.col("verdict_auto") == "KEEP", "yes").when(F.col("verdict_auto") == "DROP", "no").otherwise("soft"))
    return d.withColumn("icp_fit", fit)


SITE = (sql_answers(), CHAIN_SQL)


@query("gate_verdict", with_(*SITE) + "SELECT item_id, verdict, tag, unsure_on FROM verdicts")
def gate_verdict(t):
    return verdicts.site_verdict(wide(t)).select("item_id", "verdict", "tag", "unsure_on")


@query("policy_labels", with_(*SITE) + """SELECT item_id, map_verdict, p0 AS policy_verdict, p0 <> map_verdict AS moved FROM policy""")
def policy_labels(t):
    d = verdicts.policy_labels(judged(t))
    return d.select("item_id", "map_verdict", "policy_verdict", (F.col("policy_reason") != "").alias("moved"))


@query("site_fit", with_(*SITE) + """SELECT item_id, verdict, policy_verdict, CASE WHEN verdict = 'REVIEW' THEN icp_fit WHEN verdict = 'CLOSED' THEN CASE WHEN map_verdict = 'DROP' THEN 'no' ELSE 'soft' END
    WHEN verdict = 'KEEP' THEN 'yes' WHEN verdict = 'DROP' THEN 'no' ELSE 'soft' END AS new_fit,
  verdict <> 'REVIEW' AND (verdict = policy_verdict OR (verdict = 'CLOSED' AND policy_verdict IN ('GAP', 'DROP'))) AS agree_verdict,
  CASE WHEN verdict <> 'KEEP' THEN tag ELSE concat_ws('+', CASE WHEN pd_msat_p >= 0.8 THEN 'PD' END, CASE WHEN drug_substance_p >= 0.8 THEN 'DS' END, CASE WHEN drug_product_p >= 0.8 THEN 'DP' END)
    || CASE WHEN pd_msat_p < 0.8 AND drug_substance_p < 0.8 AND drug_product_p < 0.8 AND manufacturing_p >= 0.8 THEN 'MFG' ELSE '' END || ' biologics' || CASE WHEN tag = 'CDMO' THEN ' · CDMO' ELSE '' END END AS reason_tag,
  length(text) <= 40 AS short_text,
  'development=' || (CASE WHEN pd_msat_p >= 0.8 THEN 'yes' WHEN pd_msat_p <= 0.2 THEN 'no' ELSE 'open' END) AS pd_part FROM fit""")
def site_fit(t):
    d = verdicts.site_fit(judged(t))
    return d.select("item_id", "verdict", "policy_verdict", "new_fit", "agree_verdict", "reason_tag", "short_text", F.split_part("explanation", F.lit(" | "), F.lit(1)).alias("pd_part"))


@query("gated_values", with_(sql_answers()) + """SELECT item_id, CASE WHEN support_p >= 0.8 THEN 'yes' WHEN support_p <= 0.2 THEN 'no' ELSE 'unsure' END AS support,
  CASE WHEN modality_conf >= 0.8 THEN modality ELSE 'unsure' END AS modality FROM wide""")
def gated_values(t):
    return wide(t).select("item_id", gate("support_p").alias("support"), gate_choice("modality", "modality_conf").alias("modality"))


@query("keyword_labels", """SELECT doc_id, CASE WHEN s AND b THEN 'mixed' WHEN s THEN 'small_molecule_only' WHEN b THEN 'biologic_only' ELSE 'not_stated' END AS label FROM
  (SELECT doc_id, regexp_matches(text, '(?i)tion') AS s, regexp_matches(text, '(?i)\\band\\b') AS b FROM documents)""")
def keyword_labels(t):
    return t.documents.select("doc_id", keyword_label("text", r"(?i)tion", r"(?i)\band\b").alias("label"))


@query("verdict_fit", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'yes' WHEN o_orderstatus = 'O' THEN 'no' ELSE 'soft' END AS fit FROM orders""")
def verdict_fit(t):
    said = F.when(F.col("o_orderstatus") == "F", " Keep - x").when(F.col("o_orderstatus") == "O", "DROP").otherwise("gap?")
    return t.orders.select("o_orderkey", fit_from_verdict(said).alias("fit"))


@query("evidence_confidence", """SELECT o_custkey, CASE WHEN n >= 3 OR (n >= 2 AND t >= 2) THEN 'high' WHEN n >= 2 OR t >= 1 THEN 'medium' ELSE 'low' END AS level,
  n || CASE WHEN n = 1 THEN ' posting, ' ELSE ' postings, ' END || q || CASE WHEN q = 1 THEN ' verified quote' ELSE ' verified quotes' END AS basis
  FROM (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS t, count(DISTINCT o_orderpriority) AS q FROM orders GROUP BY 1)""")
def evidence_confidence(t):
    d = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("t"), F.count_distinct("o_orderpriority").alias("q"))
    c = confidence("n", "t", "q")
    return d.select("o_custkey", c["level"].alias("level"), c["basis"].alias("basis"))


# ---------------------------------------------------------------- profiles
PROFILE_QUESTIONS = [(f"{k}_{key}", "noul", []) for k, key, _ in cfg.PROFILE_LABELS]
PROFILE_SQL = sql_answers(PROFILE_QUESTIONS, "prof")


def profile(t):
    w = verdicts.wide_answers(dv.answers(t, PROFILE_QUESTIONS), PROFILE_QUESTIONS)
    d = w.join(t.documents.select(F.col("doc_id").cast("string").alias("item_id"), F.col("source").alias("account_id"), "text"), "item_id")
    return verdicts.site_profile(d, text="text")


def _chips(kind: str, want: str) -> str:
    test = ">= 0.8" if want == "yes" else "BETWEEN 0.21 AND 0.79"
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {k}_{key}_p {test} THEN '{name}' END" for k, key, name in cfg.PROFILE_LABELS if k == kind) + ")"


@query("site_profile", with_(PROFILE_SQL) + f"""SELECT item_id, {_chips('fn', 'yes')} AS function_chips, {_chips('fn', 'unsure')} AS function_unsure,
  {_chips('mod', 'yes')} AS modality_chips, {_chips('mod', 'unsure')} AS modality_unsure FROM prof""")
def site_profile(t):
    d = profile(t)
    return d.select("item_id", *[F.array_join(c, "|").alias(c) for c in ("function_chips", "function_unsure", "modality_chips", "modality_unsure")])


@query("account_profile", with_(PROFILE_SQL) + " UNION ALL ".join(
    f"SELECT source AS account_id, '{k}' AS kind, '{key}' AS label, count(*) FILTER ({k}_{key}_p >= 0.8) AS n_yes, count(*) FILTER ({k}_{key}_p BETWEEN 0.21 AND 0.79) AS n_unsure FROM prof GROUP BY 1"
    for k, key, _ in cfg.PROFILE_LABELS))
def account_profile(t):
    return tallies.account_profile(profile(t)).drop("name")


@query("account_footprint", with_(PROFILE_SQL) + ", c AS (" + " UNION ALL ".join(
    f"SELECT source AS account_id, '{k}' AS kind, '{name}' AS name, count(*) FILTER ({k}_{key}_p >= 0.8) AS n FROM prof GROUP BY 1" for k, key, name in cfg.PROFILE_LABELS)
    + ") SELECT account_id, kind, string_agg(name || ':' || n, '|' ORDER BY n DESC, name) AS footprint FROM c WHERE n > 0 GROUP BY 1, 2")
def account_footprint(t):
    return tallies.footprints(tallies.account_profile(profile(t)))


# ---------------------------------------------------------------- reconciliation
FIT_SQL = """site_fit AS (SELECT item_id AS site_id, source AS account_id, policy_verdict, verdict AS model_verdict, CASE WHEN verdict = 'KEEP' THEN 'kept' ELSE tag END AS reason_tag, unsure_on FROM fit)"""


def fit_rows(t):
    d = verdicts.site_fit(judged(t))
    return d.select(F.col("item_id").alias("site_id"), "account_id", "policy_verdict", F.col("verdict").alias("model_verdict"),
                    F.when(F.col("verdict") == "KEEP", "kept").otherwise(F.col("tag")).alias("reason_tag"), "unsure_on")


_SAME = "({a} = {b} OR ({a} IN ('CLOSED', 'GAP', 'DROP') AND {b} IN ('CLOSED', 'GAP', 'DROP')))"


@query("check_merge", with_(*SITE, FIT_SQL) + f""", v AS (SELECT site_id, CASE {sql_byte("site_id || '|o'")} % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'contradicted' ELSE 'source too thin' END AS outcome FROM site_fit),
dec AS (SELECT site_id, {sql_pick(['KEEP', 'FLAG', 'CLOSED', 'NEEDS_PERSON'], sql_byte("site_id || '|d'") + ' % 4')} AS decision FROM site_fit JOIN v USING (site_id) WHERE outcome <> 'confirmed'),
m AS (SELECT f.*, v.outcome, decision, {sql_byte("f.site_id || '|a'")} < 180 AS agree FROM site_fit f JOIN v USING (site_id) LEFT JOIN dec USING (site_id)),
x AS (SELECT *, CASE WHEN decision IS NOT NULL AND agree THEN decision WHEN decision IS NULL AND outcome = 'confirmed' THEN policy_verdict ELSE 'NEEDS_PERSON' END AS final_verdict FROM m)
SELECT site_id, final_verdict, CASE WHEN final_verdict = 'NEEDS_PERSON' THEN 'person needed' WHEN decision IS NULL THEN 'confirmed by source'
  WHEN {_SAME.format(a='policy_verdict', b='final_verdict')} THEN 'confirmed on review' ELSE 'corrected' END AS how,
  CASE WHEN final_verdict = 'NEEDS_PERSON' THEN NULL ELSE {_SAME.format(a='policy_verdict', b='final_verdict')} END AS map_right,
  CASE WHEN final_verdict = 'NEEDS_PERSON' OR model_verdict = 'REVIEW' THEN NULL ELSE {_SAME.format(a='model_verdict', b='final_verdict')} END AS model_right FROM x""")
def check_merge(t):
    return merged_check(t).select("site_id", "final_verdict", "how", "map_right", "model_right")


def merged_check(t):
    f = fit_rows(t)
    b = lambda tag: dv.byte("site_id", F.lit(tag))
    verification = f.select("site_id", F.when(b("o") % 3 == 0, "confirmed").when(b("o") % 3 == 1, "contradicted").otherwise("source too thin").alias("outcome"), F.lit("u").alias("best_url"))
    decisions = f.join(verification.filter("outcome <> 'confirmed'"), "site_id", "left_semi").select("site_id", dv.pick(["KEEP", "FLAG", "CLOSED", "NEEDS_PERSON"], b("d") % 4).alias("decision"), F.lit("why").alias("decision_reason"))
    checks = f.select("site_id", (b("a") < 180).alias("agree"))
    return verdicts.check_merge(verification, f, decisions, checks)


FINAL_SQL = f"""runs AS (SELECT site_id, CAST(substr(site_id, 1, 1) AS INT) % 3 + r AS run, {sql_pick(['KEEP', 'FLAG', 'DROP', 'NEEDS_PERSON'], sql_byte("site_id || '|r' || r") + ' % 4')} AS v,
  CASE WHEN r = 1 THEN 'animal health only' ELSE 'animal, small molecule' END AS reason FROM site_fit, (SELECT unnest([1, 2]) AS r) WHERE policy_verdict <> model_verdict AND (r = 1 OR model_verdict <> 'REVIEW')),
last AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY run DESC) = 1),
final AS (SELECT f.site_id, f.account_id, CASE WHEN v = 'NEEDS_PERSON' THEN 'REVIEW' WHEN v = 'FLAG' AND reason = 'animal health only' THEN 'KEEP' WHEN v IS NOT NULL THEN v
    WHEN model_verdict <> 'REVIEW' AND {_SAME.format(a='policy_verdict', b='model_verdict')} THEN policy_verdict ELSE 'REVIEW' END AS verdict,
  CASE WHEN v = 'NEEDS_PERSON' THEN 'needs person' WHEN v IS NOT NULL THEN 'checked' WHEN model_verdict <> 'REVIEW' AND {_SAME.format(a='policy_verdict', b='model_verdict')} THEN 'readings agree' ELSE 'not checked' END AS basis,
  CASE WHEN v = 'NEEDS_PERSON' THEN 'sources conflict' WHEN v = 'FLAG' AND reason = 'animal health only' THEN reason || ' (animal health is KEEP)' WHEN v IS NOT NULL THEN reason
    WHEN model_verdict <> 'REVIEW' AND {_SAME.format(a='policy_verdict', b='model_verdict')} THEN reason_tag WHEN unsure_on <> '' THEN unsure_on ELSE 'readings disagree' END AS reason
  FROM site_fit f LEFT JOIN last USING (site_id))"""


@query("final_verdict", with_(*SITE, FIT_SQL, FINAL_SQL) + "SELECT site_id, verdict, basis, reason FROM final")
def final_verdict(t):
    return final_rows(t).select("site_id", "verdict", "basis", "reason")


def final_rows(t):
    f = fit_rows(t)
    # a run checks where the readings differ; the second one only where the model decided
    differ = f.filter(F.col("policy_verdict") != F.col("model_verdict"))
    r = differ.select("site_id", "model_verdict", F.explode(F.array(F.lit(1), F.lit(2))).alias("r")).filter("r = 1 OR model_verdict <> 'REVIEW'")
    key = lambda tag: dv.byte("site_id", F.concat(F.lit(tag), F.col("r").cast("string")))
    runs = r.select(
        "site_id", (F.substring("site_id", 1, 1).cast("int") % 3 + F.col("r")).alias("run"), dv.pick(["KEEP", "FLAG", "DROP", "NEEDS_PERSON"], key("r") % 4).alias("final_verdict"),
        F.when(F.col("r") == 1, "animal health only").otherwise("animal, small molecule").alias("reason"), F.lit("u").alias("source_url"))
    return verdicts.final_verdict(f, runs)


SOURCE_QUESTIONS = [(f"s_{q}", kind, opts) for q, kind, opts in cfg.SITE_QUESTIONS]
_STATED = [*cfg.CORE_QUESTIONS, "support", "research", "cdmo"]


def _gated(q: str) -> str:
    return f"CASE WHEN {q}_p >= 0.8 THEN 'yes' WHEN {q}_p <= 0.2 THEN 'no' ELSE 'unsure' END"


@query("source_claims", with_(sql_answers(), sql_answers(SOURCE_QUESTIONS, "src")) + f""", j AS (SELECT w.item_id, w.* EXCLUDE (item_id, doc_id, lang, source, text, n_chars), s.* EXCLUDE (item_id, doc_id, lang, source, text, n_chars),
  CASE WHEN s_status IN {CLOSED} THEN s_status_conf ELSE 0 END AS sc, CASE WHEN s_status = 'planned_not_running' THEN s_status_conf ELSE 0 END AS sp,
  CASE WHEN s_status = 'operating' THEN s_status_conf ELSE 0 END AS so, CASE WHEN status IN {CLOSED} THEN status_conf ELSE 0 END AS c, CASE WHEN status = 'planned_not_running' THEN status_conf ELSE 0 END AS p,
  CASE WHEN modality_conf >= 0.8 THEN modality ELSE 'unsure' END AS mg FROM wide w JOIN src s USING (item_id)),
k AS (SELECT item_id, concat_ws('|', CASE WHEN sc >= 0.8 AND c >= 0.5 THEN 'closed/sold' END, CASE WHEN sc < 0.8 AND sp >= 0.8 AND p >= 0.5 THEN 'planned' END,
  {', '.join(f"CASE WHEN s_{q}_p >= 0.8 AND {_gated(q)} <> 'no' THEN '{q}' END" for q in _STATED)},
  CASE WHEN s_modality_conf >= 0.8 AND s_modality <> 'not_stated' AND (s_modality = mg OR (mg IN ('biologic_only', 'small_molecule_only', 'mixed') AND 'mixed' IN (s_modality, mg))) THEN 'modality:' || s_modality END) AS supports,
 concat_ws('|', CASE WHEN sc >= 0.8 AND c < 0.5 THEN 'closed/sold' END, CASE WHEN sc < 0.8 AND sp >= 0.8 AND p < 0.5 THEN 'planned' END, CASE WHEN sc < 0.8 AND sp < 0.8 AND so >= 0.8 AND c >= 0.8 THEN 'operating' END,
  {', '.join(f"CASE WHEN s_{q}_p >= 0.8 AND {_gated(q)} = 'no' THEN '{q}' END" for q in _STATED)},
  CASE WHEN s_modality_conf >= 0.8 AND s_modality <> 'not_stated' AND s_modality <> mg AND mg IN ('biologic_only', 'small_molecule_only', 'mixed') AND NOT ('mixed' IN (s_modality, mg)) THEN 'modality:' || s_modality END) AS conflicts FROM j)
SELECT k.item_id, supports, conflicts, CASE WHEN CAST(k.item_id AS INT) % 5 = 0 THEN 'no verified evidence' WHEN support_p <= 0.2 THEN 'source not about this site' WHEN conflicts <> '' THEN 'contradicted'
  WHEN supports <> '' THEN 'confirmed' ELSE 'source too thin' END AS outcome FROM k JOIN wide USING (item_id)""")
def source_claims(t):
    """A second set of answers per document plays the source; the first one is the summary."""
    src = verdicts.wide_answers(dv.answers(t, SOURCE_QUESTIONS), SOURCE_QUESTIONS)
    src = (src.withColumn("s_status_p_closed", verdicts.mass("s_status_probs", cfg.CLOSED_STATES))
           .withColumn("s_status_p_planned", verdicts.mass("s_status_probs", ["planned_not_running"])).withColumn("s_status_p_operating", verdicts.mass("s_status_probs", ["operating"])))
    own = verdicts.site_verdict(wide(t))
    for q in _STATED:
        own = own.withColumn(f"{q}_gated", gate(f"{q}_p"))
    d = verdicts.claims(own.withColumn("modality_gated", gate_choice("modality", "modality_conf")).join(src, "item_id"))
    d = d.withColumn("n_excerpts", F.when(F.col("item_id").cast("int") % 5 == 0, 0).otherwise(1))
    return d.select("item_id", F.array_join("supports", "|").alias("supports"), F.array_join("conflicts", "|").alias("conflicts"),
                    verdicts.evidence_outcome("n_excerpts", "support_p", "supports", "conflicts").alias("outcome"))


NEWS_ASKED = [*cfg.NEWS_QUESTIONS, ("site", "choice", ["s1", "s2", "s3", "company_wide"])]
_TRIGGER = "CASE " + " ".join(f"WHEN {k}_p >= 0.8 THEN '{name}'" for k, name in cfg.NEWS_TRIGGERS) + " ELSE '' END"
NEWS_SQL = sql_answers(NEWS_ASKED, "asked") + f""", news AS (SELECT item_id, doc_id, source, {_TRIGGER} AS trigger, about_company_p >= 0.8 AND ops_p >= 0.8 AND {_TRIGGER} <> '' AS keep,
  CASE WHEN site_conf >= 0.8 AND site <> 'company_wide' THEN site END AS label_site, DATE '2025-01-01' + CAST(doc_id % 300 AS INT) AS published FROM asked)"""


def news(t):
    w = verdicts.wide_answers(dv.answers(t, NEWS_ASKED), NEWS_ASKED).join(
        t.documents.select(F.col("doc_id").cast("string").alias("item_id"), "doc_id", F.col("source").alias("account_id"), F.col("text").alias("title")), "item_id")
    d = w.withColumn("published", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("doc_id") % 300).cast("int")))
    d = d.withColumn("source", F.col("account_id")).withColumn("url", F.concat(F.lit("https://n.example/"), "item_id"))
    return verdicts.news_label(d)


@query("news_label", with_(NEWS_SQL) + "SELECT item_id, trigger, keep, coalesce(label_site, '') AS label_site FROM news")
def news_label(t):
    return news(t).select("item_id", "trigger", "keep", F.coalesce("label_site", F.lit("")).alias("label_site"))


@query("news_rollup", with_(NEWS_SQL) + """, k AS (SELECT * FROM news WHERE keep), c AS (SELECT source AS account_id, trigger, count(*) AS n FROM k GROUP BY 1, 2),
g AS (SELECT account_id, CAST(sum(n) AS BIGINT) AS n_items, string_agg(trigger || ':' || n, '|' ORDER BY n DESC, trigger) AS triggers FROM c GROUP BY 1),
f AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY published DESC, item_id) AS rn FROM k)
SELECT g.*, CAST(published AS VARCHAR) AS latest_date, trigger AS latest_trigger FROM g JOIN f ON f.source = g.account_id AND rn = 1""")
def news_rollup(t):
    d = tallies.news_rollup(news(t).withColumn("title", F.col("item_id")), "account_id")
    return d.select("account_id", "n_items", "triggers", F.col("latest_date").cast("string").alias("latest_date"), "latest_trigger")


@query("newest_items", with_(NEWS_SQL) + "SELECT source AS account_id, row_number() OVER (PARTITION BY source ORDER BY published DESC, item_id) AS rn, item_id, trigger FROM news WHERE keep")
def newest_items(t):
    return tallies.newest_items(news(t), "account_id").select("account_id", "rn", "item_id", "trigger")


# ---------------------------------------------------------------- scoring
@query("question_bank", f"""SELECT item_id, q.question, q.kind, q.n FROM (SELECT CAST(doc_id AS VARCHAR) AS item_id, unnest([
  {', '.join("{'question': '" + q + "', 'kind': '" + k + "', 'n': " + str(len(o)) + "}" for q, k, o in cfg.SITE_QUESTIONS)}]) AS q FROM documents)
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'site', 'choice', 0 FROM documents WHERE source IN (SELECT 'src' || s_nationkey FROM supplier)""")
def question_bank(t):
    """The site questions for every document, and a choice over the sites of the document's account."""
    d, _ = site_bank(t)
    return d.select("item_id", "question", "kind", F.size("options").cast("long").alias("n"))


def site_bank(t):
    items = t.documents.select(F.col("doc_id").cast("string").alias("item_id"), F.col("source").alias("account_id"))
    options = t.supplier.select(F.concat(F.lit("src"), F.col("s_nationkey").cast("string")).alias("account_id"), F.col("s_suppkey").cast("string").alias("option_id"))
    return scoring.question_bank(items, cfg.SITE_QUESTIONS, options), options


@query("request_options", """WITH a AS (SELECT DISTINCT source FROM documents), s AS (SELECT 'src' || s_nationkey AS source, CAST(s_suppkey AS VARCHAR) AS option FROM supplier)
SELECT source AS option_set, option FROM s JOIN a USING (source) UNION SELECT source, 'company_wide' FROM s JOIN a USING (source)""")
def request_options(t):
    """The options of each account's site question, joined when it is scored: once per distinct request."""
    bank, options = site_bank(t)
    return scoring.with_options(scoring.requests(bank, ["account_id"]), options).select("option_set", "option")


def title_requests(t):
    """Every order's title, asked for two questions; equal titles share a request."""
    items = dv.postings(t).select(F.col("posting_id").alias("item_id"), "role_title", "account_id")
    return scoring.requests(scoring.question_bank(items, cfg.TITLE_QUESTIONS[1:3]), ["role_title", "account_id"])


@query("scoring_cache", with_(dv.POSTINGS_SQL) + r"""SELECT posting_id AS item_id, q AS question, CASE WHEN account_id = 'nation_1' THEN 0.5e0
  WHEN q = 'digital_data_it' AND regexp_matches(role_title, 'data|software') THEN 0.95e0 WHEN q = 'bioprocess_core' AND regexp_matches(role_title, 'process') THEN 0.95e0 ELSE 0.05e0 END AS p
FROM postings, (SELECT unnest(['digital_data_it', 'bioprocess_core']) AS q)""")
def scoring_cache(t):
    """Cached answers of one account stand; all other distinct requests go to the rule scorer once."""
    reqs = title_requests(t)
    nul = lambda kind: F.lit(None).cast(kind)
    cache = reqs.filter(F.col("account_id") == "nation_1").dropDuplicates(["request_hash"]).select(
        "request_hash", F.lit(0.5).alias("p"), nul("string").alias("choice"), nul("double").alias("confidence"), nul("map<string,double>").alias("probs"))
    scorer = scoring.rule_scorer("role_title", {"digital_data_it": "data|software", "bioprocess_core": "process"})
    out, _ = scoring.score(reqs, cache, scorer)
    return out.select("item_id", "question", F.round("p", 6).alias("p"))


@query("budget_gate", with_(dv.POSTINGS_SQL) + """, r AS (SELECT DISTINCT role_title, account_id, q FROM postings, (SELECT unnest(['a', 'b']) AS q))
SELECT count(*) AS n_requests, count(*) FILTER (account_id = 'nation_1') AS n_cached, count(*) FILTER (account_id <> 'nation_1') AS n_new, round(avg(length(role_title)), 6) AS mean_tokens,
  round(count(*) FILTER (account_id <> 'nation_1') * avg(length(role_title)) * 0.0001e0, 6) AS projected, count(*) FILTER (account_id <> 'nation_1') * avg(length(role_title)) * 0.0001e0 < 1 AS allowed FROM r""")
def budget_gate(t):
    reqs = title_requests(t).withColumn("tokens", F.length("role_title"))
    cache = reqs.filter(F.col("account_id") == "nation_1").select("request_hash").distinct()
    d = scoring.budget_gate(reqs, cache, "tokens", 0.0001, 1.0)
    return d.withColumn("mean_tokens", F.round("mean_tokens", 6)).withColumn("projected", F.round("projected", 6))


@query("relevance_bands", f"""SELECT doc_id, CASE WHEN {sql_byte("doc_id || '|conf'")} < 60 THEN 'unsure' ELSE {sql_list(cfg.RELEVANCE_BANDS)}[1 + {sql_byte("doc_id || '|band'")} % 4] END AS relevance_band FROM documents""")
def relevance_bands(t):
    top = (dv.byte(F.col("doc_id").cast("string"), F.lit("band")) % 4).cast("string")
    probs = F.map_from_arrays(F.array(top, F.lit("9")), F.array(F.lit(0.7), F.lit(0.1)))
    conf = F.when(dv.byte(F.col("doc_id").cast("string"), F.lit("conf")) < 60, 0.4).otherwise(0.9)
    return t.documents.select("doc_id", band(probs, conf).alias("relevance_band"))


# ---------------------------------------------------------------- publications
PUBS_SQL = f"""pubs AS (SELECT d.doc_id, d.source AS account_id, d.text AS title, d.n_chars % 30 AS year, coalesce(l.quality, 0) + {sql_spread("d.doc_id || '|score'")} AS score,
  CASE WHEN {sql_byte("d.doc_id || '|rc'")} < 170 THEN 0.9e0 ELSE 0.4e0 END AS conf, {sql_spread("d.doc_id || '|pd'")} AS pd, CASE WHEN l.quality = 1 THEN 'high' WHEN l.quality = 0 THEN 'low' ELSE 'medium' END AS source_confidence,
  CASE WHEN {sql_byte("d.doc_id || '|rc'")} >= 170 THEN 'unsure' ELSE {sql_list(cfg.RELEVANCE_BANDS)}[1 + {sql_byte("d.doc_id || '|band'")} % 4] END AS relevance_band
  FROM documents d LEFT JOIN labels l USING (doc_id)),
kept AS (SELECT *, score >= 1.5 AND conf >= 0.6 AS keep, CASE WHEN pd >= 0.8 THEN 'yes' WHEN pd <= 0.2 THEN 'no' ELSE 'unsure' END AS process_data FROM pubs)"""


def publications(t):
    k = F.col("doc_id").cast("string")
    b = lambda tag: dv.byte(k, F.lit(tag))
    d = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    conf = F.when(b("rc") < 170, 0.9).otherwise(0.4)
    levels = F.array(*[F.lit(x) for x in cfg.RELEVANCE_BANDS])
    return d.select(k.alias("signal_id"), F.col("source").alias("account_id"), F.col("text").alias("title"), (F.col("n_chars") % 30).alias("year"),
                    (F.coalesce("quality", F.lit(0)) + dv.spread(b("score"))).alias("relevance_score"), conf.alias("relevance_conf"),
                    dv.spread(b("pd")).alias("process_data_p"), F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").otherwise("medium").alias("source_confidence"),
                    F.when(b("rc") >= 170, "unsure").otherwise(F.get(levels, b("band") % 4)).alias("relevance_band"))


def ranked_publications(t):
    return tallies.rank_publications(publications(t)).withColumn("process_data", gate("process_data_p"))


@query("rank_publications", with_(PUBS_SQL) + """SELECT CAST(doc_id AS VARCHAR) AS signal_id, account_id, keep, row_number() OVER (PARTITION BY account_id ORDER BY keep DESC, score DESC, pd DESC, year DESC, CAST(doc_id AS VARCHAR)) AS rank_in_account FROM kept""")
def rank_publications(t):
    return ranked_publications(t).select("signal_id", "account_id", "keep", "rank_in_account")


@query("publication_rollup", with_(PUBS_SQL) + f"""SELECT account_id, count(*) AS n, count(*) FILTER (keep) AS kept, {', '.join(f"count(*) FILTER (relevance_band = '{b}') AS band_{b}" for b in cfg.RELEVANCE_BANDS + ['unsure'])},
  count(*) FILTER (process_data = 'yes') AS process_data_yes, count(*) FILTER (source_confidence = 'low') AS source_low, count(*) FILTER (source_confidence = 'low' AND NOT keep) AS source_low_below_bar FROM kept GROUP BY 1""")
def publication_rollup(t):
    return tallies.publication_rollup(ranked_publications(t))


@query("publication_agreement", with_(PUBS_SQL) + r""", k AS (SELECT *, regexp_matches(title, '(?i)\b(process|bioprocess|upstream|downstream|cell culture|fed-batch|perfusion|bioreactor|chromatograph\w*|purification|harvest|clarification|scale[- ]?up|tech(nology)? transfer|manufactur\w*|titer|viral clearance|filtration|CHO)\b') AS kw FROM kept)
SELECT 'keep_vs_source_confidence' AS measure, count(*) FILTER (source_confidence IN ('high', 'low')) AS n, count(*) FILTER (source_confidence IN ('high', 'low') AND keep = (source_confidence = 'high')) AS agree FROM k
UNION ALL SELECT 'process_band_vs_keyword', count(*) FILTER (relevance_band <> 'unsure'), count(*) FILTER (relevance_band <> 'unsure' AND (relevance_band = 'process') = kw) FROM k
UNION ALL SELECT 'process_data_vs_keyword', count(*) FILTER (process_data <> 'unsure'), count(*) FILTER (process_data <> 'unsure' AND (process_data = 'yes') = kw) FROM k""")
def publication_agreement(t):
    d = publications(t).withColumn("keep", (F.col("relevance_score") >= cfg.KEEP_SCORE) & (F.col("relevance_conf") >= cfg.KEEP_CONFIDENCE))
    return quality.publication_agreement(d.withColumn("process_data", gate("process_data_p")))


# ---------------------------------------------------------------- agreement, samples
RULE_HIT = r"(?i)\b(and|the)\b"
AGREE_SQL = r"""a AS (SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic, regexp_matches(d.text, '(?i)\b(and|the)\b') AS hit FROM documents d JOIN labels l USING (doc_id))"""


def labelled(t):
    d = t.documents.join(t.labels, "doc_id")
    return d.select("doc_id", "lang", "n_chars", "quality", "toxic", F.col("text").rlike(RULE_HIT).alias("hit"))


@query("confusion", with_(AGREE_SQL) + "SELECT CAST(quality AS VARCHAR) AS gold, CASE WHEN hit THEN 'hit' ELSE 'miss' END AS pred, count(*) AS n FROM a GROUP BY 1, 2")
def confusion(t):
    d = labelled(t).select(F.col("quality").cast("string").alias("g"), F.when(F.col("hit"), "hit").otherwise("miss").alias("p"))
    return quality.confusion(d, "g", "p")


@query("confusion_matrix", with_(AGREE_SQL) + "SELECT CAST(quality AS VARCHAR) AS gold, count(*) FILTER (hit) AS hit, count(*) FILTER (NOT hit) AS miss FROM a GROUP BY 1")
def confusion_matrix(t):
    d = labelled(t).select(F.col("quality").cast("string").alias("g"), F.when(F.col("hit"), "hit").otherwise("miss").alias("p"))
    return quality.confusion_matrix(d, "g", "p", ["hit", "miss"])


@query("slice_agreement", with_(AGREE_SQL) + """SELECT 'English' AS slice, count(*) AS n, count(*) FILTER (toxic = 0) AS decided, count(*) FILTER (toxic = 0 AND hit = (quality = 1)) AS agree FROM a WHERE lang = 'en'
  UNION ALL SELECT 'short', count(*), count(*) FILTER (toxic = 0), count(*) FILTER (toxic = 0 AND hit = (quality = 1)) FROM a WHERE n_chars <= 400""")
def slice_agreement(t):
    return quality.slice_agreement(labelled(t), F.col("toxic") == 0, F.col("hit") == (F.col("quality") == 1), {"English": F.col("lang") == "en", "short": F.col("n_chars") <= 400})


@query("agreement", r"""WITH s AS (SELECT doc_id, """ + f"""CASE WHEN {sql_spread("doc_id || '|kw'")} >= 0.8 THEN 'yes' WHEN {sql_spread("doc_id || '|kw'")} <= 0.2 THEN 'no' ELSE 'unsure' END AS state, """ + r"""
  regexp_matches(lower(text), '\band\b') AS hit FROM documents)
SELECT 'and_word' AS label, count(*) FILTER (state <> 'unsure') AS decided, count(*) FILTER (state = 'yes') AS n_yes, count(*) FILTER (state = 'unsure') AS unsure, count(*) FILTER (hit) AS kw_hit,
  count(*) FILTER (state <> 'unsure' AND (state = 'yes') = hit) AS agree, count(*) FILTER (state = 'yes' AND NOT hit) AS yes_kw_absent, count(*) FILTER (state = 'no' AND hit) AS no_kw_present FROM s""")
def agreement(t):
    labels, hits = keyword_states(t)
    return quality.agreement_table(labels, hits, "doc_id").drop("negated", "lineage_only", "other", "agree_pct")


def keyword_states(t):
    labels = t.documents.select("doc_id", F.lit("and_word").alias("label"), gate(dv.spread(dv.byte(F.col("doc_id").cast("string"), F.lit("kw")))).alias("state"))
    return labels, kw_hits(t.documents, "doc_id", ["text"], [("and_word", r"\band\b")])


@query("disagreements", r"""WITH s AS (SELECT doc_id, """ + f"""CASE WHEN {sql_spread("doc_id || '|kw'")} >= 0.8 THEN 'yes' WHEN {sql_spread("doc_id || '|kw'")} <= 0.2 THEN 'no' ELSE 'unsure' END AS state, """ + r"""
  regexp_matches(lower(text), '\band\b') AS hit FROM documents)
SELECT doc_id, CASE WHEN hit THEN 'no_kw_present' ELSE 'yes_kw_absent' END AS direction FROM s WHERE state <> 'unsure' AND (state = 'yes') <> hit""")
def disagreements(t):
    labels, hits = keyword_states(t)
    return quality.disagreements(labels, hits, "doc_id").select("doc_id", "direction")


@query("label_agreement", with_(dv.POSTINGS_SQL, dv.CLASSIFIED_SQL) + f""", p AS (SELECT job_family AS g, {sql_list(cfg.FAMILY_NAMES + ['other'])}[1 + {sql_byte("posting_id || '|jf'")} % 8] AS f, {sql_byte("posting_id || '|jc'")} < 180 AS sure FROM classified WHERE job_family <> '')
SELECT g AS label, count(*) AS n, count(*) FILTER (f = g) AS top_agree, count(*) FILTER (sure) AS decided, count(*) FILTER (sure AND f = g) AS agree FROM p GROUP BY 1
UNION ALL SELECT 'ALL', count(*), count(*) FILTER (f = g), count(*) FILTER (sure), count(*) FILTER (sure AND f = g) FROM p""")
def label_agreement(t):
    return quality.label_agreement(asked_titles(t), "rule_family")


def asked_titles(t):
    d = rules.classify(dv.postings(t)).filter(F.col("job_family") != "")
    return d.select("posting_id", F.col("job_family").alias("rule_family"), "seniority_rule", dv.pick(cfg.FAMILY_NAMES + ["other"], dv.byte("posting_id", F.lit("jf")) % 8).alias("job_family"),
                    F.when(dv.byte("posting_id", F.lit("jc")) < 180, 0.9).otherwise(0.4).alias("job_family_conf"), gate(dv.spread(dv.byte("posting_id", F.lit("dg")))).alias("digital"))


@query("noul_agreement", with_(dv.POSTINGS_SQL, dv.CLASSIFIED_SQL) + f""", p AS (SELECT job_family AS g, {sql_spread("posting_id || '|dg'")} AS p FROM classified WHERE job_family <> '')
SELECT count(*) AS n, count(*) FILTER (p >= 0.8 OR p <= 0.2) AS decided, count(*) FILTER ((p >= 0.8 OR p <= 0.2) AND (p >= 0.8) = (g IN {tuple(cfg.CORE_FAMILIES)})) AS agree FROM p""")
def noul_agreement(t):
    return quality.noul_agreement(asked_titles(t), "rule_family", "digital", cfg.CORE_FAMILIES)


@query("seniority_gold", with_(dv.POSTINGS_SQL, dv.CLASSIFIED_SQL) + """SELECT CASE seniority_rule WHEN 'senior' THEN 'individual_contributor' WHEN 'director' THEN 'director_head' WHEN 'principal' THEN 'individual_contributor'
  WHEN 'vp' THEN 'executive_vp' WHEN 'staff' THEN 'individual_contributor' WHEN 'head-of' THEN 'director_head' WHEN 'associate-director' THEN 'director_head' ELSE '' END AS band, count(*) AS n FROM classified GROUP BY 1""")
def seniority_gold(t):
    d = rules.classify(dv.postings(t))
    return d.groupBy(F.coalesce(quality.seniority_gold("seniority_rule"), F.lit("")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("field_agreement", """SELECT 'lang' AS field, count(*) AS n, count(*) FILTER (lang = 'en') AS agree, count(*) FILTER (n_chars >= 900) AS n_sure, count(*) FILTER (n_chars >= 900 AND lang = 'en') AS agree_sure FROM documents
  UNION ALL SELECT 'chars', count(*), count(*) FILTER (n_chars = length(text)), count(*) FILTER (n_chars >= 900), count(*) FILTER (n_chars >= 900 AND n_chars = length(text)) FROM documents""")
def field_agreement(t):
    d = t.documents.select("lang", F.lit("en").alias("guess"), "n_chars", F.length("text").alias("len"), (F.col("n_chars") / 1000).alias("conf"))
    return quality.field_agreement(d, [("lang", "lang", "guess"), ("chars", "n_chars", "len")], "conf")


@query("tool_recall", """WITH g AS (SELECT DISTINCT l_orderkey, lower(p_name) AS term FROM lineitem JOIN part ON l_partkey = p_partkey),
p AS (SELECT DISTINCT l_orderkey, lower(split_part(p_name, ' ', 2)) AS t FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R')
SELECT l_orderkey, term, EXISTS (SELECT 1 FROM p WHERE p.l_orderkey = g.l_orderkey AND (contains(t, term) OR contains(term, t))) AS found FROM g""")
def tool_recall(t):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    gold = d.select("l_orderkey", F.col("p_name").alias("term"))
    pred = d.filter("l_returnflag = 'R'").select("l_orderkey", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("term"))
    return quality.recall_containment(gold, pred, "l_orderkey", "term")


@query("reconcile_layers", """WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS side, coalesce(a.n = b.n, false) AS equal FROM a FULL JOIN b ON a.k = b.k""")
def reconcile_layers(t):
    n = lambda d: d.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return quality.reconcile(n(t.orders.filter("o_orderstatus <> 'P'")), n(t.orders.filter("o_orderpriority <> '5-LOW'")), "k", ["n"]).select("k", "side", "equal")


SAMPLE_SQL = """b AS (SELECT doc_id, lang, source, CASE WHEN quality IS NULL THEN 'review' WHEN toxic = 1 THEN 'disagree' ELSE 'agree' END AS bucket, md5('20260928|' || doc_id) AS h
  FROM documents LEFT JOIN labels USING (doc_id)),
s AS (SELECT *, row_number() OVER (PARTITION BY bucket, lang, source ORDER BY h, doc_id) AS turn FROM b),
q AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY turn, lang, source) AS pick FROM s)"""


@query("stratified_sample", with_(SAMPLE_SQL) + "SELECT doc_id, bucket, pick FROM q WHERE pick <= CASE bucket WHEN 'disagree' THEN 24 WHEN 'review' THEN 15 ELSE 21 END")
def stratified_sample(t):
    d = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "lang", "source", F.when(F.col("quality").isNull(), "review").when(F.col("toxic") == 1, "disagree").otherwise("agree").alias("bucket"))
    out = sampling.quota_sample(d, "bucket", ["lang", "source"], sampling.quotas(60), id="doc_id")
    return out.select("doc_id", "bucket", F.col("pick").cast("long").alias("pick"))


@query("seeded_sample", "SELECT DISTINCT o_custkey, md5('20260928|' || o_custkey) AS h FROM orders ORDER BY 2, 1 LIMIT 400")
def seeded_sample(t):
    return sampling.seeded_sample(t.orders, "o_custkey").withColumn("h", sampling.seeded("o_custkey", cfg.SAMPLE_SEED))


@query("systematic_sample", """WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, greatest(count(*) OVER (PARTITION BY source) // 4, 1) AS step FROM documents)
SELECT source, doc_id FROM r WHERE i % step = 0 AND i < 4 * step""")
def systematic_sample(t):
    return sampling.systematic_sample(t.documents.select("source", "doc_id"), "source", "doc_id")
