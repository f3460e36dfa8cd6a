"""Domain-shaped frames derived from the star-schema tables, and the same frames as SQL for the reference queries.

Every frame grows with its source table: accounts from nation, sites from supplier, postings from orders, extracts and quotes
from lineitem, answers from documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.operators.scoring import question_bank
from attesta.plans.base import Tables

TITLES = [
    "senior-data-engineer", "lims-administrator", "automation-engineer-summer-intern", "process-development-scientist",
    "director-process-development", "msat-lead", "cell-therapy-manufacturing-associate", "analytical-scientist", "qc-analyst",
    "commercial-data-platform-director", "sales-manager", "principal-scientist-gene-therapy", "vp-digital-innovation",
    "staff-software-engineer", "downstream-scientist-unicorn", "regulatory-affairs-manager", "head-of-mes",
    "associate-director-bioinformatics", "clinical-research-associate", "research-scientist", "warehouse-operator",
    "lead-formulation-scientist", "historian-engineer", "executive-assistant",
]
FUNCTIONS = ["Commercial HQ and admin", "Drug substance manufacturing; process development", "R&D labs", "Fill-finish plant",
             "MSAT and tech transfer, API synthesis", "Packaging and distribution", "CGT manufacturing, viral vector", ""]
MODALITY_TEXT = ["mAbs and ADCs", "small molecule tablets", "mRNA vaccine", "oral solid and biologics", "not given"]
VERDICTS = ["KEEP", "FLAG", "GAP", "DROP"]
STATUSES = ["Active Pipeline", "No Deal Found", "Closed Lost", "", "Closed Won", "Active Prospect"]
HEADS = ["n/a", "PENDING", "", "Ann", "Jon", "Mia"]
FAMILY_CYCLE = ["data_digital", "process_dev", "lab_systems", "", "analytical", "msat_mfg_sci", "automation_mes", "cell_gene"]


def pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_pick(values, index: str) -> str:
    return f"{sql_list(values)}[1 + CAST({index} AS INT)]"


def _letters(c: Column) -> Column:
    return F.initcap(F.concat(F.lit("k"), F.translate(c.cast("string"), "0123456789", "abcdefghij")))


# ---------------------------------------------------------------- accounts, sites
def accounts(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    return t.nation.select(
        F.lower("n_name").alias("account_id"), F.col("n_name").alias("company"), (n % 11 != 10).alias("in_universe"),
        (n % 7 != 6).alias("active"), (n % 7 == 6).alias("exclude"), pick(STATUSES, n % 6).alias("pipeline_status"),
        F.col("n_nationkey"), F.col("n_regionkey"))


def sites(t: Tables) -> DataFrame:
    s, level = F.col("s_suppkey"), F.col("s_acctbal") + 1000
    step = lambda d: F.floor(level / d).cast("string")
    head = pick(HEADS, s % 6)
    head = F.when(s % 6 >= 3, F.concat(head, F.lit(" "), _letters(s), F.lit(", VP Operations"))).otherwise(head)
    manual = F.when(s % 13 == 0, "Drop").otherwise("")
    fit = F.when(s % 13 == 0, "no").otherwise(pick(["yes", "soft", "soft", "no"], s % 4))
    d = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return d.select(
        F.concat(F.lit("s"), s.cast("string")).alias("site_id"), F.lower("n_name").alias("account_id"),
        F.when(F.col("s_nationkey") % 2 == 0, "US").otherwise("EU").alias("region"), F.col("s_name").alias("site"),
        F.concat(F.lit("Town"), step(1000), F.lit(" (Old"), step(2000), F.lit("), ST")).alias("city"),
        F.concat(F.lit("Metro"), step(5000), F.lit(", ST")).alias("metro"), pick(FUNCTIONS, s % 8).alias("functions"),
        pick(MODALITY_TEXT, s % 5).alias("modality_text"), pick(VERDICTS, s % 4).alias("verdict_auto"),
        manual.alias("verdict_manual"), fit.alias("icp_fit"), head.alias("named_site_head"), s.alias("s_suppkey"), "s_acctbal")


ACCOUNTS_SQL = f"""accounts AS (SELECT lower(n_name) AS account_id, n_name AS company, n_nationkey % 11 <> 10 AS in_universe,
  n_nationkey % 7 <> 6 AS active, n_nationkey % 7 = 6 AS exclude, {sql_pick(STATUSES, 'n_nationkey % 6')} AS pipeline_status,
  n_nationkey, n_regionkey FROM nation)"""

SITES_SQL = f"""sites AS (SELECT 's' || s_suppkey AS site_id, lower(n_name) AS account_id,
  CASE WHEN s_nationkey % 2 = 0 THEN 'US' ELSE 'EU' END AS region, s_name AS site,
  'Town' || CAST(floor((s_acctbal + 1000) / 1000) AS BIGINT) || ' (Old' || CAST(floor((s_acctbal + 1000) / 2000) AS BIGINT) || '), ST' AS city,
  'Metro' || CAST(floor((s_acctbal + 1000) / 5000) AS BIGINT) || ', ST' AS metro,
  'town' || CAST(floor((s_acctbal + 1000) / 1000) AS BIGINT) AS city_key, 'old' || CAST(floor((s_acctbal + 1000) / 2000) AS BIGINT) AS alias_key,
  'metro' || CAST(floor((s_acctbal + 1000) / 5000) AS BIGINT) AS metro_key,
  {sql_pick(FUNCTIONS, 's_suppkey % 8')} AS functions, {sql_pick(MODALITY_TEXT, 's_suppkey % 5')} AS modality_text,
  {sql_pick(VERDICTS, 's_suppkey % 4')} AS verdict_auto, CASE WHEN s_suppkey % 13 = 0 THEN 'Drop' ELSE '' END AS verdict_manual,
  CASE WHEN s_suppkey % 13 = 0 THEN 'no' ELSE ['yes', 'soft', 'soft', 'no'][1 + CAST(s_suppkey % 4 AS INT)] END AS icp_fit,
  CASE WHEN s_suppkey % 6 >= 3 THEN {sql_pick(HEADS, 's_suppkey % 6')} || ' K' || translate(CAST(s_suppkey AS VARCHAR), '0123456789', 'abcdefghij')
    || ', VP Operations' ELSE {sql_pick(HEADS, 's_suppkey % 6')} END AS named_site_head, s_suppkey, s_acctbal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


# ---------------------------------------------------------------- postings
def postings(t: Tables) -> DataFrame:
    """Orders as postings: the account of the customer, a place key of every tier, a title, a seen window."""
    k, c, level = F.col("o_orderkey"), F.col("c_custkey"), F.col("c_acctbal") + 1000
    step = lambda d: F.floor(level / d).cast("string")
    city = (F.when(c % 17 == 0, "").when(c % 5 == 0, F.concat(F.lit("metro"), step(5000)))
            .when(c % 5 == 1, F.concat(F.lit("old"), step(2000))).otherwise(F.concat(F.lit("town"), step(1000))))
    d = t.orders.join(t.customer, F.col("o_custkey") == c).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    day = F.to_date("o_orderdate")
    return d.select(
        F.concat(F.lit("p"), k.cast("string")).alias("posting_id"), F.lower("n_name").alias("account_id"),
        city.alias("city_slug"), city.alias("city_raw"), pick(TITLES, k % len(TITLES)).alias("role_slug"),
        F.replace(pick(TITLES, k % len(TITLES)), F.lit("-"), F.lit(" ")).alias("role_title"), day.alias("first_seen"),
        F.date_add(day, (k % 300).cast("int")).alias("last_seen"), (1 + k % 6).cast("long").alias("seen_count"),
        pick(cfg.TIERS, k % 6).alias("extraction_tier"), F.concat(F.lit("https://jobs.example/"), k.cast("string")).alias("url"), k.alias("o_orderkey"),
        "o_orderstatus", "o_orderpriority")


POSTINGS_SQL = f"""postings AS (SELECT 'p' || o_orderkey AS posting_id, lower(n_name) AS account_id,
  CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 5 = 0 THEN 'metro' || CAST(floor((c_acctbal + 1000) / 5000) AS BIGINT)
    WHEN c_custkey % 5 = 1 THEN 'old' || CAST(floor((c_acctbal + 1000) / 2000) AS BIGINT)
    ELSE 'town' || CAST(floor((c_acctbal + 1000) / 1000) AS BIGINT) END AS city_slug,
  {sql_pick(TITLES, f'o_orderkey % {len(TITLES)}')} AS role_slug, replace({sql_pick(TITLES, f'o_orderkey % {len(TITLES)}')}, '-', ' ') AS role_title,
  CAST(o_orderdate AS DATE) AS first_seen, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 AS INT) AS last_seen,
  1 + o_orderkey % 6 AS seen_count, {sql_pick(cfg.TIERS, 'o_orderkey % 6')} AS extraction_tier,
  'https://jobs.example/' || o_orderkey AS url, o_orderkey, o_orderstatus, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _first_rule(col: str, rules, value: int, otherwise: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({col}, {sql_text(r[1])}) THEN "
                    + (sql_text(str(r[0])) if value == 0 else f"regexp_extract({col}, {sql_text(r[1])}, 0)") for r in rules)
    return f"CASE {arms} ELSE {otherwise} END"


CLASSIFIED_SQL = f"""titled AS (SELECT *, '-' || lower(role_slug) || '-' AS s FROM postings),
classified AS (SELECT *, {_first_rule('s', [(n, p) for n, p in cfg.FAMILIES], 0, "''")} AS job_family,
  {_first_rule('s', [(n, p) for n, p in cfg.FAMILIES], 1, "''")} AS job_family_rule,
  CAST({_first_rule('role_slug', cfg.SENIORITY, 0, "'1'")} AS INT) AS seniority_rank,
  {_first_rule('role_slug', cfg.SENIORITY, 1, "'default'")} AS seniority_rule,
  CASE WHEN regexp_matches(s, {sql_text(cfg.HARD_EXCLUDE)}) THEN 'hard:' || regexp_extract(s, {sql_text(cfg.HARD_EXCLUDE)}, 0)
       WHEN regexp_matches(s, {sql_text(cfg.SOFT_EXCLUDE)}) THEN 'soft:' || regexp_extract(s, {sql_text(cfg.SOFT_EXCLUDE)}, 0) ELSE '' END AS excluded
  FROM titled)"""

INDEX_SQL = """site_index AS (SELECT DISTINCT account_id, 1 AS tier, city_key AS key, site_id FROM sites
  UNION SELECT account_id, 2, alias_key, site_id FROM sites UNION SELECT account_id, 3, metro_key, site_id FROM sites),
per_tier AS (SELECT account_id, key, tier, count(DISTINCT site_id) AS n, min(site_id) AS one FROM site_index GROUP BY ALL),
best AS (SELECT * FROM per_tier QUALIFY row_number() OVER (PARTITION BY account_id, key ORDER BY tier) = 1)"""

_RESOLVED = """resolved AS (SELECT p.*, CASE WHEN b.n = 1 AND city_slug <> '' THEN b.one END AS site_id,
  CASE WHEN city_slug = '' THEN 'unmatched' WHEN b.n IS NULL THEN 'city_not_in_sites' WHEN b.n > 1 THEN 'ambiguous'
       WHEN b.tier = 1 THEN 'exact_city' WHEN b.tier = 2 THEN 'alias' ELSE 'metro' END AS site_resolution,
  CASE WHEN city_slug = '' THEN 0 ELSE coalesce(b.n, 0) END AS n_site_candidates
  FROM classified p LEFT JOIN best b ON p.account_id = b.account_id AND p.city_slug = b.key)"""

SCORED_SQL = f"""{_RESOLVED},
fitted AS (SELECT r.*, coalesce(s.icp_fit, 'unknown') AS icp_fit FROM resolved r LEFT JOIN sites s USING (site_id)),
scored AS (SELECT *, icp_fit IN ('yes', 'soft') AND NOT starts_with(excluded, 'hard:')
    AND (job_family IN {tuple(cfg.CORE_FAMILIES)} OR (job_family IN {tuple(cfg.BIOPROCESS_FAMILIES)}
         AND (seniority_rank >= 3 OR regexp_matches(role_slug, {sql_text(cfg.NAMED_TOOL)}))))
    AND (NOT starts_with(excluded, 'soft:') OR job_family IN {tuple(cfg.CORE_FAMILIES)}) AS tier2_admit,
  CAST(3 * seniority_rank + CASE WHEN job_family IN {tuple(cfg.CORE_FAMILIES)} THEN 4 ELSE 1 END + CASE WHEN icp_fit = 'yes' THEN 3 ELSE 1 END
    + CASE WHEN DATE '2002-01-01' - last_seen <= 365 THEN 2 ELSE 0 END + least(greatest(seen_count - 1, 0), 3) AS INT) AS tier2_score FROM fitted)"""
AS_OF = "2002-01-01"


# ---------------------------------------------------------------- extracts, quotes
#: So many suppliers at most go to every task.
NEAR = 1_000_000


def line_id() -> Column:
    """The id of the posting that a line item stands for."""
    return F.concat_ws("-", F.lit("x"), *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))


def extract_lines(t: Tables) -> DataFrame:
    """Line items with their part and nation, of which extracts are made."""
    owner = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    # two short columns of the suppliers: lines are not shuffled for them where their number allows that
    owner = F.broadcast(owner) if t.supplier.count() <= NEAR else owner
    d = t.lineitem.join(owner, F.col("l_suppkey") == F.col("s_suppkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate", "n_name", "p_brand", "p_type", "p_size", "p_name")


def extracts(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Line items as extracted postings: the brand of the part is the team, the account that of the supplier. lines: `extract_lines` with the id of the posting."""
    lines = extract_lines(t).withColumn("posting_id", line_id()) if lines is None else lines
    ln, size = F.col("l_linenumber"), F.col("p_size")
    brand = F.replace("p_brand", F.lit("#"), F.lit(" "))
    digits = F.regexp_extract("p_brand", r"(\d+)", 1)
    team = (F.when(ln == 7, F.concat(F.lit("BR"), digits)).when(ln == 3, F.concat(F.lit("the "), brand, F.lit(" Team")))
            .otherwise(brand))
    slug = F.when(ln == 7, F.concat(F.lit("br"), digits)).otherwise(F.replace(F.lower(brand), F.lit(" "), F.lit("-")))
    parent = F.when(size % 4 == 0, F.concat(F.lit("Division "), (size % 5).cast("string"))).when(
        size % 4 == 1, F.concat(F.lit("Brand "), ((digits.cast("int") * 7 + 3) % 25 + 1).cast("string")))
    return lines.select(
        "posting_id", F.lower("n_name").alias("account_id"), team.alias("team_name"), slug.alias("team_slug"),
        F.when(F.col("l_quantity") > 45, F.concat(F.lit("BR"), digits)).alias("team_acronym"), parent.alias("parent_org"),
        F.array_compact(F.array(F.when(size % 3 == 0, F.concat(F.lit("Support "), (size % 7).cast("string"))))).alias("supports_teams"),
        F.array("p_type").alias("tech_stack"), F.when(F.col("l_returnflag") == "A", F.col("p_name")).alias("hiring_manager"),
        F.lit(None).cast("string").alias("site_stated"), F.array(F.col("p_name")).alias("vocabulary"),
        pick(["central_owned", "site_autonomous", "mixed"], ln % 3).alias("autonomy_flag"),
        pick(["tier2_archive_body", "tier3_live_body", "tier1_shell"], F.col("l_orderkey") % 3).alias("extraction_tier"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("site_id"), pick(FAMILY_CYCLE, size % 8).alias("job_family"),
        (1 + ln % 6).cast("int").alias("seniority_rank"), F.to_date("l_shipdate").alias("first_seen"),
        F.lit(None).cast("date").alias("posted_date"), F.col("l_linestatus"), F.col("l_returnflag"), size.alias("p_size"), F.col("p_name"))


def quotes(ex: DataFrame) -> DataFrame:
    """The quotes of derived extracts: team, parent and support quotes; those of open lines did not verify."""
    claim = lambda kind, subject, slug: F.struct(F.lit(kind).alias("claim_type"), subject.alias("subject"), slug.alias("subject_slug"))
    lower = lambda c: F.replace(F.lower(c), F.lit(" "), F.lit("-"))
    rows = F.array_compact(F.array(
        F.when(F.col("l_returnflag") != "N", claim("team_name", F.col("team_name"), F.col("team_slug"))),
        F.when(F.col("parent_org").isNotNull(), claim("parent_org", F.col("parent_org"), lower(F.col("parent_org")))),
        F.when(F.size("supports_teams") > 0, claim("supports_team", F.get("supports_teams", F.lit(0)), lower(F.get("supports_teams", F.lit(0))))),
        claim("vocabulary", F.col("p_name"), F.lit(""))))
    d = ex.select("posting_id", "account_id", F.inline(rows), (F.col("l_linestatus") == "F").alias("verbatim_verified"), F.col("first_seen").alias("display_date"))
    return d.withColumn("quote_id", F.concat_ws("--", "posting_id", "claim_type")).withColumn(
        "quote_text", F.concat(F.lit("The posting names "), "subject", F.lit(" in its own words."))).withColumn(
        "match_method", F.when(F.col("verbatim_verified"), "exact").otherwise("not_found")).withColumn("date_kind", F.lit("capture"))


EXTRACTS_SQL = f"""extracts AS (SELECT 'x-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS posting_id, lower(n_name) AS account_id,
  regexp_extract(p_brand, '(\\d+)', 1) AS digits,
  CASE WHEN l_linenumber = 7 THEN 'BR' || regexp_extract(p_brand, '(\\d+)', 1) WHEN l_linenumber = 3 THEN 'the ' || replace(p_brand, '#', ' ') || ' Team'
       ELSE replace(p_brand, '#', ' ') END AS team_name,
  CASE WHEN l_linenumber = 7 THEN 'br' || regexp_extract(p_brand, '(\\d+)', 1) ELSE lower(replace(p_brand, '#', '-')) END AS team_slug,
  CASE WHEN l_quantity > 45 THEN 'BR' || regexp_extract(p_brand, '(\\d+)', 1) END AS team_acronym,
  CASE WHEN p_size % 4 = 0 THEN 'Division ' || (p_size % 5) WHEN p_size % 4 = 1
       THEN 'Brand ' || ((CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) * 7 + 3) % 25 + 1) END AS parent_org,
  CASE WHEN p_size % 3 = 0 THEN 'Support ' || (p_size % 7) END AS support, p_type AS tech,
  CASE WHEN l_returnflag = 'A' THEN p_name END AS hiring_manager, p_name,
  {sql_pick(['tier2_archive_body', 'tier3_live_body', 'tier1_shell'], 'l_orderkey % 3')} AS extraction_tier,
  {sql_pick(['central_owned', 'site_autonomous', 'mixed'], 'l_linenumber % 3')} AS autonomy_flag,
  's' || l_suppkey AS site_id, {sql_pick(FAMILY_CYCLE, 'p_size % 8')} AS job_family, CAST(1 + l_linenumber % 6 AS INT) AS seniority_rank,
  CAST(l_shipdate AS DATE) AS first_seen, l_linestatus, l_returnflag
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

QUOTES_SQL = """quotes AS (
  SELECT posting_id, account_id, 'team_name' AS claim_type, team_name AS subject, team_slug AS subject_slug, l_linestatus = 'F' AS ok, first_seen
    FROM extracts WHERE l_returnflag <> 'N'
  UNION ALL SELECT posting_id, account_id, 'parent_org', parent_org, lower(replace(parent_org, ' ', '-')), l_linestatus = 'F', first_seen
    FROM extracts WHERE parent_org IS NOT NULL
  UNION ALL SELECT posting_id, account_id, 'supports_team', support, lower(replace(support, ' ', '-')), l_linestatus = 'F', first_seen
    FROM extracts WHERE support IS NOT NULL
  UNION ALL SELECT posting_id, account_id, 'vocabulary', p_name, '', l_linestatus = 'F', first_seen FROM extracts)"""


# ---------------------------------------------------------------- answers
def byte(*parts) -> Column:
    """The first byte of the md5 of the parts: 0..255."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 2), 16, 10).cast("int")


def spread(b: Column) -> Column:
    """A byte as a mostly decisive probability."""
    return F.when(b < 110, 0.05).when(b < 118, 0.2).when(b < 140, 0.5).when(b < 148, 0.8).otherwise(0.95)


def sql_byte(expr: str) -> str:
    return f"CAST('0x' || substr(md5({expr}), 1, 2) AS INT)"


def sql_spread(expr: str) -> str:
    b = sql_byte(expr)
    return f"CASE WHEN {b} < 110 THEN 0.05e0 WHEN {b} < 118 THEN 0.2e0 WHEN {b} < 140 THEN 0.5e0 WHEN {b} < 148 THEN 0.8e0 ELSE 0.95e0 END"


def answers(t: Tables, questions=None) -> DataFrame:
    """One answer per document and question, reproducible from their md5."""
    bank = question_bank(t.documents.select(F.col("doc_id").cast("string").alias("item_id")), questions or cfg.SITE_QUESTIONS)
    b = byte("item_id", "question")
    noul = F.col("kind") == "noul"
    choice = F.get("options", F.pmod(b, F.greatest(F.size("options"), F.lit(1))))
    conf = F.when(byte(F.lit("c"), "item_id", "question") < 200, 0.9).otherwise(0.6)
    probs = F.when(~noul, F.map_from_arrays(F.array(choice), F.array(conf)))
    return bank.select("item_id", "question", "kind", F.when(noul, spread(b)).alias("p"), F.when(~noul, choice).alias("choice"),
                       F.when(~noul, conf).alias("confidence"), probs.alias("probs"))


def sql_answers(questions=None, table: str = "wide") -> str:
    """The same answers, one wide row per document."""
    cols = []
    for q, kind, opts in questions or cfg.SITE_QUESTIONS:
        key = f"doc_id || '|{q}'"
        if kind == "noul":
            cols.append(f"{sql_spread(key)} AS {q}_p")
        else:
            cols.append(f"{sql_list(opts)}[1 + {sql_byte(key)} % {len(opts)}] AS {q}")
            cols.append(f"CASE WHEN {sql_byte(chr(39) + 'c|' + chr(39) + ' || ' + key)} < 200 THEN 0.9e0 ELSE 0.6e0 END AS {q}_conf")
    return f"{table} AS (SELECT CAST(doc_id AS VARCHAR) AS item_id, doc_id, lang, source, text, n_chars, {', '.join(cols)} FROM documents)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
