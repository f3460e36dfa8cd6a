"""Queries over the org layer: units, edges, ghosts, forests, coverage, overrides."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import claims as claim_ops
from attesta.operators import graph, org, quality, query as served
from attesta.operators.skew import first_per_group
from attesta.plans import derive as dv
from attesta.plans.base import query
from attesta.plans.derive import with_
from attesta.plans.q_corpus import CORPUS, corpus_extracts, scored
from attesta.session import land, land_by

POSTING_COLS = ["posting_id", "account_id", "site_id", "job_family", "seniority_rank", "posted_date", "first_seen"]


class Org:
    """The derived org inputs, and the assembled layers. dealt: the lines are landed in buckets of the posting, for layers that join them by it more than once."""

    def __init__(self, t, dealt: bool = False):
        raw = dv.extracts(t, land_by(dv.extract_lines(t), "posting_id", t.lineitem.count(), dv.line_id()) if dealt else None)
        self.postings = raw.select(*POSTING_COLS)
        self.quotes = dv.quotes(raw)
        self.extracts = raw.drop("site_id", "job_family", "seniority_rank", "posted_date", "first_seen", "l_linestatus", "l_returnflag", "p_size", "p_name")

    def units(self):
        return org.assemble_units(self.extracts, self.postings, self.quotes)

    def claims(self):
        return org.gated_edges(self.extracts, self.postings, self.quotes)

    def edges(self):
        return org.assemble_edges(self.claims())

    def phrases(self):
        return org.unit_phrases(self.extracts, self.postings)

    def folded_edges(self):
        _, folds = org.merge_acronyms(self.units(), self.unit_postings())
        return org.assemble_edges(org.refold_edges(self.claims(), folds))

    def unit_postings(self):
        return self.extracts.select(org.unit_id("account_id", "team_slug").alias("unit_id"), "posting_id")


BASE = (dv.EXTRACTS_SQL, dv.QUOTES_SQL)
UNITS_SQL = """e AS (SELECT *, account_id || '--ou-' || team_slug AS unit_id FROM extracts),
base AS (SELECT unit_id, account_id, team_slug AS unit_slug, count(DISTINCT posting_id) AS n_postings, count(*) FILTER (extraction_tier = 'tier3_live_body') AS n_postings_tier3plus,
  max(seniority_rank) AS seniority_max, CAST(min(first_seen) AS VARCHAR) AS first_evidence_date, CAST(max(first_seen) AS VARCHAR) AS last_evidence_date,
  count(DISTINCT site_id) AS n_site_candidates, count(DISTINCT tech) AS n_tech, count(DISTINCT hiring_manager) AS n_managers FROM e GROUP BY ALL),
names AS (SELECT unit_id, team_name AS unit_name FROM (SELECT unit_id, team_name, count(*) AS n FROM e GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY n DESC, team_name) = 1),
acros AS (SELECT unit_id, team_acronym AS acronym FROM (SELECT unit_id, team_acronym, count(*) AS n FROM e WHERE team_acronym IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY n DESC, team_acronym) = 1),
tops AS (SELECT unit_id, site_id FROM (SELECT unit_id, site_id, count(*) AS n FROM e GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY n DESC, site_id) = 1),
fams AS (SELECT unit_id, string_agg(job_family, '|' ORDER BY n DESC, job_family) AS job_families FROM (SELECT unit_id, job_family, count(*) AS n FROM e WHERE job_family <> '' GROUP BY ALL) GROUP BY 1),
vocab AS (SELECT unit_id, count(DISTINCT p_name) AS n_phrases FROM e GROUP BY 1),
cited AS (SELECT unit_id, count(*) AS n_quotes FROM e JOIN quotes q ON q.posting_id = e.posting_id AND q.claim_type = 'team_name' AND q.ok AND q.subject_slug = e.team_slug GROUP BY 1),
units AS (SELECT base.*, unit_name, acronym, site_id, job_families, n_phrases, coalesce(n_quotes, 0) AS n_quotes,
  CASE WHEN n_postings >= 3 OR (n_postings >= 2 AND n_postings_tier3plus >= 2) THEN 'high' WHEN n_postings >= 2 OR n_postings_tier3plus >= 1 THEN 'medium' ELSE 'low' END AS confidence
  FROM base JOIN names USING (unit_id) JOIN tops USING (unit_id) LEFT JOIN acros USING (unit_id) LEFT JOIN fams USING (unit_id) LEFT JOIN vocab USING (unit_id) LEFT JOIN cited USING (unit_id))"""
CLAIMS_SQL = """claims AS (
  SELECT account_id, 'reports_to' AS edge_type, unit_id AS src, account_id || '--ou-' || lower(replace(parent_org, ' ', '-')) AS dst, parent_org AS dst_label, e.posting_id, e.posting_id || '--parent_org' AS quote_id, first_seen, extraction_tier
    FROM e WHERE parent_org IS NOT NULL AND l_linestatus = 'F'
  UNION ALL SELECT account_id, 'supports', unit_id, account_id || '--ou-' || lower(replace(support, ' ', '-')), support, posting_id, posting_id || '--supports_team', first_seen, extraction_tier
    FROM e WHERE support IS NOT NULL AND l_linestatus = 'F'
  UNION ALL SELECT account_id, 'located_at', unit_id, site_id, site_id, posting_id, CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'F' THEN posting_id || '--team_name' END, first_seen, extraction_tier FROM e),
edges AS (SELECT account_id || '--oe-' || edge_type || '-' || substr(sha1(src || '|' || dst), 1, 10) AS edge_id, account_id, edge_type, src, dst, min(dst_label) AS dst_label, count(DISTINCT posting_id) AS n_postings,
  count(DISTINCT quote_id) AS n_quotes, count(DISTINCT posting_id) FILTER (extraction_tier = 'tier3_live_body') AS n_postings_tier3plus, CAST(min(first_seen) AS VARCHAR) AS first_evidence_date,
  CAST(max(first_seen) AS VARCHAR) AS last_evidence_date, CASE WHEN count(DISTINCT posting_id) >= 3 OR (count(DISTINCT posting_id) >= 2 AND count(DISTINCT posting_id) FILTER (extraction_tier = 'tier3_live_body') >= 2) THEN 'high'
   WHEN count(DISTINCT posting_id) >= 2 OR count(DISTINCT posting_id) FILTER (extraction_tier = 'tier3_live_body') >= 1 THEN 'medium' ELSE 'low' END AS confidence FROM claims GROUP BY account_id, edge_type, src, dst)"""
ORG = (*BASE, UNITS_SQL, CLAIMS_SQL)
RECURSIVE = "WITH RECURSIVE"


FOLD_SQL = """pairs AS (SELECT u.unit_id, u.unit_name, h.unit_id AS host_id, h.n_postings AS hn FROM units u JOIN units h ON h.account_id = u.account_id AND lower(h.acronym) = u.unit_slug AND h.unit_id <> u.unit_id),
folds AS (SELECT * FROM (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY hn DESC, host_id) = 1) WHERE host_id NOT IN (SELECT unit_id FROM pairs))"""


def text_dates(d, *cols):
    return d.withColumns({c: F.col(c).cast("string") for c in cols})


@query("unit_assembly", with_(*BASE, UNITS_SQL) + """SELECT unit_id, unit_name, coalesce(acronym, '') AS acronym, site_id, n_site_candidates, n_postings, n_postings_tier3plus, n_quotes, seniority_max, n_tech, n_managers,
  first_evidence_date, last_evidence_date, coalesce(job_families, '') AS job_families, n_phrases, confidence FROM units""")
def unit_assembly(t):
    u = text_dates(Org(t, dealt=True).units(), "first_evidence_date", "last_evidence_date")
    return u.select("unit_id", "unit_name", F.coalesce("acronym", F.lit("")).alias("acronym"), "site_id", "n_site_candidates", "n_postings", "n_postings_tier3plus", "n_quotes",
                    "seniority_max", "n_tech", "n_managers", "first_evidence_date", "last_evidence_date",
                    F.coalesce(F.array_join("job_families", "|"), F.lit("")).alias("job_families"), "n_phrases", "confidence")


@query("unit_facets", with_(*BASE, UNITS_SQL) + """SELECT unit_id, 'site' AS facet, site_id AS value, count(*) AS n FROM e GROUP BY ALL UNION ALL SELECT unit_id, 'family', job_family, count(*) FROM e WHERE job_family <> '' GROUP BY ALL
  UNION ALL SELECT unit_id, 'tech', tech, count(*) FROM e GROUP BY ALL UNION ALL SELECT unit_id, 'manager', hiring_manager, count(*) FROM e WHERE hiring_manager IS NOT NULL GROUP BY ALL""")
def unit_facets(t):
    o = Org(t)
    return org.unit_facets(o.extracts, o.postings)


@query("unit_evidence", with_(*BASE, UNITS_SQL) + """SELECT unit_id, e.posting_id, e.posting_id || '--team_name' AS quote_id FROM e JOIN quotes q ON q.posting_id = e.posting_id AND q.claim_type = 'team_name' AND q.ok AND q.subject_slug = e.team_slug""")
def unit_evidence(t):
    o = Org(t)
    return org.unit_evidence(o.extracts, o.quotes)


@query("unit_quotes", with_(*BASE, UNITS_SQL) + "SELECT unit_id, q.claim_type, count(*) AS n FROM e JOIN quotes q USING (posting_id) GROUP BY ALL")
def unit_quotes(t):
    o = Org(t)
    return org.unit_quotes(o.extracts, o.quotes).groupBy("unit_id", "claim_type").agg(F.count(F.lit(1)).alias("n"))


@query("acronym_merge", with_(*BASE, UNITS_SQL, FOLD_SQL) + """, moved AS (SELECT coalesce(host_id, e.unit_id) AS unit_id, posting_id FROM e LEFT JOIN folds USING (unit_id)),
n AS (SELECT unit_id, count(DISTINCT posting_id) AS n_postings FROM moved GROUP BY 1), a AS (SELECT host_id, string_agg(DISTINCT unit_name, '|' ORDER BY unit_name) AS aliases FROM folds GROUP BY 1)
SELECT u.unit_id, coalesce(aliases, '') AS aliases, n.n_postings FROM units u JOIN n USING (unit_id) LEFT JOIN a ON a.host_id = u.unit_id WHERE u.unit_id NOT IN (SELECT unit_id FROM folds)""")
def acronym_merge(t):
    o = Org(t, dealt=True)
    units, _ = org.merge_acronyms(o.units(), o.unit_postings())
    return units.select("unit_id", F.array_join("aliases", "|").alias("aliases"), "n_postings")


@query("edge_assembly", with_(*ORG) + "SELECT edge_id, edge_type, src, dst, n_postings, n_quotes, n_postings_tier3plus, first_evidence_date, last_evidence_date, confidence FROM edges")
def edge_assembly(t):
    e = text_dates(Org(t, dealt=True).edges(), "first_evidence_date", "last_evidence_date")
    return e.select("edge_id", "edge_type", F.col("src_unit_id").alias("src"), F.coalesce("dst_unit_id", "dst_site_id").alias("dst"), "n_postings", "n_quotes", "n_postings_tier3plus",
                    "first_evidence_date", "last_evidence_date", "confidence")


@query("ghosts", with_(*ORG) + """SELECT DISTINCT dst AS unit_id, dst_label AS unit_name FROM edges WHERE edge_type <> 'located_at' AND dst NOT IN (SELECT unit_id FROM units)""")
def ghosts(t):
    o = Org(t, dealt=True)
    return org.add_ghosts(land(o.units()), o.edges()).filter(F.col("unit_kind") == "named_not_mapped").select("unit_id", "unit_name")


@query("unit_phrases", with_(*BASE, UNITS_SQL) + "SELECT unit_id, p_name AS phrase, min(posting_id) AS first_posting FROM e GROUP BY ALL")
def unit_phrases(t):
    return Org(t).phrases().select("unit_id", "phrase", F.col("first_at.posting_id").alias("first_posting"))


@query("folded_edges", with_(*ORG, FOLD_SQL) + """, kept AS (SELECT c.edge_type, c.src, coalesce(f.host_id, c.dst) AS dst, c.posting_id, c.quote_id FROM claims c LEFT JOIN folds f ON f.unit_id = c.dst AND c.edge_type <> 'located_at'
  WHERE c.src NOT IN (SELECT unit_id FROM folds))
SELECT edge_type, src, dst, count(DISTINCT posting_id) AS n_postings, count(DISTINCT quote_id) AS n_quotes FROM kept GROUP BY ALL""")
def folded_edges(t):
    """Edges after acronyms are folded: the claims of a folded unit fall away, claims that point at it point at its host."""
    return Org(t, dealt=True).folded_edges().select("edge_type", F.col("src_unit_id").alias("src"), F.coalesce("dst_unit_id", "dst_site_id").alias("dst"), "n_postings", "n_quotes")


@query("unquoted_edges", with_(*ORG) + "SELECT edge_id FROM edges WHERE n_quotes = 0")
def unquoted_edges(t):
    """The quarantine side of the edge guard."""
    return org.split_unquoted(Org(t, dealt=True).edges())[1].select("edge_id")


PARENTS_SQL = """parents AS (SELECT src AS unit_id, dst AS parent_id, n_postings FROM edges WHERE edge_type = 'reports_to' AND src <> dst QUALIFY row_number() OVER (PARTITION BY src ORDER BY n_postings DESC, edge_id) = 1)"""


@query("first_parent", with_(*ORG, PARENTS_SQL) + "SELECT * FROM parents")
def first_parent(t):
    return org.first_parent(Org(t, dealt=True).edges()).select("unit_id", "parent_id", "n_postings")


@query("gaps", with_(*ORG, PARENTS_SQL) + """SELECT u.unit_id, concat_ws('|', CASE WHEN p.unit_id IS NULL THEN 'no_parent' END, CASE WHEN n_site_candidates > 1 THEN 'site_split' END, CASE WHEN u.n_postings = 1 THEN 'single_posting' END,
  CASE WHEN n_managers = 0 THEN 'no_named_people' END, CASE WHEN acronym IS NOT NULL AND length(acronym) <= 5 AND u.n_postings = 1 THEN 'acronym_unexpanded' END, CASE WHEN n_postings_tier3plus = 0 THEN 'archive_only_evidence' END) AS gap_flags
  FROM units u LEFT JOIN parents p USING (unit_id)
  UNION ALL SELECT DISTINCT dst, 'mention_only|no_site|no_tech|no_named_people' FROM edges WHERE edge_type <> 'located_at' AND dst NOT IN (SELECT unit_id FROM units)""")
def gaps(t):
    return flagged(t).select("unit_id", F.array_join("gap_flags", "|").alias("gap_flags"))


def flagged(t):
    o = Org(t, dealt=True)
    edges, units = land(o.edges()), land(o.units())  # each is asked more than once
    return org.gap_flags(org.with_parent(org.add_ghosts(units, edges), org.first_parent(edges)))


@query("forest_places", with_(*ORG, PARENTS_SQL) + """, n AS (SELECT unit_id, 'observed' AS kind FROM units UNION SELECT DISTINCT dst, 'ghost' FROM edges WHERE edge_type <> 'located_at' AND dst NOT IN (SELECT unit_id FROM units))
SELECT n.unit_id, CASE WHEN n.unit_id IN (SELECT unit_id FROM parents) THEN 'inner' WHEN n.unit_id IN (SELECT parent_id FROM parents) THEN 'root' ELSE 'orphan' END AS place FROM n
WHERE n.unit_id IN (SELECT unit_id FROM parents) OR n.unit_id IN (SELECT parent_id FROM parents) OR kind = 'observed'""")
def forest_places(t):
    o = Org(t, dealt=True)
    edges, units = land(o.edges()), land(o.units())
    return graph.roots_orphans(org.add_ghosts(units, edges), org.first_parent(edges)).select("unit_id", "place")


@query("first_roots", with_(*ORG, PARENTS_SQL) + """, n AS (SELECT unit_id, account_id, unit_name, n_postings, confidence FROM units
  UNION ALL SELECT dst, account_id, min(dst_label), 0, 'low' FROM edges WHERE edge_type <> 'located_at' AND dst NOT IN (SELECT unit_id FROM units) GROUP BY 1, 2)
SELECT account_id, unit_id FROM n WHERE unit_id NOT IN (SELECT unit_id FROM parents) AND unit_id IN (SELECT parent_id FROM parents)
  QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY n_postings DESC, CASE confidence WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END DESC, unit_name, unit_id) = 1""")
def first_roots(t):
    """The first root of each account in the order of the forest."""
    o = Org(t, dealt=True)
    edges, units = land(o.edges()), land(o.units())
    placed = graph.roots_orphans(org.add_ghosts(units, edges), org.first_parent(edges))
    return first_per_group(placed.filter("place = 'root'"), ["account_id"], graph.forest_order()).select("account_id", "unit_id")


@query("supports_labels", with_(*ORG) + "SELECT DISTINCT src AS unit_id, dst_label AS label FROM edges WHERE edge_type = 'supports'")
def supports_labels(t):
    return org.supports_labels(Org(t, dealt=True).edges())


@query("org_overrides", with_(*BASE, UNITS_SQL) + """SELECT unit_id, CASE WHEN n_postings % 5 = 0 THEN 'promoted' WHEN n_postings % 5 = 1 THEN 'rejected' ELSE 'candidate' END AS status,
  CASE WHEN n_postings % 5 = 0 THEN 'human' ELSE confidence END AS confidence, CASE WHEN n_postings % 3 = 0 THEN 'renamed' ELSE unit_name END AS unit_name FROM units""")
def org_overrides(t):
    u = land(Org(t, dealt=True).units())  # asked three times
    n = F.col("n_postings")
    verdicts = u.filter(n % 5 < 2).select("unit_id", F.when(n % 5 == 0, "confirm").otherwise("reject").alias("v"), F.lit("seen").alias("note"))
    names = u.filter(n % 3 == 0).select("unit_id", F.lit("renamed").alias("name"))
    return org.apply_overrides(u, verdicts, names).select("unit_id", "status", "confidence", "unit_name")


# ---------------------------------------------------------------- forests over the part map
def part_parents(t):
    """Each part reports to (key * key + 1) mod n: loops with trees hanging off them."""
    n = t.part.agg(F.count(F.lit(1))).scalar()
    k = F.col("p_partkey")
    return t.part.select(k.cast("string").alias("unit_id"), ((k * k + 1) % n).cast("string").alias("parent_id"), F.col("p_size").alias("n_postings"), F.lit("low").alias("parent_conf"))


_MAP_SQL = """map AS (SELECT p_partkey AS x, (p_partkey * p_partkey + 1) % (SELECT count(*) FROM part) AS y, p_size AS w FROM part),
img(k, x) AS (SELECT 0, x FROM map UNION SELECT k + 1, m.y FROM img JOIN map m USING (x) WHERE k < 2000),
loop AS (SELECT x, y, w FROM map WHERE x IN (SELECT x FROM img WHERE k = 2000)),
walk(s, x, k) AS (SELECT x, x, 0 FROM loop UNION ALL SELECT s, l.y, k + 1 FROM walk JOIN loop l USING (x) WHERE k < (SELECT count(*) FROM loop)),
victims AS (SELECT DISTINCT arg_min(CAST(l.x AS VARCHAR), lpad(CAST(l.w AS VARCHAR), 6, '0') || CAST(l.x AS VARCHAR)) AS unit_id FROM walk JOIN loop l USING (x) GROUP BY s)"""


@query("forest_cycles", f"{RECURSIVE} {_MAP_SQL} SELECT unit_id FROM victims")
def forest_cycles(t):
    """The weakest link of every reporting loop."""
    return graph.break_cycles(part_parents(t))[1]


@query("cycle_nodes", f"{RECURSIVE} {_MAP_SQL} SELECT CAST(x AS VARCHAR) AS unit_id FROM loop")
def cycle_nodes(t):
    return graph.cycle_nodes(part_parents(t))


_FOREST_SQL = _MAP_SQL + """, up AS (SELECT x, y FROM map WHERE CAST(x AS VARCHAR) NOT IN (SELECT unit_id FROM victims))"""


@query("forest_depths", f"""{RECURSIVE} {_FOREST_SQL}, d(root, x, depth) AS (SELECT x, x, 0 FROM map WHERE x NOT IN (SELECT x FROM up) UNION ALL SELECT root, up.x, depth + 1 FROM d JOIN up ON up.y = d.x)
SELECT CAST(root AS VARCHAR) AS root_id, CAST(x AS VARCHAR) AS unit_id, depth FROM d""")
def forest_depths(t):
    parents, _ = graph.break_cycles(part_parents(t))
    return graph.depths(part_parents(t).select("unit_id"), parents)


@query("forest_ancestors", f"""{RECURSIVE} {_FOREST_SQL}, r(site_id, x) AS (SELECT DISTINCT 's' || l_suppkey, l_partkey FROM lineitem UNION SELECT site_id, up.y FROM r JOIN up USING (x))
SELECT site_id, CAST(x AS VARCHAR) AS unit_id FROM r""")
def forest_ancestors(t):
    """The parts each supplier ships, with all their ancestors."""
    parents, _ = graph.break_cycles(part_parents(t))
    seed = t.lineitem.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("site_id"), F.col("l_partkey").cast("string").alias("unit_id"))
    return graph.ancestors(seed, parents)


# ---------------------------------------------------------------- claims
@query("drop_unsupported", with_(*BASE) + """SELECT posting_id, CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'F' THEN team_name ELSE '' END AS team_name, CASE WHEN l_linestatus = 'F' THEN coalesce(parent_org, '') ELSE '' END AS parent_org,
  CASE WHEN l_linestatus = 'F' THEN coalesce(support, '') ELSE '' END AS supports, CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'F' THEN 0 ELSE 1 END + CASE WHEN parent_org IS NOT NULL AND l_linestatus <> 'F' THEN 1 ELSE 0 END
   + CASE WHEN support IS NOT NULL AND l_linestatus <> 'F' THEN 1 ELSE 0 END + 1 AS n_claims_dropped,
  CASE WHEN l_linestatus = 'F' AND (l_returnflag <> 'N' OR parent_org IS NOT NULL OR support IS NOT NULL) THEN 'ok' ELSE 'thin' END AS extract_status FROM extracts""")
def drop_unsupported(t):
    """Fields of derived extracts against their quotes; the tool has no quote and always falls."""
    o = Org(t, dealt=True)
    nul = F.lit(None).cast("string")
    ex = o.extracts.select("posting_id", "team_name", nul.alias("team_acronym"), "parent_org", nul.alias("hiring_manager"), nul.alias("reports_to_title"), nul.alias("site_stated"),
                           F.transform("supports_teams", lambda s: F.struct(s.alias("team"))).alias("supports_teams"), F.transform("tech_stack", lambda s: F.struct(s.alias("tool"))).alias("tech_stack"))
    d = claim_ops.drop_unsupported(ex, o.quotes)
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return d.select("posting_id", blank("team_name"), blank("parent_org"), F.coalesce(F.array_join("supports_teams", "|"), F.lit("")).alias("supports"), "n_claims_dropped", "extract_status")


# ---------------------------------------------------------------- coverage and served queries
COVERAGE_SQL = """idx AS (SELECT site_id, count(*) AS n_indexed, count(*) FILTER (tier2_admit) AS n_admitted, count(*) FILTER (regexp_matches(extraction_tier, '^tier[234]_')) AS n_bodies, count(*) FILTER (o_orderstatus = 'F') AS n_extracts FROM scored WHERE site_id IS NOT NULL GROUP BY 1),
cover AS (SELECT s.account_id, s.site_id, s.s_acctbal, coalesce(n_indexed, 0) AS n_indexed, coalesce(n_admitted, 0) AS n_admitted, coalesce(n_bodies, 0) AS n_bodies, coalesce(n_extracts, 0) AS n_extracts,
  CASE WHEN s.account_id NOT IN (SELECT account_id FROM postings) THEN 'never_scanned' WHEN n_indexed IS NULL THEN 'scanned_none_found' WHEN n_extracts = 0 THEN 'indexed_not_extracted' ELSE 'covered' END AS coverage_state
  FROM sites s LEFT JOIN idx USING (site_id))"""


def site_units(t):
    """One observed unit per supplier with a positive balance."""
    s = dv.sites(t)
    return s.filter("s_acctbal > 0").select("account_id", "site_id", F.lit("observed").alias("unit_kind"))


def covered(t):
    return org.coverage(dv.sites(t), scored(t), corpus_extracts(t), site_units(t))


@query("coverage", with_(*CORPUS, COVERAGE_SQL) + "SELECT site_id, n_indexed, n_admitted, n_bodies, n_extracts, CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS n_units, coverage_state FROM cover")
def coverage(t):
    return covered(t).select("site_id", "n_indexed", "n_admitted", "n_bodies", "n_extracts", "n_units", "coverage_state")


@query("list_accounts", with_(dv.ACCOUNTS_SQL, *CORPUS, COVERAGE_SQL) + """SELECT a.account_id, a.company, count(DISTINCT c.site_id) AS sites, count(DISTINCT c.site_id) FILTER (coverage_state = 'covered') AS sites_covered,
  count(DISTINCT c.site_id) FILTER (c.s_acctbal > 0) AS org_units, (SELECT count(*) FROM postings p WHERE p.account_id = a.account_id) AS postings_indexed
  FROM accounts a LEFT JOIN cover c USING (account_id) WHERE active AND in_universe GROUP BY 1, 2""")
def list_accounts(t):
    return served.list_accounts(dv.accounts(t), covered(t), site_units(t), dv.postings(t)).records


@query("list_org_units", with_(*BASE, UNITS_SQL) + """SELECT unit_id, n_postings, confidence FROM units WHERE account_id = 'nation_3' AND confidence = 'high'""")
def list_org_units(t):
    return served.list_org_units(Org(t).units(), account_id="nation_3", min_confidence="high", include_unmapped=False).records.select("unit_id", "n_postings", "confidence")


@query("list_org_units_count", with_(*BASE, UNITS_SQL) + "SELECT count(*) AS count FROM units WHERE confidence IN ('high', 'medium')")
def list_org_units_count(t):
    return served.list_org_units(Org(t).units(), min_confidence="medium").count


@query("list_org_edges", with_(*ORG) + "SELECT edge_id, n_postings FROM edges WHERE account_id = 'nation_2' AND edge_type = 'reports_to'")
def list_org_edges(t):
    return served.list_org_edges(Org(t).edges(), account_id="nation_2", edge_type="reports_to").records.select("edge_id", "n_postings")


@query("org_unit_edges", with_(*ORG) + "SELECT edge_id, edge_type FROM edges WHERE src = 'nation_1--ou-brand-1' OR dst = 'nation_1--ou-brand-1'")
def org_unit_edges(t):
    o = Org(t)
    found = served.get_org_unit(o.units(), o.edges(), org.unit_evidence(o.extracts, o.quotes), o.quotes, served_postings(o), "nation_1--ou-brand-1")
    return found["edges"].select("edge_id", "edge_type")


def served_postings(o):
    return o.postings.select("posting_id", F.col("posting_id").alias("role_title"), F.col("posting_id").alias("url"), "site_id")


@query("provenance", with_(*ORG) + """SELECT posting_id || '--team_name' AS quote_id, 'team_name' AS claim_type, team_name AS subject, site_id FROM e
  WHERE unit_id = 'nation_1--ou-brand-1' AND l_returnflag <> 'N' AND l_linestatus = 'F'""")
def provenance(t):
    o = Org(t)
    out = served.get_provenance(o.quotes, served_postings(o), evidence=org.unit_evidence(o.extracts, o.quotes), unit_id="nation_1--ou-brand-1")
    return out.records.select("quote_id", "claim_type", "subject", "site_id")


@query("edge_provenance", with_(*ORG) + """, w AS (SELECT min(edge_id) AS edge_id FROM edges WHERE account_id = 'nation_1' AND edge_type = 'supports')
SELECT DISTINCT quote_id FROM claims JOIN edges USING (account_id, edge_type, src, dst) WHERE edge_id = (SELECT edge_id FROM w) AND quote_id IS NOT NULL""")
def edge_provenance(t):
    o = Org(t, dealt=True)
    cited = o.claims().withColumn("edge_id", org.edge_id("account_id", "edge_type", "src_unit_id", F.coalesce("dst_unit_id", "dst_site_id")))
    first = o.edges().filter("account_id = 'nation_1' AND edge_type = 'supports'").agg(F.min("edge_id")).scalar()
    return served.get_provenance(o.quotes, served_postings(o), edge_claims=cited, edge_id=first).records.select("quote_id")


@query("list_gaps", with_(*ORG, PARENTS_SQL) + """SELECT u.unit_id FROM units u LEFT JOIN parents p USING (unit_id) WHERE account_id = 'nation_4' AND (p.unit_id IS NULL OR n_site_candidates > 1 OR u.n_postings = 1 OR n_managers = 0 OR n_postings_tier3plus = 0)
  UNION SELECT dst FROM edges WHERE account_id = 'nation_4' AND edge_type <> 'located_at' AND dst NOT IN (SELECT unit_id FROM units)""")
def list_gaps(t):
    return served.list_gaps(flagged(t), covered(t), account_id="nation_4")[0].records.select("unit_id")


@query("uncovered_sites", with_(*CORPUS, COVERAGE_SQL) + "SELECT site_id, coverage_state FROM cover WHERE coverage_state <> 'covered'")
def uncovered_sites(t):
    return served.list_gaps(flagged(t), covered(t))[1].records.select("site_id", "coverage_state")


@query("vocabulary", with_(*BASE, UNITS_SQL) + """SELECT p_name AS phrase, count(*) AS n FROM (SELECT 'The posting names ' || p_name || ' in its own words.' AS p_name FROM extracts WHERE account_id = 'nation_5' AND l_linestatus = 'F'
  UNION ALL SELECT p_name FROM (SELECT DISTINCT unit_id, p_name FROM e WHERE account_id = 'nation_5')) GROUP BY 1""")
def vocabulary(t):
    o = Org(t)
    out = served.get_vocabulary(o.quotes, o.units(), o.phrases(), account_id="nation_5").records
    return out.groupBy(F.col("quote_text").alias("phrase")).agg(F.count(F.lit(1)).alias("n"))


@query("query_postings", with_(*CORPUS) + """SELECT posting_id, tier2_score, 'Team ' || (o_orderkey % 11) AS team FROM scored WHERE account_id = 'nation_6' AND last_seen >= DATE '1998-01-01' AND seniority_rank >= 2 AND o_orderstatus = 'F'
""")
def query_postings(t):
    p = scored(t).withColumn("mirror_account_id", F.lit(None).cast("string"))
    out = served.query_postings(p, corpus_extracts(t), account_id="nation_6", seen_since="1998-01-01", names_tool="lim", has_org_structure=True, min_seniority=2)
    return out.records.select("posting_id", "tier2_score", F.col("team_name").alias("team"))


@query("fk_check", """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def fk_check(t):
    keys = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return quality.fk_violations(t.lineitem.select("l_orderkey", "l_linenumber"), keys, "l_orderkey")
