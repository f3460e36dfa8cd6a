"""Org units and edges assembled from verified claims. Evidence lists stay long tables, so no row grows without bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.gates import confidence
from attesta.functions.ids import edge_id, unit_id
from attesta.functions.text import afold, slug_of_team, team_slug
from attesta.operators.claims import GateFailed
from attesta.operators.skew import first_per_group, top_per_group
from attesta.session import land


def _date() -> Column:
    return F.coalesce(F.col("posted_date"), F.col("first_seen"))


def _with_posting(extracts: DataFrame, postings: DataFrame) -> DataFrame:
    """Extracts that name a team, with their unit id and the posting columns the org layer needs."""
    p = postings.select("posting_id", "site_id", "job_family", "seniority_rank", _date().alias("evidence_date"))
    named = extracts.filter(F.coalesce("team_slug", F.lit("")) != "")
    return named.withColumn("unit_id", unit_id("account_id", "team_slug")).join(p, "posting_id", "left")


def _cited(quotes: DataFrame, *kinds: str) -> DataFrame:
    """(posting_id, _q): the verified quotes of these claim types of each posting, which its text bounds: array of (claim_type, slug, quote_id)."""
    q = quotes.filter(F.col("verbatim_verified") & F.col("claim_type").isin(*kinds))
    return q.groupBy("posting_id").agg(F.collect_list(F.struct("claim_type", F.col("subject_slug").alias("slug"), "quote_id")).alias("_q"))


def unit_evidence(extracts: DataFrame, quotes: DataFrame) -> DataFrame:
    """(unit_id, posting_id, quote_id) of the verified quotes that name the unit."""
    q = quotes.filter("verbatim_verified AND claim_type = 'team_name'").select(
        "posting_id", F.col("subject_slug").alias("team_slug"), "quote_id")
    named = extracts.filter(F.coalesce("team_slug", F.lit("")) != "")
    return named.select("posting_id", "account_id", "team_slug").distinct().join(q, ["posting_id", "team_slug"]).select(
        unit_id("account_id", "team_slug").alias("unit_id"), "posting_id", "quote_id")


def unit_quotes(extracts: DataFrame, quotes: DataFrame) -> DataFrame:
    """Every quote of the postings of a unit."""
    named = extracts.filter(F.coalesce("team_slug", F.lit("")) != "")
    pairs = named.select(unit_id("account_id", "team_slug").alias("unit_id"), "posting_id").distinct()
    return pairs.join(quotes, "posting_id")


def unit_values(extracts: DataFrame, postings: DataFrame, quotes: DataFrame | None = None) -> DataFrame:
    """(unit_id, account_id, unit_slug, facet, value, n, first_at and the measures of the rows behind it): every named value of a unit, counted in
    one pass over the extracts. All lists, modes and counts of a unit come from this small table.

    Extracts hold one row per posting. Every extract of a unit has one `name`, so the measures of a unit are those of its names.
    """
    one = lambda name, c: F.struct(F.lit(name).alias("facet"), F.col(c).alias("value"), F.lit(0).alias("pos"))
    many = lambda name, c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda v, i: F.struct(
        F.lit(name).alias("facet"), v.alias("value"), i.alias("pos")))
    rows = F.concat(F.array(one("name", "team_name"), one("acronym", "team_acronym"), one("site", "site_id"), one("family", "job_family"),
                            one("manager", "hiring_manager")), many("tech", "tech_stack"), many("phrase", "vocabulary"))
    d = _with_posting(extracts, postings)
    cited = F.lit(0)
    if quotes is not None:
        # joined on the posting alone, by which the rows are dealt already
        d = d.join(_cited(quotes, "team_name"), "posting_id", "left")
        ids = F.transform(F.filter("_q", lambda x: (x["slug"] == F.col("team_slug")) & x["quote_id"].isNotNull()), lambda x: x["quote_id"])
        cited = F.when(ids.isNull(), 0).otherwise(F.size(F.array_distinct(ids)))
    d = d.select("account_id", F.col("team_slug").alias("unit_slug"), "posting_id", F.col("extraction_tier").isin(cfg.RICH_TIERS).alias("_rich"),
                 F.coalesce("seniority_rank", F.lit(1)).alias("_rank"), "evidence_date", cited.alias("_cited"), F.inline(rows))
    return d.filter(F.coalesce("value", F.lit("")) != "").groupBy("account_id", "unit_slug", "facet", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("posting_id", "pos")).alias("first_at"), F.count_if("_rich").alias("n_rich"), F.max("_rank").alias("rank_max"),
        F.min("evidence_date").alias("date_min"), F.max("evidence_date").alias("date_max"), F.sum("_cited").alias("n_cited")).withColumn("unit_id", unit_id("account_id", "unit_slug"))


def unit_facets(extracts: DataFrame, postings: DataFrame) -> DataFrame:
    """A5: (unit_id, facet, value, n) for sites, families, tools and managers; the most frequent first when ordered by n."""
    return unit_values(extracts, postings).filter(F.col("facet").isin("site", "family", "tech", "manager")).select("unit_id", "facet", "value", "n")


def unit_phrases(extracts: DataFrame, postings: DataFrame, shown: int | None = None) -> DataFrame:
    """A5: (unit_id, account_id, first_at, phrase): the distinct vocabulary phrases of a unit with the posting and place of their first use, or the `shown` first."""
    d = unit_values(extracts, postings).filter(F.col("facet") == "phrase").select("unit_id", "account_id", "first_at", F.col("value").alias("phrase"))
    return top_per_group(d, ["unit_id"], [F.col("first_at").asc(), F.col("phrase").asc()], shown) if shown else d


def assemble_units(extracts: DataFrame, postings: DataFrame, quotes: DataFrame) -> DataFrame:
    """A5: one observed unit per (account, team slug).

    Modal name, acronym and site (lowest value on ties), families by frequency, evidence dates and counts, and a derived confidence, from one join, one
    explode and one grouped pass. Site candidates, tools and managers stay in `unit_facets`, phrases in `unit_phrases`, quote ids in `unit_evidence`; only their counts are on the row.
    """
    of = lambda facet: F.col("facet") == facet
    ranked = F.struct((-F.col("n")).alias("neg"), F.col("value").alias("v"))
    mode = lambda facet, out: F.min(F.when(of(facet), ranked))["v"].alias(out)
    named = lambda c: F.when(of("name"), F.col(c))
    # seven families at most, so this list is bounded
    families = F.transform(F.array_sort(F.collect_list(F.when(of("family"), ranked))), lambda s: s["v"])
    u = unit_values(extracts, postings, quotes).groupBy("unit_id", "account_id", "unit_slug").agg(
        F.sum(named("n")).alias("n_postings"), F.sum(named("n_rich")).alias("n_postings_tier3plus"), F.max(named("rank_max")).alias("seniority_max"),
        F.min(named("date_min")).alias("first_evidence_date"), F.max(named("date_max")).alias("last_evidence_date"),
        mode("name", "unit_name"), mode("acronym", "acronym"), mode("site", "site_id"), F.count_if(of("site")).alias("n_site_candidates"),
        F.count_if(of("tech")).alias("n_tech"), F.count_if(of("manager")).alias("n_managers"), F.count_if(of("phrase")).alias("n_phrases"),
        families.alias("job_families"), F.coalesce(F.sum(named("n_cited")), F.lit(0)).alias("n_quotes"))
    u = u.withColumn("_c", confidence("n_postings", "n_postings_tier3plus", "n_quotes"))
    return (u.withColumn("unit_kind", F.lit("observed"))
            .withColumn("site_resolution", F.when(F.col("n_site_candidates") > 1, "modal_of_postings")
                        .when(F.col("n_site_candidates") == 1, "single_site"))
            .withColumn("aliases", F.array().cast("array<string>")).withColumn("status", F.lit("candidate"))
            .withColumn("confidence", F.col("_c.level")).withColumn("confidence_basis", F.col("_c.basis"))
            .withColumn("human_state", F.lit(None).cast("string")).withColumn("human_note", F.lit(None).cast("string")).drop("_c"))


def merge_acronyms(units: DataFrame, unit_postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """U16: (units, folds). A unit whose whole name is another unit's acronym folds into it as an alias.

    The host with most postings wins (then the lowest id), and a unit that folds is no host. Posting counts are recomputed
    from the union of both evidence sets. folds: (unit_id, host_id).
    """
    units = land(units)
    host = units.filter(F.col("acronym").isNotNull()).select(
        "account_id", F.col("unit_id").alias("host_id"), F.col("n_postings").alias("_hn"), team_slug("acronym").alias("unit_slug"))
    pairs = units.select("account_id", "unit_slug", "unit_id", F.col("unit_name").alias("_alias"), F.col("n_postings").alias("_n")).join(
        host, ["account_id", "unit_slug"]).filter(F.col("unit_id") != F.col("host_id"))
    rev = pairs.select(F.col("unit_id").alias("_ru"), F.col("host_id").alias("_rh"))
    loses = (F.col("_n") > F.col("_hn")) | ((F.col("_n") == F.col("_hn")) & (F.col("unit_id") < F.col("host_id")))
    mutual = pairs.join(rev, (F.col("unit_id") == F.col("_rh")) & (F.col("host_id") == F.col("_ru")), "left_semi").filter(loses)
    pairs = pairs.join(mutual.select("unit_id", "host_id"), ["unit_id", "host_id"], "left_anti")
    folds = first_per_group(pairs, ["unit_id"], [F.col("_hn").desc(), F.col("host_id").asc()])
    folds = land(folds)
    folds = land(folds.join(folds.select(F.col("unit_id").alias("host_id")), "host_id", "left_anti").select("unit_id", "host_id", "_alias"))
    named = folds.groupBy(F.col("host_id").alias("unit_id")).agg(F.array_sort(F.collect_set("_alias")).alias("_aliases"))
    # the postings of hosts and of what folds into them; other units keep their counts
    members = folds.select("unit_id", "host_id").unionByName(folds.select(F.col("host_id").alias("unit_id"), "host_id").distinct())
    moved = unit_postings.join(members, "unit_id").select(F.col("host_id").alias("unit_id"), "posting_id")
    counts = moved.groupBy("unit_id").agg(F.count_distinct("posting_id").alias("_union"))
    kept = units.join(folds.select("unit_id"), "unit_id", "left_anti").join(named, "unit_id", "left").join(counts, "unit_id", "left")
    kept = (kept.withColumn("aliases", F.coalesce("_aliases", "aliases"))
            .withColumn("n_postings", F.when(F.col("_aliases").isNotNull(), F.col("_union")).otherwise(F.col("n_postings"))))
    return kept.select(*units.columns), folds.select("unit_id", "host_id")


def _folded(extracts: DataFrame) -> DataFrame:
    """What edges read of extracts; _folds: their parent, stated site and supported teams folded, null where they are ASCII, which folds to itself.

    Folding takes a row through Python, so only rows with a label beyond ASCII go there.
    """
    d = extracts.withColumn("_labels", F.filter(F.coalesce("supports_teams", F.array().cast("array<string>")), lambda l: F.coalesce(l, F.lit("")) != ""))
    text = F.concat_ws("\n", "parent_org", "site_stated", F.array_join("_labels", "\n"))
    ascii_ = F.octet_length(text) == F.char_length(text)
    folds = F.struct(afold("parent_org").alias("parent"), afold("site_stated").alias("stated"), F.split(afold(F.array_join("_labels", "\n")), "\n").alias("labels"))
    cols = ["posting_id", "account_id", "team_name", "team_slug", "parent_org", "site_stated", "extraction_tier", "_labels"]
    other = d.filter(~ascii_).select(*cols, folds.alias("_folds"))
    return d.filter(ascii_).select(*cols, F.lit(None).cast(other.schema["_folds"].dataType).alias("_folds")).unionByName(other)


def gated_edges(extracts: DataFrame, postings: DataFrame, quotes: DataFrame) -> DataFrame:
    """G1: one row per (edge, posting, quote): no verified quote of the right type and subject, no reporting or support edge.

    located_at comes from the posting's site and cites its site quote, else its team quote, else nothing (quote_id null). The verified quotes of
    a posting, which its text bounds, are gathered once and joined once; all edges of an extract come from one explode.
    """
    q = _cited(quotes, "parent_org", "supports_team", "site_stated", "team_name")
    d = _with_posting(_folded(extracts), postings).join(q, "posting_id", "left")
    # slugs are columns of their own, as the lambdas below would make them again for every quote; without a verified quote none is asked for
    quoted = lambda c: F.when(F.col("_q").isNotNull(), c)
    d = d.withColumn("_parent", quoted(slug_of_team(F.coalesce("_folds.parent", "parent_org")))).withColumn("_stated", quoted(slug_of_team(F.coalesce("_folds.stated", "site_stated"))))
    pairs = F.arrays_zip(F.col("_labels").alias("label"), F.coalesce("_folds.labels", "_labels").alias("folded"))
    pairs = F.transform(pairs, lambda l: F.struct(slug_of_team(l["folded"]).alias("slug"), l["label"].alias("label")))
    d = d.withColumn("_supports", quoted(F.filter(pairs, lambda s: s["label"].isNotNull())))
    cited = lambda kind, slug: F.transform(F.filter("_q", lambda x: (x["claim_type"] == kind) & (x["slug"] == slug)), lambda x: x["quote_id"])
    row = lambda kind, slug, site, label, quote: F.struct(F.lit(kind).alias("edge_type"), slug.cast("string").alias("_slug"), site.cast("string").alias("dst_site_id"),
                                                          label.cast("string").alias("dst_label"), quote.cast("string").alias("quote_id"))
    null, none = F.lit(None), F.array()
    parent = F.when(F.coalesce("parent_org", F.lit("")) != "", F.transform(cited("parent_org", F.col("_parent")), lambda c: row("reports_to", F.col("_parent"), null, F.col("parent_org"), c)))
    support = F.flatten(F.transform("_supports", lambda s: F.transform(cited("supports_team", s["slug"]), lambda c: row("supports", s["slug"], null, s["label"], c))))
    by_site, by_team = cited("site_stated", F.col("_stated")), cited("team_name", F.col("team_slug"))
    sources = F.when(F.size(by_site) > 0, by_site).when(F.size(by_team) > 0, by_team).otherwise(F.array(F.lit(None).cast("string")))
    located = F.when(F.col("site_id").isNotNull(), F.transform(sources, lambda c: row("located_at", null, F.col("site_id"), F.col("site_id"), c)))
    kind = "array<struct<edge_type:string,_slug:string,dst_site_id:string,dst_label:string,quote_id:string>>"
    edges = F.concat(*[F.coalesce(x.cast(kind), none.cast(kind)) for x in (parent, support, located)])
    # without a verified quote there is the site alone
    edges = F.when(F.col("_q").isNotNull(), edges).when(F.col("site_id").isNotNull(), F.array(row("located_at", null, F.col("site_id"), F.col("site_id"), null)).cast(kind))
    out = d.select("account_id", F.col("unit_id").alias("src_unit_id"), F.col("team_name").alias("src_label"), "posting_id", "evidence_date", "extraction_tier", F.inline(edges))
    return out.select("account_id", "edge_type", "src_unit_id", F.when(F.col("_slug").isNotNull(), unit_id("account_id", "_slug")).alias("dst_unit_id"), "dst_site_id", "src_label",
                      "dst_label", "posting_id", "quote_id", "evidence_date", "extraction_tier")


def refold_edges(claims: DataFrame, folds: DataFrame) -> DataFrame:
    """Edges of a folded unit: its own claims fall away, claims that point at it point at its host."""
    own = claims.join(folds.select(F.col("unit_id").alias("src_unit_id")), "src_unit_id", "left_anti")
    dst = folds.select(F.col("unit_id").alias("dst_unit_id"), F.col("host_id").alias("_h"))
    return own.join(dst, "dst_unit_id", "left").withColumn("dst_unit_id", F.coalesce("_h", "dst_unit_id")).select(*claims.columns)


def assemble_edges(claims: DataFrame) -> DataFrame:
    """One edge per (account, type, source, destination) with distinct posting and quote counts, dates and confidence.

    Claims are reduced to (edge, posting) first, so all counts are plain ones; claims that are dealt by posting are not shuffled for that. Quote ids stay in `claims`, which is the provenance table of an edge.
    """
    key = ["edge_type", "src_unit_id", "dst_unit_id", "dst_site_id", "account_id"]
    per = claims.groupBy("posting_id", *key).agg(
        F.min("src_label").alias("src_label"), F.min("dst_label").alias("dst_label"), F.count_distinct("quote_id").alias("_quotes"),
        F.max(F.col("extraction_tier").isin(cfg.RICH_TIERS)).alias("_rich"), F.min("evidence_date").alias("_lo"), F.max("evidence_date").alias("_hi"))
    e = per.groupBy(*key).agg(
        F.min("src_label").alias("src_label"), F.min("dst_label").alias("dst_label"), F.count(F.lit(1)).alias("n_postings"), F.sum("_quotes").alias("n_quotes"),
        F.count_if("_rich").alias("n_postings_tier3plus"), F.min("_lo").alias("first_evidence_date"), F.max("_hi").alias("last_evidence_date"))
    dst = F.coalesce("dst_unit_id", "dst_site_id")
    e = e.select(edge_id("account_id", "edge_type", "src_unit_id", dst).alias("edge_id"), "account_id", "edge_type", "src_unit_id", "dst_unit_id", "dst_site_id", *[c for c in e.columns if c not in key])
    return (e.withColumn("_c", confidence("n_postings", "n_postings_tier3plus", "n_quotes"))
            .withColumn("confidence", F.col("_c.level")).withColumn("confidence_basis", F.col("_c.basis"))
            .withColumn("status", F.lit("candidate")).withColumn("human_state", F.lit(None).cast("string"))
            .withColumn("human_note", F.lit(None).cast("string")).drop("_c"))


def add_ghosts(units: DataFrame, edges: DataFrame) -> DataFrame:
    """Units plus one `named_not_mapped` unit per edge destination that was never reconstructed."""
    ends = edges.filter(F.col("dst_unit_id").isNotNull()).groupBy(F.col("dst_unit_id").alias("unit_id"), "account_id").agg(
        F.min("dst_label").alias("unit_name"))
    ghosts = ends.join(units.select("unit_id"), "unit_id", "left_anti")
    slug = F.element_at(F.split("unit_id", "--ou-"), -1)
    given = {"unit_id": F.col("unit_id"), "account_id": F.col("account_id"), "unit_name": F.col("unit_name"), "unit_slug": slug,
             "unit_kind": F.lit("named_not_mapped"), "status": F.lit("candidate"), "confidence": F.lit("low"),
             "confidence_basis": F.lit("named in a posting; no unit of its own was reconstructed")}
    zeros = {"n_postings", "n_postings_tier3plus", "n_quotes", "n_site_candidates", "n_tech", "n_managers", "n_phrases"}
    row = [given[f.name] if f.name in given else (F.lit(0) if f.name in zeros else F.lit(None)).cast(f.dataType) for f in units.schema]
    return units.unionByName(ghosts.select(*[c.alias(f.name) for c, f in zip(row, units.schema)]))


def first_parent(edges: DataFrame) -> DataFrame:
    """(unit_id, parent_id, parent_label, parent_conf, n_postings): the reporting edge with most postings, then lowest id.

    Rejected edges and self loops are out.
    """
    up = edges.filter((F.col("edge_type") == "reports_to") & (F.col("status") != "rejected") & (F.col("src_unit_id") != F.col("dst_unit_id")))
    best = first_per_group(up, ["src_unit_id"], [F.col("n_postings").desc(), F.col("edge_id").asc()])
    return best.select(F.col("src_unit_id").alias("unit_id"), F.col("dst_unit_id").alias("parent_id"),
                       F.col("dst_label").alias("parent_label"), F.col("confidence").alias("parent_conf"), "n_postings")


def with_parent(units: DataFrame, parents: DataFrame) -> DataFrame:
    p = parents.select("unit_id", F.col("parent_id").alias("parent_unit_id"), "parent_label", "parent_conf")
    return units.join(p, "unit_id", "left")


def apply_overrides(df: DataFrame, verdicts: DataFrame, renames: DataFrame | None = None, key: str = "unit_id",
                    name: str = "unit_name") -> DataFrame:
    """Confirm promotes to human confidence, reject marks rejected, renames change the display name; unknown ids are
    ignored. verdicts: (key, v, note); renames: (key, name)."""
    v = verdicts.select(F.col(key).alias("_k"), "v", F.coalesce("note", F.lit("")).alias("note"))
    d = df.join(v, F.col(key) == F.col("_k"), "left")
    yes, no = F.col("v") == "confirm", F.col("v") == "reject"
    basis = F.concat(F.lit("confirmed by a person"), F.when(F.col("note") != "", F.concat(F.lit(" -- "), "note")).otherwise(""))
    d = (d.withColumn("status", F.when(yes, "promoted").when(no, "rejected").otherwise(F.col("status")))
         .withColumn("confidence", F.when(yes, "human").otherwise(F.col("confidence")))
         .withColumn("confidence_basis", F.when(yes, basis).otherwise(F.col("confidence_basis")))
         .withColumn("human_state", F.coalesce("v", "human_state")).withColumn("human_note", F.coalesce("note", "human_note"))
         .drop("_k", "v", "note"))
    if renames is None:
        return d
    r = renames.select(F.col(key).alias("_k"), F.col("name").alias("_n"))
    return d.join(r, F.col(key) == F.col("_k"), "left").withColumn(name, F.coalesce("_n", name)).drop("_k", "_n")


def gap_flags(units: DataFrame) -> DataFrame:
    """Adds gap_flags, the data-quality gaps of a unit in a fixed order."""
    ghost = F.col("unit_kind") == "named_not_mapped"
    seen = F.col("unit_kind") == "observed"
    one = F.col("n_postings") == 1
    no_site = F.col("site_id").isNull()
    acro = F.coalesce(F.length("acronym"), F.lit(0))
    bare = F.coalesce(F.size("aliases"), F.lit(0)) <= 0
    flags = [(ghost, "mention_only"), (F.col("parent_unit_id").isNull() & seen, "no_parent"), (no_site, "no_site"),
             (~no_site & (F.col("n_site_candidates") > 1), "site_split"), (one, "single_posting"),
             (F.col("n_tech") == 0, "no_tech"), (F.col("n_managers") == 0, "no_named_people"),
             ((acro > 0) & (acro <= 5) & bare & one, "acronym_unexpanded"),
             (seen & (F.col("n_postings_tier3plus") == 0), "archive_only_evidence")]
    return units.withColumn("gap_flags", F.array_compact(F.array(*[F.when(c, n) for c, n in flags])))


def split_unquoted(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V7: (edges that may be written, edges for the quarantine table)."""
    ok = (F.col("n_quotes") > 0) | (F.coalesce("human_state", F.lit("")) == "confirm")
    return edges.filter(ok), edges.filter(~ok)


def guard_edges(edges: DataFrame) -> None:
    """V7, strict: raise on any edge without a verified quote that no person confirmed."""
    bad = split_unquoted(edges)[1].select("edge_id").first()
    if bad:
        raise GateFailed(f"edge without a verified quote: {bad['edge_id']}")


def coverage(spine: DataFrame, postings: DataFrame, extracts: DataFrame, units: DataFrame) -> DataFrame:
    """Per site the indexed, admitted, bodied and extracted postings, the units, and a coverage state.

    first_seen and last_seen are the real minimum and maximum of the site's postings.
    """
    key = ["account_id", "site_id"]
    done = extracts.select("posting_id").distinct().withColumn("_done", F.lit(True))
    idx = postings.join(done, "posting_id", "left").groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_indexed"), F.count_if("tier2_admit").alias("n_admitted"),
        F.count_if(F.col("extraction_tier").rlike("^tier[234]_")).alias("n_bodies"), F.count("_done").alias("n_extracts"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    un = units.filter(F.col("site_id").isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("n_units"))
    swept = idx.select("account_id").distinct().withColumn("_swept", F.lit(True))
    d = spine.join(idx, key, "left").join(un, key, "left").join(swept, "account_id", "left")
    d = d.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_indexed", "n_admitted", "n_bodies", "n_extracts", "n_units")})
    state = (F.when(F.col("_swept").isNull(), "never_scanned").when(F.col("n_indexed") == 0, "scanned_none_found")
             .when(F.col("n_extracts") == 0, "indexed_not_extracted").otherwise("covered"))
    return d.withColumn("coverage_state", state).drop("_swept")


def supports_labels(edges: DataFrame) -> DataFrame:
    """(unit_id, label) of the teams a unit supports."""
    return edges.filter((F.col("edge_type") == "supports") & (F.col("status") != "rejected")).select(
        F.col("src_unit_id").alias("unit_id"), F.col("dst_label").alias("label")).distinct()
