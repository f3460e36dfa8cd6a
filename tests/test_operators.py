from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import (claims, dedupe, graph, marts, mix, org, parse, quality, resolve, rules, sampling, scoring, scrub, skew,
                               stories, tallies, upsert, verdicts)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---------------------------------------------------------------- groups under skew
def test_rank_within_hot_group(spark):
    d = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("g"),
                                 F.xxhash64("id").alias("v"), "id")
    got = {r["id"]: r["rank"] for r in skew.rank_within(d, ["g"], [("v", "desc"), "id"]).collect()}
    groups = {}
    for r in d.collect():
        groups.setdefault(r["g"], []).append(r)
    for members in groups.values():
        for i, r in enumerate(sorted(members, key=lambda r: (-r["v"], r["id"])), 1):
            assert got[r["id"]] == i


def test_top_per_group_is_pruned_before_the_shuffle(spark):
    plan = skew.top_per_group(spark.range(100).withColumn("g", F.col("id") % 3), ["g"], [F.col("id").asc()], 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_modal_ties_take_the_lowest(spark):
    d = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "z"), ("b", "z"), ("b", "q")], "g string, v string")
    assert rows(skew.modal(d, ["g"], "v", count="n"), "g", "v", "n") == [("a", "x", 1), ("b", "z", 2)]


# ---------------------------------------------------------------- resolution
@pytest.fixture(scope="module")
def site_index(spark):
    sites = spark.createDataFrame([
        ("a1", "a", "Cambridge, MA", "Boston"), ("a2", "a", "Cambridge, UK", None), ("a3", "a", "Mölndal (Gothenburg)", "Västra"),
        ("a4", "a", "New Haven, CT", None), ("a5", "a", "Durham, NC", None), ("a6", "a", "Raleigh, NC", None),
        ("b1", "b", "New Haven, CT", None), ("b2", "b", "Bothell", None)], "site_id string, account_id string, city string, metro string")
    syn = spark.createDataFrame([("rtp", "durham"), ("rtp", "raleigh"), ("kendallsquare", "newhaven"), ("durham", "raleigh")], "synonym string, target string")
    return resolve.build_site_index(sites, syn)


def test_resolve_tiers(spark, site_index):
    d = spark.createDataFrame([("1", "a", "cambridge"), ("2", "a", "gothenburg"), ("3", "a", "boston"), ("4", "a", "rtp"), ("5", "a", "durham"),
                               ("6", "a", "kendallsquare"), ("7", "a", "paris"), ("8", "a", ""), ("9", "z", "cambridge"), ("10", "a", None)],
                              "posting_id string, account_id string, city_key string")
    picks = spark.createDataFrame([("a", "boston", "a2")], "account_id string, city_key string, site_id string")
    got = {r["posting_id"]: (r["site_id"], r["site_resolution"], r["n_site_candidates"]) for r in resolve.resolve(d, site_index, picks).collect()}
    assert got["1"] == (None, "ambiguous", 2)
    assert got["2"] == ("a3", "alias", 1)
    assert got["3"] == ("a2", "human", 1)
    assert got["4"] == (None, "ambiguous", 2)
    assert got["5"] == ("a5", "exact_city", 1)  # a synonym that is a real city never outranks it
    assert got["6"] == ("a4", "alias", 1)
    assert got["7"][1] == "city_not_in_sites" and got["9"][1] == "city_not_in_sites"
    assert got["8"] == (None, "unmatched", 0) and got["10"][1] == "unmatched"


def test_mirror_basis(spark, site_index):
    d = spark.createDataFrame([("1", "a", "newhaven"), ("2", "a", "bothell"), ("3", "a", "durham"), ("4", "b", "newhaven")],
                              "posting_id string, account_id string, city_key string")
    subs = spark.createDataFrame([("a", "b", 0)], "parent string, child string, ord int")
    out = resolve.mirror(d, site_index, subs)
    assert rows(out.na.fill(""), "posting_id", "mirror_site_id", "mirror_basis") == [
        ("1", "b1", "dual_registered"), ("2", "b2", "subsidiary_only"), ("3", "", ""), ("4", "", "")]


def test_title_site_needs_one_hit(spark):
    sites = spark.createDataFrame([("s1", "a", "New Haven", None), ("s2", "a", "Durham", None), ("s3", "a", "Durham / Apex", None)],
                                  "site_id string, account_id string, city string, metro string")
    d = spark.createDataFrame([("1", "a", "Engineer, New Haven plant"), ("2", "a", "Engineer Durham"), ("3", "a", "Apex Lead")],
                              "posting_id string, account_id string, role_title string")
    assert rows(resolve.title_site(d, resolve.site_keys(sites)), "posting_id", "title_site_id") == [("1", "s1"), ("3", "s3")]


# ---------------------------------------------------------------- rules
def test_classify_admit_score(spark):
    d = spark.createDataFrame([("automation-engineer-summer-intern", "yes"), ("director-commercial-data-platform", "yes"), ("qc-analyst", "soft"),
                               ("lead-formulation-scientist", "yes"), ("downstream-scientist-unicorn", "yes"), ("sales-manager", "yes"), ("senior-data-engineer", "no")],
                              "role_slug string, icp_fit string")
    out = rules.classify(d).withColumn("admit", rules.admit())
    got = {r["role_slug"]: (r["job_family"], r["seniority_rank"], r["excluded"], r["admit"]) for r in out.collect()}
    assert got["automation-engineer-summer-intern"] == ("automation_mes", 1, "hard:summer-intern", False)
    assert got["director-commercial-data-platform"] == ("data_digital", 5, "soft:commercial", True)
    assert got["qc-analyst"][3] is False and got["lead-formulation-scientist"][3] is True
    assert got["downstream-scientist-unicorn"][0] == "lab_systems"
    assert got["sales-manager"][:3] == ("", 1, "soft:sales") and got["senior-data-engineer"][3] is False


def test_email_status(spark):
    d = spark.createDataFrame([("a", "m.c@acme.com", "found"), ("a", "ann@old.org", "found"), ("a", "ann@eu.acme.co.uk", None), ("a", None, "not_found")],
                              "account_id string, email string, email_status string")
    dom = spark.createDataFrame([("a", "acme.com")], "account_id string, domain string")
    got = [r["email_checked"] for r in rules.email_status(d, dom).orderBy(F.monotonically_increasing_id()).collect()]
    assert sorted(map(str, got)) == ["found", "not_found", "suspect", "suspect_domain"]


# ---------------------------------------------------------------- verdict chain
BASE = dict(support_p=0.05, research_p=0.05, drug_substance_p=0.95, pd_msat_p=0.05, drug_product_p=0.05, manufacturing_p=0.5, cdmo_p=0.05, modality="biologic_only",
            modality_conf=0.9, business="human_pharma", business_conf=0.9, closed=0.0, planned=0.0)
CASES = [
    ({}, ("KEEP", "", "")), ({"cdmo_p": 0.9}, ("KEEP", "CDMO", "")), ({"cdmo_p": 0.5}, ("REVIEW", "cdmo?", "cdmo")),
    ({"closed": 0.8}, ("CLOSED", "closed", "")), ({"planned": 0.85}, ("GAP", "greenfield", "")), ({"closed": 0.15, "planned": 0.06}, ("REVIEW", "status?", "status")),
    ({"closed": 0.1, "planned": 0.09}, ("KEEP", "", "")),
    ({"drug_substance_p": 0.05, "manufacturing_p": 0.2, "support_p": 0.8}, ("DROP", "support-only", "")),
    ({"drug_substance_p": 0.05, "manufacturing_p": 0.05, "research_p": 0.9}, ("FLAG", "R&D-only", "")),
    ({"drug_substance_p": 0.05, "manufacturing_p": 0.05}, ("FLAG", "unclear-mfg", "")),
    ({"drug_substance_p": 0.05, "manufacturing_p": 0.5}, ("REVIEW", "manufacturing?", "manufacturing")),
    ({"business": "consumer_or_nutrition"}, ("FLAG", "non-core", "")), ({"business_conf": 0.5}, ("REVIEW", "business?", "business")),
    ({"modality": "mixed"}, ("FLAG", "mixed", "")), ({"modality": "not_stated"}, ("REVIEW", "modality?", "modality")),
    ({"modality": "small_molecule_only", "cdmo_p": 0.5}, ("FLAG", "small-mol", "")),  # the unsure answer is not reached
]


@pytest.mark.parametrize("change, want", CASES)
def test_site_verdict_chain(spark, change, want):
    row = {**BASE, **change}
    d = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'string' if k in ('modality', 'business') else 'double'}" for k in row))
    got = d.select(verdicts.verdict_struct(F.col("closed"), F.col("planned")).alias("v")).first()["v"]
    assert (got["verdict"], got["tag"], got["unsure_on"]) == want


def test_final_verdict_latest_run_wins(spark):
    fit = spark.createDataFrame([("s1", "a", "KEEP", "FLAG", "x", ""), ("s2", "a", "GAP", "CLOSED", "closed", ""), ("s3", "a", "KEEP", "REVIEW", "", "cdmo"), ("s4", "a", "DROP", "KEEP", "", "")],
                                "site_id string, account_id string, policy_verdict string, model_verdict string, reason_tag string, unsure_on string")
    runs = spark.createDataFrame([("s1", 1, "DROP", "old", "u1"), ("s1", 2, "FLAG", "animal health", "u2"), ("s4", 1, "NEEDS_PERSON", "?", "u")],
                                 "site_id string, run int, final_verdict string, reason string, source_url string")
    assert rows(verdicts.final_verdict(fit, runs), "site_id", "verdict", "basis", "reason") == [
        ("s1", "KEEP", "checked", "animal health (animal health is KEEP)"), ("s2", "GAP", "readings agree", "closed"),
        ("s3", "REVIEW", "not checked", "cdmo"), ("s4", "REVIEW", "needs person", "sources conflict")]


# ---------------------------------------------------------------- scoring
def test_scoring_only_pays_misses_and_keeps_errors_out(spark):
    items = spark.createDataFrame([("1", "data lead"), ("2", "data lead"), ("3", "cook")], "item_id string, title string")
    reqs = scoring.requests(scoring.question_bank(items, [("digital", "noul", [])]), ["title"])
    empty = spark.createDataFrame([], "request_hash string, p double, choice string, confidence double, probs map<string,double>")
    asked = []

    def scorer(d):
        asked.append(d.count())
        out = scoring.rule_scorer("title", {"digital": "data"})(d)
        return out.withColumn("error", F.when(F.col("p") < 0.5, "failed"))

    first, cache = scoring.score(reqs, empty, scorer)
    assert asked == [2] and rows(first, "item_id", "p") == [("1", 0.95), ("2", 0.95), ("3", pytest.approx(0.05))]
    scoring.score(reqs, cache, scorer)
    assert asked == [2, 1]
    with pytest.raises(scoring.BudgetExceeded):
        scoring.require_budget(scoring.budget_gate(reqs.withColumn("t", F.lit(10)), empty, "t", 1.0, 5.0))


# ---------------------------------------------------------------- the verbatim gate
def test_verify_quotes(spark):
    body = 'We said “it’s process-led work” … and later the team builds digital twins for purification. Naïve R&amp;D notes follow here.'
    bodies = spark.createDataFrame([("p", body)], "posting_id string, text string")
    cases = {"the team builds digital twins": "exact", '"it\'s process-led work"': "soft", "Naïve R&D notes follow": "soft", "THE TEAM BUILDS, DIGITAL TWINS": "hard",
             "it's process-led work... the team builds digital": "elided", "the crew builds digital twins": "not_found", "team": "too_short", "": "empty"}
    q = spark.createDataFrame([("p", k) for k in cases] + [("none", "the team builds digital twins")], "posting_id string, quote_text string")
    got = {(r["posting_id"], r["quote_text"]): r["match_method"] for r in claims.verify_quotes(q, bodies).collect()}
    assert {k: got["p", k] for k in cases} == cases and got["none", "the team builds digital twins"] == "empty"
    off = {r["quote_text"]: r["match_method"] for r in claims.verify_quotes(q, bodies, elided=False).collect()}
    assert off["it's process-led work... the team builds digital"] == "not_found"


def test_find_quotes_equals_brute_force(spark):
    rnd = random.Random(7)
    words = ["al", "beta", "gam", "delta", "eps", "zeta-long", "e"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60)))) for i in range(60)]
    quotes = []
    for i in range(120):
        src = rnd.choice(docs)[1]
        a = rnd.randint(0, max(0, len(src) - 12))
        quotes.append((i, src[a:a + rnd.choice([0, 1, 3, 8, 12, 14, 20, 40])] + rnd.choice(["", "", "x"])))
    want = sorted((q, d) for q, t in quotes for d, b in docs if t and t in b)
    found = claims.find_quotes(spark.createDataFrame(quotes, "item_id int, text string"), spark.createDataFrame(docs, "doc_id int, text string"), "item_id", "doc_id")
    assert rows(found, "item_id", "doc_id") == want


def test_claims_survive_only_with_evidence(spark):
    schema = ("posting_id string, team_name string, team_acronym string, parent_org string, hiring_manager string, reports_to_title string, site_stated string, "
              "supports_teams array<struct<team:string>>, tech_stack array<struct<tool:string>>")
    ex = spark.createDataFrame([("p", "Data Team", "DT", "Acme Group", "Bo Li", None, None, [("FP&A",), ("Legal",)], [("LIMS",), ("SAP",)]),
                                ("q", "Ghost", None, None, None, None, None, [], [])], schema)
    q = spark.createDataFrame([("p", "team_name", "the data team", "join our data team", True), ("p", "parent_org", "Acme Group", "part of Acme Group", True),
                               ("p", "supports_team", "FP&amp;A and others", "to FP&amp;A and legal teams", True), ("p", "tech", "LIMS", "runs LIMS", True),
                               ("p", "tech", "SAP", "runs SAP", False)], "posting_id string, claim_type string, subject string, quote_text string, verbatim_verified boolean")
    acme = spark.createDataFrame([("Acme",)], "company string")
    got = {r["posting_id"]: r for r in claims.drop_unsupported(ex, q, acme).collect()}
    p = got["p"]
    assert (p["team_name"], p["parent_org"], p["team_acronym"], p["hiring_manager"]) == ("Data Team", None, "DT", None)
    assert p["supports_teams"] == ["FP&A", "Legal"] and p["tech_stack"] == ["LIMS"]
    assert sorted(p["dropped"]) == ["hiring_manager", "parent_org(boilerplate)", "tech:SAP"] and p["extract_status"] == "ok"
    assert got["q"]["extract_status"] == "thin"


def test_guards_raise(spark):
    none = spark.createDataFrame([], "verbatim_verified boolean")
    with pytest.raises(claims.GateFailed):
        claims.require_pass_rate(none)
    with pytest.raises(claims.GateFailed):
        claims.require_pass_rate(spark.createDataFrame([(True,)] * 94 + [(False,)] * 6, "verbatim_verified boolean"))
    claims.require_pass_rate(spark.createDataFrame([(True,)] * 95 + [(False,)] * 5, "verbatim_verified boolean"))
    with pytest.raises(claims.GateFailed):
        quality.guard_shrink(spark.range(100), spark.range(97))
    quality.guard_shrink(spark.range(100), spark.range(98))
    edges = spark.createDataFrame([("e1", 0, None), ("e2", 0, "confirm"), ("e3", 2, None)], "edge_id string, n_quotes int, human_state string")
    good, bad = org.split_unquoted(edges)
    assert rows(good, "edge_id") == [("e2",), ("e3",)] and rows(bad, "edge_id") == [("e1",)]
    with pytest.raises(claims.GateFailed):
        org.guard_edges(edges)


# ---------------------------------------------------------------- state
def test_accretion_is_idempotent_and_widens(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    s = spark.createDataFrame([("k", "r1", t(5)), ("k", "r1", t(6)), ("k", "r2", t(9)), ("j", "r2", t(1))], "posting_id string, run_id string, seen_at timestamp")
    state = upsert.accrete(s, "posting_id")
    log = upsert.per_run(s, ["posting_id"])
    shown = lambda d: rows(d, "posting_id", "first_seen", "last_seen", "seen_count")
    for replay in ("r1", "r2"):  # any old run, not the last alone
        again, _ = upsert.accrete_into(state, log, s.filter(F.col("run_id") == replay), "posting_id")
        assert shown(again) == shown(state)
    late = spark.createDataFrame([("k", "r3", t(2)), ("k", "r1", t(12)), ("n", "r3", t(3))], s.schema)
    grown, more = upsert.accrete_into(state, log, late, "posting_id")
    assert shown(grown) == [("j", t(1), t(1), 1), ("k", t(2), t(12), 3), ("n", t(3), t(3), 1)]
    assert shown(upsert.accrete_into(grown, log.unionByName(more), late, "posting_id")[0]) == shown(grown)


def test_tier_never_falls(spark):
    cols = "posting_id string, extraction_tier string, run_seq int, body string"
    old = spark.createDataFrame([("p", "tier3_live_body", 1, "rich"), ("q", "tier1_shell", 1, "x")], cols)
    new = spark.createDataFrame([("p", "tier2_archive_body", 2, "cheap"), ("q", "tier1_shell", 2, "y"), ("r", "odd", 2, "z")], cols)
    assert rows(upsert.tier_upsert(old, new, "posting_id"), "posting_id", "body") == [("p", "rich"), ("q", "y"), ("r", "z")]


def test_spine_dedupe_prefers_a_named_head_at_the_first_position(spark):
    d = spark.createDataFrame([(1, "a", "Plant (old)", "X", ""), (4, "a", "plant", "x", "Ann"), (6, "a", "Plant", "X", "Bo"), (2, "a", "Lab", "X", "")],
                              "row_no long, account_id string, site string, city string, named_site_head string")
    assert rows(dedupe.dedupe_spine(d), "row_no", "site", "named_site_head") == [(1, "plant", "Ann"), (2, "Lab", "")]


def test_site_targets_cap_and_late_join(spark):
    sites = spark.createDataFrame([(f"s{i}", "a", f"City{chr(97 + i)}lo", "") for i in range(8)] + [("s8", "a", "Cityalo", ""), ("s9", "a", "Cityblo", "Drop")],
                                  "site_id string, account_id string, city string, verdict_manual string")
    v = spark.createDataFrame([(f"s{i}", "KEEP" if i % 2 else "FLAG", False) for i in range(10)], "site_id string, verdict string, closed boolean")
    out = upsert.site_targets(sites, v, cap=3)
    assert rows(out, "rank", "site_id") == [(1, "s1"), (2, "s3"), (3, "s5")]
    out = upsert.site_targets(sites, v, cap=5)
    assert (5, "s0") in rows(out, "rank", "site_id") and (5, "s8") in rows(out, "rank", "site_id")


# ---------------------------------------------------------------- stories
def jaccard_greedy(items, thr):
    kept = []
    for key, block, when, words in sorted(items, key=lambda r: (-r[2], r[0])):
        if not any(b == block and words and len(words & w) / len(words | w) >= thr for _, b, w in kept):
            kept.append((key, block, words))
    return sorted(k for k, _, _ in kept)


@pytest.mark.parametrize("pivots", [32, 3])
def test_story_suppression_equals_greedy(spark, pivots):
    rnd = random.Random(3)
    vocab = [f"word{i}" for i in range(12)]
    items = []
    for i in range(70):
        words = set(rnd.sample(vocab, rnd.randint(0, 5)))
        items.append((i, "hot" if rnd.random() < 0.7 else "cold", rnd.randint(0, 30), words))
    d = spark.createDataFrame([(i, b, w, " ".join(sorted(s))) for i, b, w, s in items], "item_id int, block string, published int, title string")
    got = stories.suppress_near_dups(d, "block", thr=0.5, pivots=pivots)
    assert [r[0] for r in rows(got, "item_id")] == jaccard_greedy(items, 0.5)


def test_story_rounds_follow_chains_not_blocks(spark):
    """A block of unlike stories takes as many rounds at ten times the size."""
    taken = []
    for n in (40, 400):
        d = spark.createDataFrame([(i, "hot", i, f"same{i % 3} alpha{i} beta{i} gamma{i}") for i in range(n)], "item_id int, block string, published int, title string")
        rounds: list[int] = []
        assert stories.suppress_near_dups(d, "block", thr=0.5, rounds=rounds).count() == n
        taken.append(len(rounds))
    assert taken[0] == taken[1] == 1


@pytest.mark.parametrize("tile,thr", [(25, 0.25), (40, 0.5), (8192, 0.5)])
def test_story_tiles_equal_greedy(spark, tile, thr):
    """Blocks of one tile and of many, one without a name, sets of one word to hundreds, chains and groups of near copies."""
    rnd = random.Random(tile)
    vocab = [f"word{i}" for i in range(700)]
    items, texts = [], []
    for i in range(150):
        words = set(rnd.sample(vocab[:15], rnd.randint(0, 6)) if i % 3 else rnd.sample(vocab, rnd.choice((40, 70, 300))))
        if texts and rnd.random() < 0.4:
            words = set(rnd.choice(texts))
            words = set(rnd.sample(sorted(words), rnd.randint(len(words) // 2, len(words)))) | set(rnd.sample(vocab, rnd.randint(0, 3)))
        texts.append(words)
        items.append((i, rnd.choice(("hot", "hot", "hot", None)), rnd.randint(0, 30), words))
    d = spark.createDataFrame([(i, b, w, " ".join(sorted(s))) for i, b, w, s in items], "item_id int, block string, published int, title string")
    rounds: list[int] = []
    got = stories.suppress_near_dups(d, "block", thr=thr, tile=tile, rounds=rounds)
    none = [i for i, _, _, words in items if not words]
    assert [r[0] for r in rows(got, "item_id")] == sorted(none + jaccard_greedy([x for x in items if x[3]], thr))
    assert (len(rounds) == 1) == (tile == 8192)


def test_story_tiles_write_no_row_for_each_word(spark, monkeypatch):
    """Blocks of a usual size go without postings of words, and items without a time or an id are left alone."""
    monkeypatch.setattr(stories, "postings", None)
    d = spark.createDataFrame([(1, "b", 5, "alpha beta gamma"), (2, "b", 4, "alpha beta gamma delta"), (3, "b", None, "alpha beta gamma echo"), (4, "b", 1, None), (None, "b", 9, "alpha beta delta")],
                              "item_id int, block string, published int, title string")
    assert rows(stories.suppress_near_dups(d, "block", thr=0.5), "item_id") == [(1,), (3,), (4,)]


# ---------------------------------------------------------------- nothing is cut
def test_quotes_and_names_of_any_length(spark):
    q = spark.createDataFrame([("p", "team", "s", "x" * 80 + "one"), ("p", "team", "s", "x" * 80 + "two")], "posting_id string, claim_type string, subject_slug string, quote_text string")
    q = q.withColumn("quote_hash", dedupe.quote_key()[-1])
    key = ["posting_id", "claim_type", "subject_slug", "quote_hash"]
    assert dedupe.append_dedupe(q.limit(0), q, key, ["quote_text"]).count() == 2
    long = "Ann " + "van der " * 10 + "Lee"
    assert rows(dedupe.roster(spark.createDataFrame([(long,), ("Ann",)], "name string")), "name") == [(long,)]
    urls = spark.createDataFrame([("a", "n", "t", "u" * 120 + "1", 1), ("a", "n", "t", "u" * 120 + "2", 2)], "account_id string, signal_type string, title string, url string, seq int")
    state = urls.limit(0).withColumn("signal_id", F.lit("x"))
    assert dedupe.append_signals(state, urls).count() == 2
    found = dedupe.named_people(spark.createDataFrame([(["A B"] * 7, 1)], "names array<string>, seq int"), "names")
    assert found.count() == 7


def test_ids_tell_long_names_apart(spark):
    from attesta.functions import ids
    d = spark.createDataFrame([("s", "a" * 24 + "b"), ("s", "a" * 24 + "c")], "site string, name string")
    assert d.select(ids.role_head_id("site", "name").alias("i")).distinct().count() == d.select(ids.target_id("site", "name").alias("i")).distinct().count() == 2


def test_a_late_capture_and_a_false_tail(spark):
    v = spark.createDataFrame([("p", "archive", i, 9000 - i, "This job is no longer available " + "x" * 2000) for i in range(4)] + [("p", "archive", 9, 10, "good " * 600)],
                              "posting_id string, source string, captured_at int, length int, text string")
    assert rows(parse.best_body(v), "tier") == [("tier2_archive_body",)] and rows(parse.best_body(v, captures=4), "tier") == [("tier1_shell",)]
    pages = spark.createDataFrame([("u", "word " * 200)], "url string, page_text string")
    said = spark.createDataFrame([("u", "word " * 100 + "invented"), ("u", "word " * 100)], "url string, excerpt string")
    assert rows(claims.verify_excerpts(said, pages), "excerpt_ok") == [(False,), (True,)]


def test_one_huge_text_leaves_in_blocks():
    sizes = [len(d) for d in parse.in_blocks(((i,) for i in range(50_001)), ["a"])]
    assert sizes == [20_000, 20_000, 10_001]
    assert len(parse.phrases("Aa" + "b" * 60)) == 1


def test_candidates_stay_out_of_the_rows(spark):
    sites = spark.createDataFrame([(f"s{i}", "a", "Town, ST", None) for i in range(500)], "site_id string, account_id string, city string, metro string")
    index = resolve.build_site_index(sites)
    d = spark.createDataFrame([("1", "a", "town")], "posting_id string, account_id string, city_key string")
    out = resolve.resolve(d, index)
    assert rows(out, "site_resolution", "n_site_candidates") == [("ambiguous", 500)] and not [f for f in out.schema if f.dataType.typeName() == "array"]
    assert resolve.site_candidates(index).filter("key = 'town'").count() == 500
    dim = spark.createDataFrame([("town", 1), ("town", 2)], "city_key string, v int")
    assert rows(resolve.enrich(d, dim, "city_key", [F.col("v").desc()]), "posting_id", "v") == [("1", 2)]


def test_a_name_with_the_quoting_mark(spark):
    d = spark.createDataFrame([(1, r"by A\Eb Cde here")], "doc_id int, text string")
    out = scrub.scrub(d, "doc_id", "text", spark.createDataFrame([(r"A\Eb Cde",)], "name string"), whole_word=False)
    assert rows(out, "text_scrubbed") == [("by [person] here",)]


# ---------------------------------------------------------------- forests
def test_cycles_break_at_the_weakest_link(spark):
    edges = [("a", "b", 3), ("b", "a", 1), ("c", "a", 9), ("d", "e", 2), ("e", "f", 2), ("f", "d", 2), ("x", "y", 1), ("g", "f", 1)]
    p = spark.createDataFrame([(u, v, n, "low") for u, v, n in edges], "unit_id string, parent_id string, n_postings int, parent_conf string")
    assert rows(graph.cycle_nodes(p), "unit_id") == [("a",), ("b",), ("d",), ("e",), ("f",)]
    kept, victims = graph.break_cycles(p)
    assert rows(victims, "unit_id") == [("b",), ("d",)]
    assert graph.cycle_nodes(kept).count() == 0
    units = spark.createDataFrame([(u,) for u in "abcdefgxyz"], "unit_id string")
    assert rows(graph.depths(units, kept), "unit_id", "root_id", "depth") == [
        ("a", "b", 1), ("b", "b", 0), ("c", "b", 2), ("d", "d", 0), ("e", "d", 2), ("f", "d", 1), ("g", "d", 2), ("x", "y", 1), ("y", "y", 0), ("z", "z", 0)]
    seed = spark.createDataFrame([("s", "c"), ("s", "e")], "site_id string, unit_id string")
    assert rows(graph.ancestors(seed, kept), "unit_id") == [("a",), ("b",), ("c",), ("d",), ("e",), ("f",)]


@pytest.mark.parametrize("long", [3, 40])
def test_ancestors_of_short_and_long_chains(spark, monkeypatch, long):
    """All ancestors, near and far; what groups reached is written for chains longer than the nearest ones only."""
    up = {i: i - 1 for i in range(1, long)} | {100 + i: i % long for i in range(20)}
    parents = spark.createDataFrame([(str(k), str(v)) for k, v in up.items()], "unit_id string, parent_id string")
    seed = [("x", long - 1), ("x", 103), ("x", 103), ("y", 100), ("z", 999)]
    want = set()
    for site, unit in seed:
        while unit is not None:
            want.add((site, str(unit)))
            unit = up.get(unit)
    landed = []
    monkeypatch.setattr(graph, "land", lambda d, land=graph.land: landed.append(d.columns) or land(d))
    got = graph.ancestors(spark.createDataFrame([(s, str(u)) for s, u in seed], "site_id string, unit_id string"), parents)
    assert rows(got, "site_id", "unit_id") == sorted(want)
    assert any("site_id" in c for c in landed) == (long > graph.NEAREST)


def test_places(spark):
    u = spark.createDataFrame([("a", "observed"), ("b", "named_not_mapped"), ("c", "observed"), ("d", "named_not_mapped")], "unit_id string, unit_kind string")
    p = spark.createDataFrame([("a", "b")], "unit_id string, parent_id string")
    assert rows(graph.roots_orphans(u, p), "unit_id", "place") == [("a", "inner"), ("b", "root"), ("c", "orphan")]


# ---------------------------------------------------------------- text operators
def test_segments_are_exact_slices(spark):
    bodies = ["One ends. Two e.g. Snow. (Three) done! four", "a" * 5, "", "  ", "Item one; " * 60 + "tail • bullet", "Größe 😀 first. Second 😀 end."]
    d = spark.createDataFrame(list(enumerate(bodies)), "id int, text string")
    got = parse.segment(d, "id", "text").collect()
    assert all(bodies[r["id"]][r["start"]:r["end"]] == r["text"] for r in got)
    assert [r["text"] for r in got if r["id"] == 0] == ["One ends.", "Two e.g. Snow.", "(Three) done! four"]
    assert not [r for r in got if r["id"] in (2, 3)] and len([r for r in got if r["id"] == 4]) > 50
    assert [r["text"] for r in got if r["id"] == 5] == ["Größe 😀 first.", "Second 😀 end."]


def test_phrases_and_hits(spark):
    assert parse.phrases("We use C/C++ and the SQL Server, with R") == ["C/C++", "C", "C++", "SQL", "SQL Server", "Server", "R"]
    d = spark.createDataFrame([(1, "No MSAT work here. MSAT team"), (2, None)], "id int, f string")
    hits = parse.kw_hits(d, "id", ["f"], [("msat", r"\bMSAT\b")])
    assert rows(hits, "pos", "negated") == [(3, True), (19, False)]


def test_url_shapes(spark):
    urls = ["https://c.x/job/gaithersburg/director-it/7684/91401", "https://c.x/job/gaithersburg/director-it/7684/6/12/2024", "https://t.wd1.j/en-US/S/job/Cambridge-MA/Data-Engineer_R-12345",
            "https://j.x/job/12345/senior-scientist", "https://j.x/jobs/senior-scientist-12345", "https://j.x/job/senior-scientist", "https://j.x/search/job/senior-scientist", "https://j.x/job/senior-scientist?x=1"]
    d = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    got = {r["i"]: (r["url_form"], r["city_slug"], r["role_slug"], r["req_id"]) for r in parse.parse_url_shapes(d).collect()}
    assert got == {0: ("phenom", "gaithersburg", "director-it", "91401"), 1: ("phenom_datepath", "gaithersburg", "director-it", ""), 2: ("workday", "cambridge", "data-engineer", "R-12345"),
                   3: ("id_first", "", "senior-scientist", "12345"), 4: ("slug_tail_id", "", "senior-scientist", "12345"), 5: ("slug_only", "", "senior-scientist", "")}


def test_names_in(spark):
    d = spark.createDataFrame([("s", "Senior leads: Maria de la Cruz - VP Drug Substance; Ann Lee (Head of MSAT); Global Quality, Director")], "site_id string, t string")
    assert rows(parse.names_in(d, "t"), "name", "title_hint") == [("Ann Lee", "Head of MSAT"), ("Maria de la Cruz", "VP Drug Substance")]


def test_scrub_longest_first_and_whole_words(spark):
    d = spark.createDataFrame([(1, "Raman Monitoring by Raman M and Ann Lee Smith."), (2, "KEEP Ann Leeds site"), (3, "nothing")], "id int, t string")
    names = spark.createDataFrame([("Raman M",), ("Ann Lee",), ("Ann Lee Smith",)], "name string")
    got = {r["id"]: (r["t_scrubbed"], r["changed"]) for r in scrub.scrub(d, "id", "t", names).collect()}
    assert got == {1: ("Raman Monitoring by [person] and [person].", True), 2: ("KEEP Ann Leeds site", False), 3: ("nothing", False)}
    loose = {r["id"]: r["t_scrubbed"] for r in scrub.scrub_site(d, "id", "t", names).collect()}
    assert loose[2] == "[person]ds site" and loose[1].startswith("[person]onitoring")


# ---------------------------------------------------------------- rollups and samples
def test_shares_sum_to_one_and_notes_follow_flags(spark):
    d = spark.createDataFrame([(f"a{i % 3}", f"2024Q{1 + i % 4}", ["x", "y", None][i % 3 if i % 7 else 0]) for i in range(400)], "a string, p string, f string")
    r = mix.share_of_mix(d, "a", "p", "f")
    for x in r.groupBy("account_id", "period").agg(F.sum("share").alias("s")).collect():
        assert x["s"] == pytest.approx(1.0)
    assert quality.unflagged_notes(r).count() == 0


def test_quota_sample_is_round_robin_and_stable(spark):
    d = spark.range(300).select(F.col("id").cast("string").alias("site_id"), F.when(F.col("id") < 200, "agree").otherwise("review").alias("b"), (F.col("id") % 5).alias("s"))
    a = sampling.quota_sample(d, "b", ["s"], {"agree": 10, "review": 5})
    assert a.groupBy("b", "s").count().agg(F.max("count"), F.min("count")).first()[:] == (2, 1)
    assert rows(a, "site_id") == rows(sampling.quota_sample(d.repartition(5), "b", ["s"], {"agree": 10, "review": 5}), "site_id")


def test_signal_mart_folds_below_bar(spark):
    s = spark.createDataFrame([(str(i), "a", "publication" if i < 4 else "capex", f"t{i}", i) for i in range(20)], "signal_id string, account_id string, signal_type string, title string, seq int")
    ranks = spark.createDataFrame([("0", False, 2), ("2", True, 1)], "signal_id string, keep boolean, rank_in_account int")
    got = [(r["signal_id"], r["below_bar"]) for r in marts.signal_mart(s, ranks).orderBy("kind_order", "position").collect()]
    assert got[:4] == [("2", False), ("1", False), ("3", False), ("0", True)] and len(got) == 4 + 16
    assert marts.signal_mart(s, ranks, per_kind=12).count() == 4 + 12


def test_unit_gap_flags_for_ghosts(spark):
    assert tallies.BUCKETS[-2:] == ["excluded", "not_labeled"]
