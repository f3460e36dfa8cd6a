"""Incremental state: bucketed tables, batch logs, streams that read only what is new."""

from __future__ import annotations

import collections
import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import claims, mix, org, parse, quality, scrub, stories, upsert
from attesta.plans import QUERIES, q_marts
from attesta.session import land, land_by
from attesta.sources import buckets, folders, tables
from attesta.streaming import mixes, streams
from attesta.streaming.log import BatchLog


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str) if len(cols) > 1 else sorted(r[0] for r in df.select(*cols).collect())


def files(path) -> set[str]:
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


# ---------------------------------------------------------------- buckets
def test_an_update_leaves_the_files_of_other_buckets(spark, tmp_path):
    path, key = str(tmp_path / "t"), "posting_id"
    base = spark.createDataFrame([(f"p{i}", f"url{i}") for i in range(500)], "posting_id string, url string")
    tables.save_changes(base, path, "postings", key)
    first = files(path)
    delta = spark.createDataFrame([("p7", "new7"), ("p8", "new8"), ("p9999", "added")], "posting_id string, url string")
    touched = tables.save_changes(delta, path, "postings", key)
    assert 1 <= len(touched) <= 3 and first < files(path)  # nothing was changed or moved
    written = {f for f in files(path) - first}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in written} == touched
    want = {f"p{i}": f"url{i}" for i in range(500)} | {"p7": "new7", "p8": "new8", "p9999": "added"}
    assert dict(rows(tables.load_parts(spark, path, "postings"), "posting_id", "url")) == want
    assert buckets.versions(spark, path)[next(iter(touched))] == 1 and buckets.vacuum(spark, path) == 0
    for k in range(3):  # versions of which every bucket was written again go
        tables.save_changes(delta.withColumn("url", F.lit(f"u{k}")), path, "postings", key)
    assert buckets.vacuum(spark, path) == 3
    assert dict(rows(tables.load_parts(spark, path, "postings"), "posting_id", "url")) == want | {"p7": "u2", "p8": "u2", "p9999": "u2"}
    tables.save_changes(delta.limit(0), path, "postings", key)
    assert tables.load_parts(spark, path, "postings").count() == 501


def test_an_unfinished_update_is_not_seen_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_changes(spark.createDataFrame([("a", "1"), ("b", "1")], "posting_id string, url string"), path, "postings", "posting_id")
    tables.save_changes(spark.createDataFrame([("a", "2")], "posting_id string, url string"), path, "postings", "posting_id")
    folders.remove(spark, f"{path}/v=1/_SUCCESS")
    assert dict(rows(tables.load_parts(spark, path, "postings"), "posting_id", "url")) == {"a": "1", "b": "1"}
    tables.save_changes(spark.createDataFrame([("a", "3")], "posting_id string, url string"), path, "postings", "posting_id")
    assert dict(rows(tables.load_parts(spark, path, "postings"), "posting_id", "url")) == {"a": "3", "b": "1"}


def test_an_accreting_table_does_not_shrink_by_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_changes(spark.createDataFrame([(f"p{i}", "u") for i in range(50)], "posting_id string, url string"), path, "postings", "posting_id")
    with pytest.raises(claims.GateFailed):
        tables.save_changes(spark.createDataFrame([("p1", "u")], "posting_id string, url string"), path, "postings", "posting_id", merge=lambda old, d: old.limit(0))
    assert tables.load_parts(spark, path, "postings").count() == 50


def test_stored_tiers_and_patches_equal_the_whole_table_forms(spark, tmp_path):
    rng = random.Random(4)
    schema = spark.createDataFrame([], "k long, extraction_tier string, run_seq long, v string").schema
    from attesta import config as cfg
    part = lambda lo, hi, run: spark.createDataFrame([(rng.randrange(lo, hi), rng.choice(cfg.TIERS), run * 1000 + j, f"v{run}-{j}") for j in range(60)], schema)
    runs = [part(0, 40, 0), part(30, 50, 1), part(0, 5, 2)]
    state, path = runs[0].limit(0), str(tmp_path / "tier")
    for d in runs:
        state = upsert.tier_upsert(state, d, "k")
        buckets.update(d, path, "k", schema, lambda old, new: upsert.tier_upsert(old, new, "k"), buckets=8)
    assert rows(buckets.read(spark, path, schema), *schema.names) == rows(state, *schema.names)
    edits = spark.createDataFrame([(3, "patched"), (777, "unknown")], "k long, v string").withColumn("extraction_tier", F.lit(None).cast("string")).withColumn("run_seq", F.lit(None).cast("long")).select(*schema.names)
    buckets.update(edits, path, "k", schema, lambda old, new: upsert.patch(old, new, "k"), buckets=8)
    assert rows(buckets.read(spark, path, schema), *schema.names) == rows(upsert.patch(state, edits, "k"), *schema.names)


# ---------------------------------------------------------------- logs
def test_a_log_compacts_to_few_folders_with_equal_rows(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, run string").schema
    log = BatchLog(spark, str(tmp_path / "log"), schema, "run")
    want = collections.Counter()
    for n in range(11):
        d = [(n * 10 + j, f"r{n % 3}") for j in range(4)]
        log.write(spark.createDataFrame(d, schema), n)
        want.update(d)
        log.compact(fan=3)
        assert collections.Counter(tuple(r) for r in log.all().collect()) == want
    assert log.spans() == [(0, 8), (9, 9), (10, 10)] and log.last() == 10
    assert log.values([(9, 9)]) == {"run=r0"} and log.read(log.spans(), {"run=r1"}).select("run").distinct().collect()[0][0] == "r1"
    # a crash after the merged folder was committed, before its parts were deleted
    log.write(spark.createDataFrame([(1, "r9")], schema), 9)
    log.write(log.read([(9, 9), (10, 10)]), 9, 10)
    log.write(spark.createDataFrame([(2, "r9")], schema), 9)
    assert log.spans() == [(0, 8), (9, 10)]


# ---------------------------------------------------------------- streams
def sightings(spark, folder, batch, data):
    spark.createDataFrame(data, "posting_id string, run_id string, seen_at date").coalesce(1).write.mode("append").parquet(f"{folder}/{batch}")


def stream_of(spark, folder):
    return spark.readStream.schema("posting_id string, run_id string, seen_at date").option("recursiveFileLookup", "true").parquet(folder)


def test_a_second_call_reads_new_batches_and_their_runs_alone(spark, tmp_path, monkeypatch):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    rng, data = random.Random(2), []
    batches = [[(f"p{rng.randrange(30)}", f"r{b}", day(rng.randrange(9) + 10 * b)) for _ in range(60)] for b in range(4)]
    batches[3] = batches[1][:20] + [("p99", "r1", day(0)), ("p3", "r9", day(99))]  # a replay of an old run, with a late row
    read: list[set] = []
    real = BatchLog.read

    def spy(self, spans, only=None):
        spans = list(spans)
        read.append({(s, None if only is None else tuple(sorted(only))) for s in spans})
        return real(self, spans, only)
    monkeypatch.setattr(BatchLog, "read", spy)
    for b, part in enumerate(batches):
        sightings(spark, src, b, part)
        data += part
        read.clear()
        got = streams.accrete_stream(stream_of(spark, src), "posting_id", out, ck, buckets=4)
        want = upsert.accrete(spark.createDataFrame(data, "posting_id string, run_id string, seen_at date"), "posting_id")
        assert rows(got, *sorted(want.columns)) == rows(want, *sorted(want.columns))
        whole = {s for r in read for s, only in r if only is None}
        assert whole == {(b, b)}  # of older batches only the partitions of the same runs were listed
        older = {only for r in read for s, only in r if only is not None}
        assert all(set(only) <= {f"run_id={x[1]}" for x in part} for only in older)
    again = streams.accrete_stream(stream_of(spark, src), "posting_id", out, ck, buckets=4)  # nothing new
    assert rows(again, *sorted(want.columns)) == rows(want, *sorted(want.columns))


def test_once_per_run_over_batches(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    day = datetime.date(2024, 1, 1)
    seen = set()
    for b in range(10):
        part = [(f"p{k % 7}", f"r{b // 4}", day) for k in range(b, b + 9)]
        sightings(spark, src, b, part)
        seen |= {x[:2] for x in part}
        got = streams.once_per_run(stream_of(spark, src), "posting_id", out, ck)
        assert rows(got, "posting_id", "run_id") == sorted(seen)
    assert len(folders.names(spark, out)) < 10


def test_news_dedupe_keeps_a_late_first_copy(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    at = lambda d: datetime.datetime(2020, 1, 1) + datetime.timedelta(days=d)
    schema = "account_id string, item_id string, published timestamp"
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    batches = [[("a", "x", at(1000)), ("a", "x", at(1001)), ("a", "y", at(1005)), (None, "n", at(3))],
               [("a", "late", at(0)), ("a", "x", at(1400)), ("b", "x", at(1000))],  # a first copy far behind; a repeat inside the window; another account
               [("a", "x", at(1000 + 600)), ("a", "late", at(100)), ("a", "y", at(1005)), (None, "n", at(5))]]  # beyond the window it is new
    want = [{("a", "x", 1000), ("a", "y", 1005), (None, "n", 3)}, {("a", "late", 0), ("b", "x", 1000)}, {("a", "x", 1600)}]
    for b, part in enumerate(batches):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{src}/{b}")
        got = streams.dedupe_news_stream(stream(), out, ck, days=548)
        assert {(r["account_id"], r["item_id"], (r["published"] - at(0)).days) for r in got.collect()} == set().union(*want[:b + 1])


# ---------------------------------------------------------------- spans and quotes
def test_span_overlap_equals_brute_force(spark):
    rng, segs, quotes = random.Random(6), [], []
    for t in range(4):
        at = 0
        for k in range(rng.randint(1, 40)):
            end = at + rng.choice((1, 3, 10, 200))
            segs.append((t, k, at, end))
            at = end + rng.choice((0, 1, 5))
        for q in range(30):
            lo = rng.randrange(0, at + 20)
            quotes.append((t, f"q{q}", lo, lo + rng.choice((0, 1, 7, 60, 500))))
    quotes += [(99, "none", 0, 5), (0, "null", None, None)]
    d = parse.span_overlap(spark.createDataFrame(segs, "id int, seg_no int, start int, end int"), spark.createDataFrame(quotes, "id int, quote string, q_start int, q_end int"), "id", "quote", width=16)
    want = []
    for t, q, lo, hi in quotes:
        own = [] if lo is None else [((min(e, hi) - max(s, lo)) / max(1, hi - lo), -k) for i, k, s, e in segs if i == t and s < hi and e > lo]
        share, neg = max(own, default=(0.0, None))
        want.append((t, q, None if neg is None or share < 0 else -neg, round(share, 9)))
    assert sorted(want, key=str) == sorted(((r["id"], r["quote"], r["seg_no"], round(r["share"], 9)) for r in d.collect()), key=str)


def test_a_text_of_a_million_segments(spark):
    """One text is many keys: quotes are compared with the segments near them."""
    segs = spark.range(1_000_000).select(F.lit("t").alias("id"), F.col("id").cast("int").alias("seg_no"), (F.col("id") * 20).cast("int").alias("start"), (F.col("id") * 20 + 18).cast("int").alias("end"), F.lit("a b c").alias("text"))
    quotes = spark.range(20_000).select(F.lit("t").alias("id"), F.col("id").alias("quote"), (F.col("id") * 997 + 3).cast("int").alias("q_start"), (F.col("id") * 997 + 13).cast("int").alias("q_end"))
    r = quality.segment_coverage(segs, quotes, "id", "quote").first()
    inside = sum((n * 997 + 3) % 20 <= 8 for n in range(20_000))
    assert r["n_quotes"] == 20_000 and r["n_inside"] == inside and (r["words_median"], r["words_max"]) == (3.0, 3)


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_quotes_of_every_length_are_found(spark, broadcast_rows):
    rng = random.Random(11)
    alphabet = ["a", "b", " ", "é", "😀", "\n", "word", "the ", ". "]
    bodies = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80)))) for i in range(40)] + [(100, None), (101, "")]
    quotes = []
    for q in range(150):
        _, text = rng.choice(bodies[:40])
        lo = rng.randrange(len(text) + 1)
        quotes.append((q, text[lo:lo + rng.choice((1, 2, 3, 4, 5, 9, 40))] if rng.random() < 0.8 else "".join(rng.choice(alphabet) for _ in range(4))))
    quotes += [(900, ""), (901, None)]
    found = claims.find_quotes(spark.createDataFrame(quotes, "q int, text string"), spark.createDataFrame(bodies, "b int, text string"), "q", "b", broadcast_rows=broadcast_rows, salt_rows=3)
    want = sorted((q, b) for q, t in quotes if t for b, body in bodies if body and t in body)
    assert sorted(tuple(r) for r in found.collect()) == want


def test_no_quote_reaches_the_driver(spark):
    quotes = spark.range(3000).select(F.col("id").alias("q"), F.concat(F.lit("k"), F.col("id")).alias("text"))
    bodies = spark.createDataFrame([(1, "xx k17 k2999yy"), (2, "nothing")], "b int, text string")
    got = claims.find_quotes(quotes, bodies, "q", "b")
    assert rows(got, "q") == sorted(n for n in range(3000) if f"k{n}" in "xx k17 k2999yy")
    assert "mapInPandas" not in got._jdf.queryExecution().toString() and "MapInPandas" not in got._jdf.queryExecution().toString()


# ---------------------------------------------------------------- stories
def test_stories_write_rows_in_proportion_to_words(spark):
    """Postings are at most a slim row for each word; a large group of near copies is worked off a few at a time."""
    rng = random.Random(5)
    common = [f"c{i}" for i in range(30)]
    d = [(i, "b", i, " ".join([*rng.sample(common, 28), f"own{i}", f"own{i + 1}"])) for i in range(300)]
    df = spark.createDataFrame(d, "item_id int, block string, published int, title string")
    bags = df.select("item_id", "published", F.xxhash64("block").alias("_g"), F.transform(F.split("title", " "), lambda w: F.xxhash64(w)).alias("_h")).withColumn("_n", F.size("_h"))
    rows_ = stories.postings(bags, "item_id", "published", 0.5)
    assert rows_.count() <= 300 * 16 and not any("array" in t for _, t in rows_.dtypes)
    rounds: list[int] = []
    kept = stories.suppress_near_dups(df, "block", thr=0.5, rounds=rounds)
    assert rows(kept, "item_id") == [299] and len(rounds) <= 3


def test_sketches_differ_no_more_than_word_sets(spark):
    """A pair that is alike is never told apart, and unlike sets of a usual size are."""
    rng = random.Random(6)
    d = []
    for i in range(60):
        a = rng.sample(range(400), rng.randint(0, 150))
        b = rng.sample(range(400), rng.randint(0, 150)) if i % 2 else a[:len(a) // 2] + [500 + i]
        d.append(([hash((x, "w")) for x in a], [hash((x, "w")) for x in b]))
    df = spark.createDataFrame(d, "a array<long>, b array<long>").withColumn("differ", F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a")))
    far = df.select("a", "b", "differ", stories._sketch("a").alias("sa"), stories._sketch("b").alias("sb")).withColumn("far", stories._far("sa", "sb"))
    got = far.select("differ", "far").collect()
    assert all(r["far"] <= r["differ"] for r in got) and any(r["far"] > 100 for r in got) and any(r["differ"] < 10 for r in got)


# ---------------------------------------------------------------- shares that follow a stream
def test_shares_follow_every_batch(spark, tmp_path):
    rng, data, out = random.Random(9), [], str(tmp_path / "mix")
    for b in range(3):
        part = [(f"a{rng.randrange(5)}", rng.choice(("2024Q1", "2024Q2", None)), rng.choice(("x", "y", None))) for _ in range(60)]
        data += part
        counts = spark.createDataFrame(part, "account_id string, period string, dim_key string").filter("period is not null").fillna("unclassified", ["dim_key"]).groupBy("account_id", "period", "dim_key").agg(F.count("*").alias("n"))
        for _ in range(1 + (b == 1)):  # a batch that is tried again
            mixes.update_mix(counts, out, b, 8)
        got = mixes.mix_shares(spark, out, 8)
        want = mix.share_of_mix(spark.createDataFrame(data, "account_id string, period string, dim_key string"), "account_id", "period", "dim_key", 8)
        shown = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
        assert rows(got.select(want.columns).select(*shown), *want.columns) == rows(want.select(*shown), *want.columns)


def test_a_stream_of_shares(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "acct string, q string, fam string"
    for b in range(2):
        spark.createDataFrame([(f"a{i % 3}", f"q{(i + b) % 2}", f"f{i % 4}") for i in range(40 + b)], schema).coalesce(1).write.mode("append").parquet(f"{src}/{b}")
        mixes.mix_shares_stream(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src), "acct", "q", "fam", out, ck)
        want = mix.share_of_mix(spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(src), "acct", "q", "fam")
        got = mixes.mix_shares(spark, out).select("account_id", "period", "dim_key", "n", "denom", F.round("peer_index", 9))
        assert rows(got, *got.columns) == rows(want.select("account_id", "period", "dim_key", "n", "denom", F.round("peer_index", 9)), *got.columns)


# ---------------------------------------------------------------- shuffles of the org layer
def test_claims_are_shuffled_by_posting_once(spark):
    """Extracts, postings and quotes are dealt by posting; what follows until an edge or the values of a unit shuffles no claim again."""
    extracts = spark.createDataFrame([("p1", "a", "Data Team", "data", "D", "Ops", ["Lab"], "tier3_live_body", "Ulm", None, None, ["w"]), ("p2", "a", "Data Team", "data", None, None, None, "x", None, None, None, None)],
                                     "posting_id string, account_id string, team_name string, team_slug string, team_acronym string, parent_org string, supports_teams array<string>, extraction_tier string, site_stated string, hiring_manager string, tech_stack array<string>, vocabulary array<string>")
    postings = spark.createDataFrame([("p1", "s1"), ("p2", "s1")], "posting_id string, site_id string").withColumns({"job_family": F.lit(None).cast("string"), "seniority_rank": F.lit(2), "posted_date": F.lit(None).cast("date"), "first_seen": F.lit("2026-01-01").cast("date")})
    quotes = spark.createDataFrame([("p1", "team_name", "data", "q1"), ("p1", "team_name", "data", "q2"), ("p1", "parent_org", "ops", "q3"), ("p1", "supports_team", "lab", "q4"), ("p1", "vocabulary", "", "q5"), ("p1", "team_name", "data", "q2")],
                                   "posting_id string, claim_type string, subject_slug string, quote_id string").withColumn("verbatim_verified", F.lit(True))
    edges, units = org.assemble_edges(org.gated_edges(extracts, postings, quotes)), org.assemble_units(extracts, postings, quotes)
    got = {(r["edge_type"], r["dst_unit_id"] or r["dst_site_id"]): (r["n_postings"], r["n_quotes"]) for r in edges.collect()}
    assert got == {("reports_to", "a--ou-ops"): (1, 1), ("supports", "a--ou-lab"): (1, 1), ("located_at", "s1"): (2, 2)}
    assert [(r["n_postings"], r["n_quotes"], r["unit_id"]) for r in units.collect()] == [(2, 2, "a--ou-data")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        exchanges = [d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for d in (org.assemble_edges(org.gated_edges(extracts, postings, quotes)), org.unit_values(extracts, postings, quotes))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert exchanges == [4, 4]


def test_landed_buckets_are_joined_without_a_shuffle(spark):
    df = spark.range(700).select(F.concat(F.lit("p"), (F.col("id") % 600).cast("string")).alias("posting_id"), "id").unionByName(spark.createDataFrame([(None, -1)], "posting_id string, id long"))
    d = land_by(df, "posting_id", 700)
    assert rows(d, "posting_id", "id") == rows(df, "posting_id", "id") and not spark.catalog.listTables()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = d.join(d.groupBy("posting_id").agg(F.count("*").alias("n")), "posting_id")
        plan = both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan
    assert both.count() == 700 and both.filter("n = 2").count() == 200


def test_labels_beyond_ascii_alone_are_folded(spark, monkeypatch):
    """Postings with ASCII labels stay out of Python; the edges of both are the same as when each is folded."""
    data = [("p1", "Opérations", ["Qualité", "Lab"], None), ("p2", "Operations Team", ["Lab", "", None], "Ulm"), ("p3", None, ["Zürich (EU)"], "Köln"), ("p3", "Ops", None, None), ("p4", None, None, None)]
    extracts = spark.createDataFrame([(p, "a", "Data Team", "data", o, s, "x", g) for p, o, s, g in data], "posting_id string, account_id string, team_name string, team_slug string, parent_org string, supports_teams array<string>, extraction_tier string, site_stated string")
    postings = spark.createDataFrame([(f"p{i}", "s1") for i in range(1, 5)], "posting_id string, site_id string").withColumns({"job_family": F.lit(None).cast("string"), "seniority_rank": F.lit(2), "posted_date": F.lit(None).cast("date"), "first_seen": F.lit("2026-01-01").cast("date")})
    quotes = spark.createDataFrame([("p1", "parent_org", "operations"), ("p1", "supports_team", "qualite"), ("p1", "supports_team", "lab"), ("p2", "parent_org", "operations"), ("p2", "site_stated", "ulm"), ("p3", "supports_team", "zurich"), ("p3", "site_stated", "koln"), ("p3", "parent_org", "ops")],
                                   "posting_id string, claim_type string, subject_slug string").withColumns({"verbatim_verified": F.lit(True), "quote_id": F.concat_ws("-", "posting_id", "claim_type", "subject_slug")})
    got = org.gated_edges(extracts, postings, quotes)
    reports, supports, located = (rows(got.filter(F.col("edge_type") == k), "posting_id", "dst_unit_id", "dst_label", "quote_id") for k in ("reports_to", "supports", "located_at"))
    assert reports == [("p1", "a--ou-operations", "Opérations", "p1-parent_org-operations"), ("p2", "a--ou-operations", "Operations Team", "p2-parent_org-operations"), ("p3", "a--ou-ops", "Ops", "p3-parent_org-ops")]
    assert supports == [("p1", "a--ou-lab", "Lab", "p1-supports_team-lab"), ("p1", "a--ou-qualite", "Qualité", "p1-supports_team-qualite"), ("p3", "a--ou-zurich", "Zürich (EU)", "p3-supports_team-zurich")]
    assert sorted((p, q or "") for p, _, _, q in located) == [("p1", ""), ("p2", "p2-site_stated-ulm"), ("p3", ""), ("p3", "p3-site_stated-koln"), ("p4", "")]
    monkeypatch.setattr(org, "afold", lambda c: F.raise_error(F.lit("folded")).cast("string"))
    assert org.gated_edges(extracts.filter("posting_id in ('p2', 'p4')"), postings, quotes).count() == 3


def test_guards_land_no_texts(spark, tmp_path, monkeypatch):
    """The guards read outcomes; the texts of quotes are not stored for them."""
    spark.createDataFrame([(i, f"The quick brown fox number {i} jumps over the lazy dog and runs on for a long while " * 3) for i in range(3)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(200).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 1, "N"), (1, 2, "A")], "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    stored = []
    monkeypatch.setattr(q_marts, "land", lambda d: (stored.append(d.columns), land(d))[1])
    got = {(r["guard"], r["input"]): (r["outcome"], r["n"]) for r in QUERIES["guards"](spark, str(tmp_path)).collect()}
    assert stored == [["kind", "verbatim_verified"]] and got[("pass_rate", "exact quotes")] == ("passed", 3) and got[("pass_rate", "all quotes")][1] == 24
    assert got[("edges", "all")] == ("refused", 2) and got[("edges", "quoted")] == ("passed", 1) and got[("shrink", "one in ten gone")] == ("refused", 200)


# ---------------------------------------------------------------- phrases and names
def test_phrases_look_at_a_token_once(monkeypatch):
    """Slices take what is known of their tokens and gaps; only letters that fold into ASCII ones need a look at whole slices."""
    looked = []

    class Shape:
        def search(self, s):
            looked.append(s)
            return shape.search(s)
    shape = parse._SHAPE
    monkeypatch.setattr(parse, "_SHAPE", Shape())
    assert parse.phrases("mass spectro-metry, Cell omics") == ["mass spectro-metry", "spectro-metry", "Cell", "Cell omics", "omics"]
    assert not any(" " in s.strip(" ,5") for s in looked)
    assert "cell omicſ x" in parse.phrases("cell omicſ x")


def test_a_small_roster_goes_to_the_texts(spark):
    """The pairs of tokens of the texts are not shuffled."""
    df = spark.createDataFrame([(1, "Ann Lee met Jo Ann Lee and Ann Leely"), (2, "none")], "id int, text string")
    names = spark.createDataFrame([("Ann  Lee",), ("Jo Ann Lee",)], "name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scrub.scrub(df, "id", "text", names)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(out, "text_scrubbed", "changed") == [("[person] met [person] and Ann Leely", True), ("none", False)] and "hashpartitioning(_key" not in plan


# ---------------------------------------------------------------- lines dealt once
@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """A few tables in the driver's form: 60 lines of 6 parts and 3 suppliers."""
    folder = str(tmp_path_factory.mktemp("lines"))
    day = datetime.datetime(1998, 3, 1)
    made = {"nation": ([(0, "ACME", 0), (1, "BETA", 0)], "n_nationkey int, n_name string, n_regionkey int"),
            "supplier": ([(i, f"S{i}", i % 2, 10.0 * i) for i in range(3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
            "part": ([(i, f"part {i}", f"Brand#{i % 3 + 1}", f"TYPE{i}", i * 4 % 9, 1.0) for i in range(6)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
            "lineitem": ([(i // 7, i % 6, i % 3, i % 7 + 1, float(i % 50), "NAR"[i % 3], "OF"[i // 2 % 2], day + datetime.timedelta(days=i)) for i in range(60)],
                         "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp")}
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name,n", [("org_overrides", None), ("drop_unsupported", 60)])
def test_lines_are_joined_with_their_parts_once(spark, lines, name, n):
    got = QUERIES[name](spark, lines)
    assert "lineitem.parquet" not in got._jdf.queryExecution().toString()  # what it reads is landed
    assert got.count() == (n or got.select("unit_id").distinct().count()) > 0


def test_claims_that_are_dealt_meet_their_quotes_without_a_shuffle(spark):
    df = spark.createDataFrame([(i, f"p{i}", "tech", f"Tool {i % 9}") for i in range(300)], "k int, posting_id string, claim_type string, subject string")
    claims_ = land_by(df, "posting_id", 300)
    quotes = spark.createDataFrame([(f"p{i}", "tech" if i % 3 else "team_name", f"tool {i % 9}", "", i % 2 == 0) for i in range(0, 300)], "posting_id string, claim_type string, subject string, quote_text string, verbatim_verified boolean")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = claims.with_backing(claims_, quotes).filter("_kept")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1  # of the quotes
    assert sorted(r["k"] for r in got.collect()) == sorted(r["k"] for r in claims.backed(claims_, quotes).collect()) == [i for i in range(300) if i % 3 and i % 2 == 0]


def test_a_key_that_is_made_behind_the_shuffle_deals_like_itself(spark):
    df = spark.range(500).withColumn("v", F.col("id") * 2)
    made = F.concat(F.lit("p"), F.col("id").cast("string"))
    d = land_by(df, "posting_id", 500, made)
    assert sorted(d.columns) == ["id", "posting_id", "v"] and d.count() == 500
    both = d.groupBy("posting_id").agg(F.count("*").alias("n")).join(d.select("posting_id", "v"), "posting_id")
    assert both.filter("n = 1").count() == 500 and "Exchange hashpartitioning" not in both._jdf.queryExecution().executedPlan().toString()
    assert d.filter("posting_id = 'p77'").select("v").first()[0] == 154
