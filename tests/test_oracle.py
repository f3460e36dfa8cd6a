"""Registered queries against their SQL. A quick list by default; ATTESTA_ALL=1 runs every query."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = os.environ.get("ATTESTA_SF_DIR", "/root/testdata/sf0.01")
QUICK = """share_of_mix power_concentration first_match_rules resolve_sites mirror canonical_names spine_dedupe ordinal_ids read_spine url_dedupe accrete_sightings
accrete_incremental fold_duplicates append_quotes url_parse best_host text_keys html_text json_ld parse_feed regex_fields best_body corpus_quotes claim_backing gate_verdict site_fit
site_profile final_verdict source_claims news_rollup scoring_cache rank_publications agreement stratified_sample location_concentration site_targets email_status forest_cycles
forest_depths accrete_stream once_per_run verify_stream""".split()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ATTESTA_ALL") else QUICK)
def test_query_equals_sql(spark, con, name):
    problem = compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    assert problem is None, problem


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_segment_invariant_over_documents(spark):
    from attesta.operators.parse import segment
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    segs = segment(docs, "doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = segs.collect()
    assert all(texts[r["doc_id"]][r["start"]:r["end"]] == r["text"] for r in rows)
    kept = {}
    for r in rows:
        kept[r["doc_id"]] = kept.get(r["doc_id"], "") + r["text"]
    squeeze = lambda s: "".join(s.split())
    assert all(squeeze(kept.get(k, "")) == squeeze(v) for k, v in texts.items())
