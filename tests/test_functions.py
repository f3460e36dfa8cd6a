from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions import dates, gates, ids, places, text


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make("v").alias("o")).first()["o"]


@pytest.mark.parametrize("raw, primary, alias", [
    ("Cambridge, MA", {"cambridge"}, set()), ("Mölndal (Gothenburg)", {"molndal"}, {"gothenburg"}),
    ("Liverpool (Speke)", {"liverpool"}, {"speke"}), ("Södertälje", {"sodertalje"}, set()),
    ("Cambridge / Waltham, MA", {"cambridge", "waltham"}, set()), ("USA", set(), set()), (None, set(), set())])
def test_city_keys(spark, raw, primary, alias):
    got = one(spark, raw, places.city_keys)
    assert set(got["primary"]) == primary and set(got["alias"]) == alias


@pytest.mark.parametrize("slug, key", [
    ("mount-vernon", "mountvernon"), ("new-haven", "newhaven"), ("Cambridge-MA", "cambridge"),
    ("Research-Triangle-Park-NC", "researchtrianglepark"), ("US", "us"), ("M%C3%B6lndal", "molndal")])
def test_slug_to_key(spark, slug, key):
    assert one(spark, slug, places.slug_to_key) == key


@pytest.mark.parametrize("raw, city", [
    ("Germany - Bavaria - München", "munich"), ("Remote, USA", "remote"), ("Ireland", None), ("Lisboa, Portugal", "lisbon"),
    ("new-haven", "new haven"), ("", None)])
def test_city_place(spark, raw, city):
    assert one(spark, raw, places.city_place) == city


@pytest.mark.parametrize("raw, city", [("Cambridge / Waltham, MA", "Cambridge"), ("Boston (Allston), MA", "Boston"), ("n/a", None), ("Various", None)])
def test_city_proper(spark, raw, city):
    assert one(spark, raw, places.city_proper) == city


def test_city_of_list_and_count(spark):
    assert one(spark, "Cambridge, MA; Boston", places.city_of) == "Cambridge, MA"
    assert one(spark, "2 Locations", places.city_of) is None


@pytest.mark.parametrize("raw, want", [("20240612", "2024Q2"), ("2024-06-12", "2024Q2"), ("2024", None)])
def test_quarter_of_text(spark, raw, want):
    assert one(spark, raw, dates.quarter_of_text) == want


@pytest.mark.parametrize("said, day, kind", [
    ("Posted Today", dt.date(2026, 1, 10), "workday_posted_today"), ("Posted Yesterday", dt.date(2026, 1, 9), "workday_posted_rel"),
    ("Posted 15 Days Ago", dt.date(2025, 12, 26), "workday_posted_rel"), ("Posted 30+ Days Ago", None, None), (None, None, None)])
def test_rel_date(spark, said, day, kind):
    got = one(spark, said, lambda c: dates.rel_date(c, F.lit("2026-01-10")))
    assert (got["date"], got["kind"]) == (day, kind)


def test_feed_date(spark):
    assert one(spark, "Tue, 07 Oct 2025 07:00:00 GMT", dates.feed_date) == dt.date(2025, 10, 7)
    assert one(spark, "soon", dates.feed_date) is None


@pytest.mark.parametrize("name, slug", [
    ("the Operations IT - Global Biologics team", "operations-it-global-biologics"), ("Quality and Safety Group", "quality-&-safety"),
    ("Data Platform (DP) Team Unit", "data-platform"), ("Ops Department Org", "ops")])
def test_team_slug(spark, name, slug):
    assert one(spark, name, text.team_slug) == slug


def test_folding_and_forms(spark):
    assert one(spark, "Södertälje ﬁne", text.afold) == "Sodertalje fine"
    forms = one(spark, "“It’s  R&amp;D” — naïve…", text.normal_forms)
    assert forms["soft"] == '"It\'s R&D" - naïve...' and forms["hard"] == "it s r d naive"


def test_html_to_text(spark):
    page = "<head><title>x</title></head><nav>menu</nav><p>MS&amp;T <b>lead</b></p><script>if (a<b) {}</script><FOOTER a=1>f</FOOTER>"
    assert one(spark, page, text.html_to_text) == "MS&T lead"


def test_head_cells(spark):
    assert one(spark, "PENDING", text.head_text) is None
    assert one(spark, "Ann Lee – Site Head – EU", text.split_head).asDict() == {"name": "Ann Lee", "title": "Site Head – EU"}
    assert one(spark, "None identified", text.split_head) is None
    assert one(spark, "Unassigned", text.owner_of) is None


def test_titleise_and_words(spark):
    assert one(spark, "msat-lead-us", text.titleise) == "MSAT Lead US"
    assert one(spark, "The new $2bn plant of Acme, the plant", text.word_set) == ["$2bn", "plant", "acme"]


def test_ids(spark):
    row = spark.createDataFrame([("a", "", "town", "lead"), ("a", "R1", "town", "lead")], "a string, r string, c string, l string")
    got = [r[0] for r in row.select(ids.posting_id("a", "r", "c", "l")).collect()]
    assert got[1] == "a--jr-R1" and got[0].startswith("a--jr-h") and len(got[0]) == len("a--jr-h") + 10


@pytest.mark.parametrize("p, want", [(0.8, "yes"), (0.2, "no"), (0.5, "unsure"), (0.79, "unsure"), (0.21, "unsure")])
def test_gate_edges(spark, p, want):
    assert spark.range(1).select(gates.gate(F.lit(p))).first()[0] == want


def test_confidence_levels(spark):
    rows = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (2, 2, 0), (3, 0, 5)], "n int, t int, q int")
    got = [(r[0]["level"], r[0]["basis"]) for r in rows.select(gates.confidence("n", "t", "q")).collect()]
    assert [g[0] for g in got] == ["low", "medium", "high", "high"]
    assert got[0][1] == "1 posting, 1 verified quote" and got[1][1] == "1 posting, 2 verified quotes"


def test_strict_families_drop_analytical_only(spark):
    plain, strict = dict(cfg.FAMILIES), dict(cfg.FAMILIES_STRICT)
    d = spark.createDataFrame([("-analytical-scientist-",), ("-analytics-lead-",)], "s string")
    rows = d.select(F.col("s").rlike(plain["data_digital"]), F.col("s").rlike(strict["data_digital"])).collect()
    assert [tuple(r) for r in rows] == [(True, False), (True, True)]
