"""Containment by shared runs of characters."""

from __future__ import annotations

import random

from attesta.operators import grams, parse, quality


def texts(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(rng.choice(("hot", "hot", "hot", "cold", None)), "".join(rng.choice(["a", "b", " ", "é", "😀", "ab", "lims", "sap"]) for _ in range(rng.randint(0, 6))).strip()) for _ in range(n)]


def test_containments_equal_brute_force(spark):
    rows = texts(1, 250) + [("cold", None)]
    found = grams.containments(spark.createDataFrame(rows, "g string, t string"), ["g"], "t")
    own = {r for r in rows if r[0] is not None and r[1]}
    want = sorted((g, a, b) for g, a in own for h, b in own if g == h and a != b and a in b)
    assert sorted(tuple(r) for r in found.collect()) == want


def test_pairs_follow_shared_runs(spark):
    """A large group of unlike terms compares few of them."""
    rows = [("hot", f"term{i:05d}x{i * 7919 % 100000:05d}") for i in range(3000)] + [("hot", "term00042x"), ("hot", "rm0")]
    found = grams.containments(spark.createDataFrame(rows, "g string, t string"), ["g"], "t")
    assert sorted(r["_outer"] for r in found.filter("_inner = 'term00042x'").collect()) == [rows[42][1]]
    assert found.filter("_inner = 'rm0'").count() == 3001
    anchors = found.groupBy("_inner").count().filter("count > 1").count()
    assert anchors == 1


def test_nested_phrases_keep_the_most_probable(spark):
    rng = random.Random(3)
    rows = [(s, t, rng.choice((0.1, 0.5, 0.9, None))) for s, t in texts(2, 300)]
    rows += [("hot", "Ab", 0.5), ("hot", "ab", 0.9)]
    got = parse.suppress_nested(spark.createDataFrame(rows, "seg string, phrase string, p double"), "seg")
    low = [(s, t, " ".join(t.split()).lower(), p) for s, t, p in rows]

    def beaten(s, n, p):
        return s is not None and p is not None and any(s == s2 and n != n2 and n and n2 and q is not None and (n in n2 or n2 in n) and (q > p or q == p and len(n2) > len(n)) for s2, _, n2, q in low)
    want = sorted(((s, t, p) for s, t, n, p in low if not beaten(s, n, p)), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_recall_by_containment(spark):
    gold, pred = texts(5, 120), texts(6, 60)
    found = quality.recall_containment(spark.createDataFrame(gold, "g string, t string"), spark.createDataFrame(pred, "g string, t string"), "g", "t")
    clean = lambda rows: {(g, t.strip().lower()) for g, t in rows if t.strip()}
    want = sorted(((g, t, any(g is not None and g == h and (t in u or u in t) for h, u in clean(pred))) for g, t in clean(gold)), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_small_groups_are_compared_without_runs(spark, monkeypatch):
    """Small and large groups give the same pairs, and groups of a few texts make no runs."""
    rows = texts(3, 400) + [(f"g{i}", t) for i in range(20) for t in ("ring", "hot ring", "hot", "ring")]
    df = spark.createDataFrame(rows, "g string, t string")
    own = {r for r in rows if r[0] is not None and r[1]}
    want = sorted((g, a, b) for g, a in own for h, b in own if g == h and a != b and a in b)
    for few in (1, 4, 1000):
        assert sorted(tuple(r) for r in grams.containments(df, ["g"], "t", few=few).collect()) == want
    monkeypatch.setattr(grams, "runs", None)
    assert grams.containments(df.filter("g like 'g%'"), ["g"], "t").count() == 40
