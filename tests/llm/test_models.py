"""Whitening, the prefix trie and the hidden Markov model against brute force, on planted and odd rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import markov, prefix_trie, whitening
from attesta.llm import queries as llm
from attesta.llm.session import prepared
from tests.oracle import compare, connect

FOLDER = os.environ.get("ATTESTA_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module", autouse=True)
def _settings(spark):
    prepared(spark)


# --- Spectrum slicing and whitening ---

def spectra() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(3)
    turn = lambda d: np.linalg.qr(rng.standard_normal((d, d)))[0]
    some = rng.standard_normal((40, 24))
    q, r = turn(24), turn(30)
    return {"random": some.T @ some, "identity": np.eye(12) * 3, "pairs": q @ np.diag(np.repeat(np.arange(12.0, 0, -1), 2)) @ q.T, "steep": r @ np.diag(10.0 ** -np.arange(30)) @ r.T,
            "flat": rng.standard_normal((20, 2)) @ rng.standard_normal((2, 20)), "one": np.array([[4.0]]), "zero": np.zeros((6, 6))}


@pytest.mark.parametrize("name", ["random", "identity", "pairs", "steep", "one"])
def test_eigenpairs_match_the_library(name):
    m = spectra()[name]
    values, vectors = whitening.leading_eigenpairs(m, 8)
    want = np.linalg.eigvalsh(m)[::-1][:8]
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(m @ vectors - vectors * values).max() <= 1e-12 * want[0]


@pytest.mark.parametrize("name", list(spectra()))
def test_inertia_counts_match_the_spectrum(name):
    m = spectra()[name]
    m = (m + m.T) / 2
    own = np.linalg.eigvalsh(m)
    for shift in (-1.0, -1e-3, 1e-3, 0.5, 2.9999, 3.0001, 11.5, 100.0):
        assert whitening.eigenvalues_above(m, shift) == int((own > shift).sum())


def whitened_by_hand(vectors: list[list[float]]) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """(x, exact deviations, covariance, its eigenvalues)."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[float(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    covariance = centred.T @ centred / n
    return centred, deviations, covariance, np.linalg.eigvalsh(covariance)[::-1]


def check_whitening(rows, vectors: dict[int, list[float]], components: int = 8) -> None:
    ids = sorted(vectors)
    centred, deviations, covariance, values = whitened_by_hand([vectors[i] for i in ids])
    k, n = min(components, covariance.shape[0]), len(ids)
    found = {(r["vec_id"], r["component"]): r for r in rows}
    assert set(found) == {(i, c) for i in ids for c in range(1, k + 1)} and len(rows) == len(found)
    y = np.array([[found[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    for i, d in zip(ids, deviations, strict=True):
        assert {found[i, c + 1]["deviation"] for c in range(k)} == {d} and found[i, 1]["n"] == n
    for c in range(k):
        assert abs(found[ids[0], c + 1]["explained"] / (values[c] / np.trace(covariance)) - 1) < 1e-9
        # the component behind the column is an eigenvector: the whitened values give it back
        v = centred.T @ y[:, c] / n / np.sqrt(values[c])
        assert abs(np.linalg.norm(v) - 1) < 1e-9 and np.abs(covariance @ v - values[c] * v).max() < 1e-9 * values[0]
        assert np.abs(y[:, c] - centred @ v / np.sqrt(values[c])).max() < 1e-8
    measured = np.abs(y.T @ y / n - np.outer(y.mean(axis=0), y.mean(axis=0)) - np.eye(k)).max()
    assert measured < 1e-9 and len({r["identity_error"] for r in rows}) == 1 and abs(rows[0]["identity_error"] - measured) < 1e-9


def test_whitening_equals_the_formulas(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12)) * 0.2
    vectors = {int(i): [float(np.float32(c)) for c in v] for i, v in enumerate(base)}
    odd = [(1000, None), (1001, []), (1002, [1.0] * 11 + [None]), (1003, [float("nan")] * 12), (1004, [float("inf")] * 12), (1005, [1.0, 2.0])]
    table = spark.createDataFrame([*((i, v, 1, "x") for i, v in vectors.items()), *((i, v, 2, "y") for i, v in odd)], "vec_id long, embedding array<float>, n long, v string").repartition(7)
    check_whitening(whitening.whiten(table, whitening.fit_whitening(table)).collect(), vectors)


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    vectors = {r["vec_id"]: list(r["embedding"]) for r in table.collect()}
    check_whitening(llm.QUERIES["op12_embedding_whitening"](spark, FOLDER).collect(), vectors)


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<double>"

    def run(rows):
        table = spark.createDataFrame(rows, schema)
        return whitening.whiten(table, whitening.fit_whitening(table)).collect()
    assert run([]) == [] and run([(1, None), (2, [])]) == []
    same = run([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])])
    assert len(same) == 6 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["identity_error"] is None for r in same)
    line = run([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])])  # a repeated row counts twice; one direction has no variance
    assert len(line) == 6 and {r["component"]: r["explained"] for r in line}[1] == pytest.approx(1.0)
    assert all((r["whitened"] is None) == (r["component"] == 2) and r["identity_error"] < 1e-12 for r in line)
    huge = run([(1, [1e300, 0.5]), (2, [-1e300, 0.25]), (3, [0.0, 0.125])])
    assert all(r["deviation"] is None for r in huge if r["vec_id"] < 3) and len(huge) == 6


# --- The prefix trie ---

def brute_trie(rows: list[tuple]) -> collections.Counter:
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:]
    nodes = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
    ends = lambda k: ",".join(map(str, sorted(c for c in nodes[k] if len(built[c]) == len(k))))
    return collections.Counter((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends(k).encode()).hexdigest()) for k, m in nodes.items())


def talk(seed: int) -> list[tuple]:
    """Conversations with shared beginnings, a large group of copies, turns that tie, null turns, roles and texts, negative and far ids, missing firsts of groups, one long conversation."""
    rng, rows = random.Random(seed), []
    starts = [[(r, rng.choice(("hé", "a", "b" * 9, ""))) for r in ("user", "assistant", "user", "assistant")] for _ in range(4)]
    for c in [*range(60), *range(-14, 0), *(10**12 + 5 * k + 1 for k in range(12))]:
        turns = rng.choice(starts)[:rng.randint(0, 4)] + [(rng.choice(("user", "assistant")), rng.choice("xyz")) for _ in range(rng.randint(0, 9))]
        rows += [(c, t if rng.random() < 0.9 else rng.choice((None, 3)), r if rng.random() < 0.95 else None, x if rng.random() < 0.95 else None) for t, (r, x) in enumerate(turns)]
    rows += [(c, t, "user", "copy") for c in range(2000, 2150) for t in range(12)]
    rows += [(5000, t, "user", str(t % 7)) for t in range(300)]
    rows += [(None, 0, "user", "nobody"), rows[0], rows[1], (6000, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "shard_turns", "fan"), [(1, 10**6, 64), (2, 300, 64), (3, 40, 3), (4, 15, 2)])
def test_trie_equals_brute_force(spark, seed, shard_turns, fan):
    rows = talk(seed)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth long, path string").repartition(6)
    built = prefix_trie.rebuilt(prefix_trie.sequences(prefix_trie.turn_rows(table)))
    found = prefix_trie.trie(built, shard_turns, fan)
    assert collections.Counter(tuple(r) for r in found.collect()) == brute_trie(rows)


def test_long_lists_of_ends_travel_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 50)
    convs = np.arange(100, 140)
    rows = pa_rows(prefix_trie.shard_nodes(3, convs, np.ones(40, np.int64), np.full(40, 7), np.full(40, 2)))
    pieces = sorted((r["piece"], r["ends"]) for r in rows if r["kind"] == prefix_trie.ENDS)
    assert len(pieces) > 3 and b"".join(p for _, p in pieces) == ",".join(map(str, convs)).encode()


def pa_rows(batches) -> list[dict]:
    return [row for batch in batches for row in batch.to_pylist()]


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(none).collect() == []
    alone = prefix_trie.prefix_trie(spark.createDataFrame([(4, 0, None, None)], none.schema)).collect()  # h = crc32("4") % 9 > 0 and no conversation 0: it loses its turn
    assert [tuple(r)[:7] for r in alone] == [(4, 0, None, 1, 0, 1, 0)]


def test_trie_equals_sql(spark):
    assert compare(llm.QUERIES["op13_conversation_trie"](spark, FOLDER), connect(FOLDER), llm.ORACLE["op13_conversation_trie"]) is None


# --- The hidden Markov model ---

def small_model(k: int = 4, s: int = 30) -> markov.Model:
    rng = np.random.default_rng(0)
    return markov.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(s), k))


def all_paths(model: markov.Model, text: np.ndarray) -> float:
    """The chance of a text as a sum over all paths of states."""
    k = len(model.start)
    total = 0.0
    for path in itertools.product(range(k), repeat=len(text)):
        p = model.start[path[0]] * model.emit[path[0], text[0]]
        for t in range(1, len(text)):
            p *= model.move[path[t - 1], path[t]] * model.emit[path[t], text[t]]
        total += p
    return math.log(total)


def plain_counts(model: markov.Model, text: np.ndarray) -> tuple[float, np.ndarray]:
    """(log likelihood, Baum-Welch counts) of one short text, without scales."""
    n, k = len(text), len(model.start)
    a, b = np.zeros((n, k)), np.ones((n, k))
    a[0] = model.start * model.emit[:, text[0]]
    for i in range(1, n):
        a[i] = (a[i - 1] @ model.move) * model.emit[:, text[i]]
    for i in range(n - 2, -1, -1):
        b[i] = model.move @ (model.emit[:, text[i + 1]] * b[i + 1])
    z = a[-1].sum()
    emitted, moves = np.zeros(model.emit.shape), np.zeros((k, k))
    for i in range(n):
        emitted[:, text[i]] += a[i] * b[i] / z
    for i in range(n - 1):
        moves += np.outer(a[i], model.emit[:, text[i + 1]] * b[i + 1]) * model.move / z
    return math.log(z), np.hstack([emitted, moves, (a[0] * b[0] / z)[:, None]])


@pytest.mark.parametrize("longest", [1000, 16, 3, 1])
def test_forward_and_counts_equal_the_plain_recursions(longest):
    model, rng = small_model(), np.random.default_rng(5)
    texts = [rng.integers(0, 30, n).astype(np.uint16) for n in (1, 2, 5, 60, 33, 7, 1, 48)]
    want = [plain_counts(model, t) for t in texts]
    assert np.abs(markov.log_likelihoods(model, texts, longest) - [x for x, _ in want]).max() < 1e-10
    assert np.abs(markov.expected_counts(model, texts, longest) - sum(c for _, c in want)).max() < 1e-10
    assert abs(markov.log_likelihoods(model, texts[2:3], longest)[0] - all_paths(model, texts[2])) < 1e-10


def test_long_texts_do_not_underflow():
    model = small_model()
    text = np.random.default_rng(2).integers(0, 30, 30_000).astype(np.uint16)
    logs = [markov.log_likelihoods(model, [text], n)[0] for n in (40_000, 4096, 100)]
    assert np.ptp(logs) < 1e-6 and -5 < logs[0] / len(text) < -2


WORDS = re.compile("[^\\x20\\x09-\\x0D]+")
TEXTS = "doc_id long, text string, row long, z string, train string"


def prose(rng: random.Random, n: int) -> str:
    """Two kinds of text, each with its own words, one word after the other by habit."""
    kind = rng.choice(("ab", "xyz"))
    return " ".join("".join(rng.choice(kind) for _ in range(rng.randint(1, 5))) for _ in range(n))


def corpus_rows() -> list[tuple]:
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(0, 80))) for i in range(200)]
    rows += [(300 + i, "THE Copy of the copy É\tthe") for i in range(100)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, prose(rng, 6000)), (504, "unheard"), (505, "w" * 70_000), (None, "never learned from the"), (None, None), rows[3], rows[3], (600, "the " * 3000)]
    return rows


def test_scores_equal_the_formula_and_the_model(spark, monkeypatch):
    monkeypatch.setattr(markov, "OWN", 40)  # some words are symbols of their own, most are not
    rows = corpus_rows()
    table = spark.createDataFrame([(i, t, 1, "z", "y") for i, t in rows], TEXTS).repartition(5)
    found = [r.asDict() for r in markov.score_texts(table, states=3, rounds=3).collect()]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    learns = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 != 0
    tokens = lambda t: [*WORDS.findall((t or "").translate(lower)), None]
    counts = collections.Counter(w for i, t in rows if learns(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t in rows:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))
        want[i, not learns(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 6)] += 1
    assert collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_the_chances_of_all_short_texts_sum_to_one(spark, monkeypatch):
    """All texts of up to six known words: what is missing is left for longer ones and unheard words."""
    monkeypatch.setattr(markov, "OWN", 8)
    table = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a", "b a", "a", "", "b c", "c c a b", "a b", "b", "c a", "a a"] * 3)], "doc_id long, text string")
    heard = ["a", "b", "c"]
    every = [" ".join(p) for n in range(7) for p in itertools.product(heard, repeat=n)]
    probe = spark.createDataFrame([(None, t) for t in every], "doc_id long, text string")
    mass = collections.Counter()
    for r in markov.score_texts(table.unionByName(probe), states=2, rounds=2).filter("doc_id is null").collect():
        mass[r["n_tokens"]] += 10 ** r["score"]
    total = sum(mass.values())
    assert 0.85 < total <= 1.0 + 1e-9 and mass[1] > 0.02


def test_training_raises_the_likelihood_and_beats_the_base(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    logs = []
    for rounds in (0, 1, 2, 5):
        rows = markov.score_texts(docs, rounds=rounds).agg(F.sum(F.when(~F.col("held_out"), F.col("score"))).alias("train"), F.sum(F.when(F.col("held_out"), F.col("score"))).alias("held"),
                                                           F.sum(F.when(F.col("held_out"), F.col("base_score"))).alias("base")).first()
        logs.append(rows["train"])
    assert logs == sorted(logs) and rows["held"] > rows["base"]


def test_scores_of_little(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert markov.score_texts(none).collect() == []
    only = markov.score_texts(spark.createDataFrame([(None, "a b")], none.schema)).first()  # nothing to learn from
    assert only["held_out"] and only["n_tokens"] == 3 and only["n_known"] == 0 and only["train_tokens"] == 0 and only["base_score"] == pytest.approx(0.0) and math.isfinite(only["score"])


def test_scores_of_the_table_have_every_row(spark):
    found = llm.QUERIES["op11_hmm_scores"](spark, FOLDER)
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
