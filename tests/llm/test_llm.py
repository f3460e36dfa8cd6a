"""Brute-force versions, planted cases and odd rows for the training-data operators."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attesta.llm import arrays, components, decontaminate, exchange, language, licenses, minhash, mixing, neighbours, secrets, substrings, suffixes, tokens
from attesta.llm import queries as llm
from attesta.llm.session import prepared
from tests.oracle import compare, connect

FOLDER = os.environ.get("ATTESTA_SF_DIR", "/root/testdata/sf0.01")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\\x20\\x09-\\x0D]+")
ALNUM = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module", autouse=True)
def _settings(spark):
    prepared(spark)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(("an", "the", "ré", "ou", "st", "ön", "in", "ga")) for _ in range(rng.randint(1, 4))) + rng.choice(("", "", "", ",", ".")) for _ in range(n))


def corpus(seed: int = 5) -> list[tuple]:
    """Texts with copies, edited copies, shared passages, repeats inside, and odd rows: null, empty, blank, a null id, a repeated row, a long text, a long word."""
    rng = random.Random(seed)
    passage, texts = prose(rng, 60), []
    for k in range(60):
        text = prose(rng, rng.randint(1, 120))
        if k % 7 == 1:
            text = rng.choice(texts)
        if k % 7 == 3 and len(WORD.findall(text)) > 30:
            words = text.split(" ")
            words[rng.randrange(len(words))] = "edited"
            texts.append(" ".join(words))
        if k % 9 == 2:
            text += "\n" + passage
        if k % 11 == 4:
            text = (prose(rng, 25) + "\n") * 4
        texts.append(text)
    texts += [None, "", " \t\n", "one", prose(rng, 4000), "x" * 5000, "ab" * 400, "中文字" * 70, texts[3], "x" * 5000]
    rows = [(i, t, None if i % 13 == 0 else "en", None if i % 5 == 0 else f"s{i % 4}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return [*rows, rows[2], rows[4], (None, texts[1], None, None, 1), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The corpus over several partitions, with columns named like the operators' own."""
    extra = [(*r, "x", 1, b"z", 7) for r in rows]
    return spark.createDataFrame(extra, DOCS + ", label string, rank int, z binary, `_copy` long").repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def sorted_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- 1: secrets ---

def brute_base_spans(text: str) -> list[tuple[int, int, int]]:
    """The base patterns by hand: characters, no regular expressions but the keyword's."""
    out, i = [], 0
    key = re.compile(r"(password|passwd|secret|token|api_?key)", re.I | re.A)
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    while m := key.search(text, i):
        i = m.start() + 1
        for quote_a, quote_b in itertools.product((1, 0), (1, 0)):
            j = m.end()
            if quote_a and text[j:j + 1] in ("'", '"') and text[j:j + 1]:
                j += 1
            elif quote_a:
                continue
            while text[j:j + 1] == " ":
                j += 1
            if text[j:j + 1] not in (":", "="):
                continue
            j += 1
            while text[j:j + 1] == " ":
                j += 1
            if quote_b and text[j:j + 1] in ("'", '"') and text[j:j + 1]:
                j += 1
            elif quote_b:
                continue
            e = j
            while text[e:e + 1] in value and text[e:e + 1]:
                e += 1
            if e > j:
                if e - j >= 6:
                    out.append((m.start(), e, 0))
                i = e
                break
    for kind, alphabet, head, least in ((1, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "AKIA", 20), (2, "0123456789abcdef", "", 24)):
        i = 0
        while i < len(text):
            if text.startswith(head, i) and text[i] in alphabet:
                e = i
                while e < len(text) and text[e] in alphabet:
                    e += 1
                if e > i + len(head):
                    if e - i >= least:
                        out.append((i, e, kind))
                    i = e
                    continue
            i += 1
    return sorted(out)


SECRET_TEXTS = ["password=hunter", 'the PassWord" : "abc123def"', "token = token: abcdefgh", "api_key='AKIA" + "A1" * 10 + "'", "apikey: ab", "x" * 30 + "deadbeef" * 4, "AKIA" * 6, "AKIAB AKIA" + "Z" * 16,
                "ſecret=abcdefgh toKen=abcdefgh", "secret:=abcdefgh", "é password = b7db7aa4a5fcc78305 é", "passphrase: Zx9!kQ2#vB7p", "pwd=changeme", "authorization: bearer 8f3kd92jf8s7dh3k", "token is x7Gh29Lm4Qp", "",
                "password = " + "a" * 20000, 'passwd"= "' + "0a1b2c" * 3000]


def test_base_spans_equal_brute_force():
    rng = random.Random(1)
    parts = ["password", "Token", "api_key", "secret", "=", ":", " ", '"', "'", "abc123", "AKIA", "AKIA" + "Q" * 16, "deadbeef" * 3, "é", "\n", "x", "0", "F"]
    texts = SECRET_TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    for text in texts:
        assert [(s, e, k) for s, e, k, _ in secrets.find_spans(text) if k < 3] == brute_base_spans(text), text


def brute_cost(value: str, ranks: secrets.Ranks) -> float:
    """The same segment costs over all segments and all ways to join them."""
    char, steps, n = secrets._per_char(value), secrets._steps(), len(value)
    low, plain = value.lower(), value.lower().translate(secrets.SWAPS)

    def segments(i: int, j: int):
        part = value[i:j]
        yield (j - i) * char, "brute"
        if j - i >= 3 and low[i:j] in ranks.of:
            yield ranks.of[low[i:j]] + (secrets.CASED if low[i:j] != part else 0), "word"
        elif j - i >= 3 and plain[i:j] in ranks.of:
            yield ranks.of[plain[i:j]] + secrets.SWAPPED, "word"
        for k, pattern in enumerate(secrets.DATES):
            if (m := pattern.match(value, i)) and m.end() == j:
                yield 2.1 if k == 2 else 4.6, "date"
        if j - i >= 3 and len(set(part)) == 1:
            yield char + math.log10(j - i), "repeat"
        if j - i >= 3 and all(low[x:x + 2] in steps for x in range(i, j - 1)):
            yield 1.6 + math.log10(j - i), "walk"
        for width in (2, 3, 4):
            if (j - i) % width == 0 and j - i >= 2 * width and part == part[:width] * ((j - i) // width):
                yield width * char + math.log10((j - i) // width), "repeat"
    best = {(0, False): 0.0}
    for j in range(1, n + 1):
        for i in range(j):
            for (cost, kind), after in itertools.product(segments(i, j), (False, True)):
                if (i, after) in best and not (kind == "brute" and after):
                    key = (j, kind == "brute")
                    best[key] = min(best.get(key, 1e9), best[i, after] + cost + secrets.MORE)
    return min(v for (j, _), v in best.items() if j == n) if n else 0.0


def test_guess_cost_is_the_cheapest_segmentation():
    rng, ranks = random.Random(2), secrets.Ranks(["aba", "pas", "swo", "ana"])
    parts = ["a", "7", "pass", "qwe", "2001", "Z", "!", "love", "ab", "abab", "aaa", "zyxw", "test", "asdf", "admin", "12", "1990-01-02", "bbb"]
    for value in ["", "a", "password", "P4ssw0rd", "qwerty123", "aaaaab", "1999-12-31x", "x7Gh29Lm4Qp", "zyxwvutest", "aaaadmin"] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(2500)]:
        cost, segments = secrets.guess_cost(value, ranks)
        assert "".join(value[s:e] for s, e, _ in segments) == value
        assert cost == pytest.approx(brute_cost(value, ranks), abs=1e-9), value


def test_long_values_take_linear_time():
    start = time.perf_counter()
    for value in ("a" * 20_000, "ab" * 20_000, "0a1b2c" * 3000, "qwerty" * 5000, "x7" * 9000 + "password" * 900):
        assert secrets.guess_cost(value)[0] < math.inf
    assert time.perf_counter() - start < 20


def test_prose_templates_and_references_are_no_secrets(spark):
    clean = ["The secret is patience and time.", "The token is something else", "the password is mandatory", "passphrase: your_token_here", "pwd = ${TOKEN}", "private_key: process.env.KEY", "pwd: <redacted>",
             "pwd = os.environ['X']", "credentials: get_secret(name)", "auth: settings.auth_token", "pwd: xxxxxxxx", "Authorization: Bearer {{ token }}"]
    assert [t for t in clean if [s for s in secrets.find_spans(t) if s[2] == 3]] == []
    found = {"PASSWORD IS Xk39dkQpz81": "Xk39dkQpz81", "the passphrase iS Xk39dkQpz81.": "Xk39dkQpz81", "pwd='kjhqwerzxcvbnw'": "kjhqwerzxcvbnw", "bearer: 8f3kd92jf8s7dh3k.": "8f3kd92jf8s7dh3k"}
    for text, value in found.items():
        assert [text[s:e] for s, e, k, _ in secrets.find_spans(text) if k == 3] == [value], text
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(clean + ["Wortschatz und Wortspiel", "der Wortschatz ist", None, "", "Nur.Pfad.Wort ein/Wortweg 1Wort"])], "doc_id long, text string")
    words = secrets.learn_words(docs)
    assert "wortschatz" in words and "wort" not in words and words[:3] == ["pwd", "the", "token"]
    assert secrets.learn_words(docs.limit(0)) == [] and len(secrets.learn_words(docs, most=3)) == 3
    assert secrets.guess_cost("Wortschatz", secrets.Ranks(words))[0] < secrets.LEAST_COST < secrets.guess_cost("Wortschatz")[0]


def test_weak_values_cost_less_than_random_ones():
    cost = lambda v: secrets.guess_cost(v)[0]
    assert all(cost(v) < secrets.LEAST_COST for v in ("changeme", "password123", "qwertyuiop", "aaaaaaaaaa", "2024-01-01", "abababababab", "P@ssw0rd"))
    assert all(cost(v) > secrets.LEAST_COST for v in ("b7db7aa4a5fcc78305", "x7Gh29Lm4Qp", "Zx9!kQ2#vB7p"))


def test_secret_query(spark):
    rows = [(i, t) for i, t in enumerate(SECRET_TEXTS)] + [(99, None)]
    found = secrets.digest(secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    for r in found:
        text = dict(rows)[r["doc_id"]] or ""
        base = brute_base_spans(text)
        assert r["base_sha256"] == sha(",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, e, k in base))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for _, _, k in base) for x in range(3)]
        assert set(f"{secrets.KINDS[k]}:{s}:{e}" for s, e, k in base) <= set(r["spans"].split(","))
    guessed = {r["doc_id"] for r in found if r["n_guess"]}
    assert {11, 13, 14} <= guessed and not {12, 15, 99} & guessed


def test_redaction_leaves_nothing_to_find(spark, docs, none):
    dirty = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(SECRET_TEXTS)] + [(50, None, None, None, None)], DOCS)
    out = secrets.redact_secrets(dirty).collect()
    assert len(out) == len(SECRET_TEXTS) + 1
    for r in out:
        assert r["text"] is None or not [s for s in brute_base_spans(r["text"]) if s[2] > 0] and r["n_chars"] == len(r["text"])
    assert secrets.redact_secrets(docs).columns == docs.columns and secrets.redact_secrets(none).count() == 0
    clean = [r for r in sorted_rows(docs.select("doc_id", "text")) if not secrets.find_spans(r[1] or "")]
    masked = sorted_rows(secrets.redact_secrets(docs).select("doc_id", "text"))
    assert set(clean) <= set(masked) and {r for r in masked if r not in clean} == {(i, "[SECRET]") for i, t in {r[:2] for r in docs.select("doc_id", "text").collect()} if t == "ab" * 400}


# --- 2: tokens ---

def test_counts_equal_the_library(spark, docs, none, rows):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.public_model())
    rng = random.Random(3)
    odd = ["".join(rng.choice("ab  \n\té中🙂▁<s>0x41​,.'eſ _-") for _ in range(rng.randint(0, 40))) for _ in range(800)] + ["<s></s><unk><0x41>", "▁▁a", " " * 100, "\x00\x01", "a" * 3000]
    more = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    for table, given in ((more, odd), (docs, [r[1] for r in rows])):
        got = tokens.digest(tokens.count_tokens(table)).collect()
        assert collections.Counter((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == collections.Counter((len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for t in given)
    assert tokens.count_tokens(none).count() == 0
    own = tokens.counter(tokens.public_model())
    for text in odd[:150]:
        assert own.all_counts(text).tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)]


def test_budget_cuts(spark):
    own = tokens.counter(tokens.public_model())
    text = prose(random.Random(4), 200)
    row = tokens.fit_budgets(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), (0, 10, 100, 10_000)).filter("doc_id = 1").first()
    for budget, cut in zip((0, 10, 100, 10_000), row["cuts"], strict=True):
        assert own.count(text[:cut]) <= budget and all(own.count(text[:i]) > budget for i in range(cut + 1, min(cut + 30, len(text)) + 1))


# --- 3 and 4: repeats ---

def brute_words(rows, width: int = 13) -> collections.Counter:
    first = {}
    named = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    for i, w in named:
        for k in range(len(w) - width + 1):
            s = tuple(w[k:k + width])
            if i is not None:
                first[s] = min(first.get(s, i), i)
    out = collections.Counter()
    for i, w in named:
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k:k + width])] < i:
                gone |= set(range(k, k + width))
        out[i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    return out


@pytest.mark.parametrize(("width", "start"), [(13, 7), (13, 2), (5, 7), (8, 1)])
def test_word_repeats_equal_brute_force(docs, rows, width, start):
    got = substrings.digest(substrings.remove_repeats(docs, width, start))
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_words(rows, width)


def brute_bytes(rows, width: int = 100) -> collections.Counter:
    first, named = {}, [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in named:
        for k in range(len(b) - width + 1):
            if i is not None:
                first[b[k:k + width]] = min(first.get(b[k:k + width], (i, k)), (i, k))
    out = collections.Counter()
    for i, b in named:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            if i is not None and first[b[k:k + width]] < (i, k):
                gone[k:k + width] = True
        out[i, len(b), int(gone.sum()), sum(1 for x, _ in itertools.groupby(gone) if x), sha(bytes(np.frombuffer(b, np.uint8)[~gone]))] += 1
    return out


def test_byte_repeats_equal_brute_force(docs, rows, monkeypatch):
    for piece in (suffixes.PIECE, 700):  # long texts in pieces, too
        monkeypatch.setattr(suffixes, "PIECE", piece)
        got = suffixes.digest(suffixes.remove_repeats(docs))
        assert collections.Counter(tuple(r) for r in got.collect()) == brute_bytes(rows)


def test_repeats_of_nothing(none):
    assert substrings.remove_repeats(none).count() == suffixes.remove_repeats(none).count() == 0


def test_a_window_in_all_documents_sends_one_item_per_block():
    names, ids = np.full(5000, 42, np.uint64), np.arange(5000)
    rows = list(exchange.ask_first(names, ids, np.zeros(5000, np.int64), 8, True, True))
    asked = sum(n for b in rows for k, n in zip(b.column("kind").to_pylist(), b.column("n").to_pylist(), strict=True) if k == exchange.ASK)
    assert asked == 1


# --- 5: near duplicates ---

def brute_classes(rows, weights, threshold: float = 0.8) -> dict:
    sets = {i: minhash.weighted((t or "").encode(), 5, weights) for i, t, *_ in rows if i is not None}
    label = {i: i for i in sets}
    for _ in sets:
        before = dict(label)
        for a, b in itertools.combinations(sets, 2):
            if len(sets[a][0]) and len(sets[b][0]) and label[a] != label[b] and minhash.similarity(sets[a], sets[b]) >= threshold:
                label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    return label


def test_classes_equal_brute_force(docs, rows):
    got = minhash.near_duplicates(docs).collect()
    want = brute_classes(rows, minhash.weigh(docs, 5, "doc_id", "text"))
    assert collections.Counter((r["doc_id"], r["class_id"]) for r in got) == collections.Counter((i, want.get(i)) for i, *_ in rows)
    assert len({v for v in want.values()}) < len(want)
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == collections.Counter(i for i, *_ in rows if want.get(i) == i)


def test_no_near_duplicates_of_nothing(none):
    assert minhash.near_duplicates(none).count() == 0


def test_frequent_shingles_weigh_less_and_counts_are_exact(spark, monkeypatch):
    monkeypatch.setattr(minhash, "COMMON", 4)
    rng = random.Random(6)
    texts = ["one two three four five " + prose(rng, 20) for _ in range(40)]
    w = minhash.weigh(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, "doc_id", "text")
    names, weights = minhash.weighted(b"one two three four five six", 5, w)
    frequent = arrays.window_hashes(arrays.word_hashes(np.frombuffer(b"one two three four five", np.uint8), np.array([0, 4, 8, 14, 19]), np.array([3, 7, 13, 18, 23])), 5)[0]
    assert 40 in w.df and weights[names == frequent] == 1 and weights[names != frequent] == pytest.approx(1 + minhash.IDF)


def test_samples_agree_as_often_as_weights_overlap(monkeypatch):
    monkeypatch.setattr(minhash, "SAMPLES", 2000)
    rng = np.random.default_rng(7)
    names = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    a, b = np.sort(names[:45]), np.sort(names[15:])
    wa, wb = rng.uniform(1, 4, 45), rng.uniform(1, 4, 45)
    s = minhash.signatures(np.concatenate([a, b]), np.repeat([0, 1], 45), np.concatenate([wa, wb]), 2)
    assert (s[0] == s[1]).mean() == pytest.approx(minhash.similarity((a, wa), (b, wb)), abs=0.04)


def edited_copies(rng: random.Random, n: int) -> list[str]:
    """Two texts and many copies of them with a few words replaced, dropped or added: pairs on both sides of the threshold."""
    bases, out = [prose(rng, 90).split(" ") for _ in range(2)], []
    for k in range(n):
        words = list(bases[k % 3 == 0])
        for _ in range(rng.choice((0, 1, 2, 2, 3, 4, 6))):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice(([f"new{rng.randrange(30)}"], [], [words[at], f"more{rng.randrange(30)}"]))
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("pivots", [0, 1, 3])
def test_bounds_lose_no_link(spark, monkeypatch, pivots):
    """Large groups of near copies, many links near the threshold: classes are those of brute force, however few pairs are compared."""
    texts = edited_copies(random.Random(21), 150)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compared, real = [], minhash.observed

    def observed(df, **metrics):
        out = real(df, **metrics)
        compared.append(out[0].count())
        return out
    monkeypatch.setattr(minhash, "observed", observed)
    weights = minhash.weigh(table, 5, "doc_id", "text")
    got = minhash.near_duplicates(table, pivots=pivots).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(list(enumerate(texts)), weights)
    assert sum(compared) < (150 * 149 // 2) / (2 if pivots else 1)
    sets = [minhash.weighted(t.encode(), 5, weights) for t in texts]
    for r in got:
        linked = r["like_id"] is not None
        assert linked == (r["similarity"] is not None) and (not linked or r["similarity"] == pytest.approx(minhash.similarity(sets[r["doc_id"]], sets[r["like_id"]])) and r["similarity"] >= 0.8)
        assert linked or r["class_id"] == r["doc_id"]


def test_a_hot_passage_makes_few_pairs(spark, monkeypatch):
    """Documents that share a third of their words meet in buckets, but their texts aren't compared pair by pair."""
    rng = random.Random(13)
    passage = prose(rng, 50)
    table = spark.createDataFrame([(i, prose(rng, 50) + " " + passage + " " + prose(rng, 50)) for i in range(400)], "doc_id long, text string")
    compared = []
    real = minhash.observed

    def observed(df, **metrics):
        out = real(df, **metrics)
        compared.append(out[0].count())
        return out
    monkeypatch.setattr(minhash, "observed", observed)
    got = minhash.near_duplicates(table).collect()
    assert all(r["doc_id"] == r["class_id"] for r in got) and sum(compared) == 0


def test_every_two_samples_of_a_square_share_a_band():
    for square in range(minhash.SQUARES):
        own = range(square * 16, square * 16 + 16)
        assert all(sum(a in line and b in line for line in minhash.bands()) == 1 for a, b in itertools.combinations(own, 2))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 150), (150, 199), (3, 3), (1, 0)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}, 200: 150, 150: 150, 199: 150}


def test_a_bucket_of_many_classes_is_worked_off(spark, monkeypatch):
    """All in one bucket, with more classes than rounds."""
    rng = random.Random(8)
    bases = [prose(rng, 60) for _ in range(6)]
    texts = [b + (f" tail{k}" if k else "") for b in bases for k in range(3)]
    rng.shuffle(texts)
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(minhash, "_sign", _one_bucket)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(table).collect()}
    stems = [t.split(" tail")[0] for t in texts]
    assert got == {i: stems.index(s) for i, s in enumerate(stems)}


def test_a_pair_is_compared_whatever_other_bands_look_like(spark, monkeypatch):
    """Keys of an earlier band that differ, but not in their lowest 28 bits."""
    rng = random.Random(9)
    bases = [prose(rng, 60) for _ in range(4)]
    texts = [b + tail for b in bases for tail in ("", " tail", " other")]
    monkeypatch.setattr(minhash, "_sign", _late_bucket)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i - i % 3 for i in range(len(texts))}


def _late_bucket(width, weights):
    import pyarrow as pa

    def run(batches):
        for b in batches:
            same = [hashlib.md5(t.encode()).digest() for t in b.column(1).to_pylist()]
            keys = [[int.from_bytes(x[:4], "little") << 28, 9] for x in same]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(same, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "same", "keys"])
    return run


def _one_bucket(width, weights):
    import pyarrow as pa

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([hashlib.md5(t.encode()).digest() for t in texts], pa.binary()), pa.array([[9]] * len(texts), pa.list_(pa.int64()))], names=["doc_id", "same", "keys"])
    return run


# --- 6: language ---

def test_held_out_accuracy_and_odd_texts(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = llm.QUERIES["op6_language_id"](spark, FOLDER).join(table.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out)
    model = language.train(table)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (4, "中文"), (5, "the " * 30000)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.classify(odd, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3 and got[4][0] in model.languages and got[5][0] == "en"
    assert [r["doc_id"] for r in language.keep_languages(odd, model).orderBy("doc_id").collect()] == [4, 5]


def test_long_texts_score_like_short_ones_and_stay(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    rng, table = random.Random(3), spark.read.parquet(f"{FOLDER}/documents.parquet")
    words = collections.defaultdict(list)
    for r in table.filter("lang is not null").orderBy("doc_id").collect():
        words[r["lang"]] += r["text"].split(" ")
    long, size = [], 15_000_000
    for lang, w in sorted(words.items()):
        plain = [x for _, x in zip(range(400_000), itertools.cycle(w))]
        ids = [f"{x} {rng.getrandbits(128):032x}" if k % 12 == 0 else x for k, x in enumerate(plain)]
        tables = [" ".join(plain[:100_000]), " ".join(f"{rng.random():.6f}" for _ in range(200_000))]
        long += [(lang, " ".join(plain)), (lang, " ".join(ids)), (lang, "\n".join(tables))]
    lang = "en" if "en" in words else min(words)
    text = " ".join(f"{x} {rng.getrandbits(64):x}" if k % 12 == 0 else x for k, x in zip(range(size // 5), itertools.cycle(words[lang])))
    long.append((lang, text[:size]))
    assert len(words) >= 4 and all(len(t) > 2_000_000 for _, t in long)
    model, labels = language.train(table), [x for x, _ in long]
    predicted, scores = language.classify_texts([t for _, t in long], model)
    short = np.mean(language.classify_texts([t[a:a + 4000] for _, t in long[::3] for a in range(0, 200_000, 4000)], model)[1])
    assert predicted == labels and min(scores) > 0.8 and max(abs(s - short) for s in scores[::3]) < 0.1, (predicted, scores, short)
    added = spark.createDataFrame([(10_000_000 + i, t, None, "src1", len(t)) for i, (_, t) in enumerate(long)], DOCS).repartition(4)
    kept = corpus_pipeline.language_stage(spark, table.select("doc_id", "text", "lang", "source", "n_chars").union(added), FOLDER).filter("doc_id >= 10000000")
    assert kept.count() == len(long)


def test_training_never_sees_held_out_rows(spark):
    import zlib
    table = spark.createDataFrame([(i, f"word{i}", "en" if i % 2 else "fr") for i in range(300)], "doc_id long, text string, lang string")
    seen = language.training_sample(table, per_language=1000)["text"]
    assert set(seen) == {f"word{i}" for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1}
    out = language.digest(language.classify(table, language.train(table))).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)


def test_the_training_sample_holds_a_text_once(spark):
    given = [(i, "copied words" if i % 3 else f"own words {i}", "fr" if i % 2 else "en") for i in range(600)]
    given += [given[0], given[9], (601, "copied words", None), (None, "copied words", "en")]
    table = spark.createDataFrame(given, "doc_id long, text string, lang string").repartition(5)
    import zlib
    for most in (20, 10_000):
        seen = language.training_sample(table, per_language=most)
        for lang in ("en", "fr"):
            texts = list(seen[seen["label"] == lang]["text"])
            every = {t for i, t, x in given if x == lang and i is not None and zlib.crc32(str(i).encode()) % 3 != 1}
            assert len(texts) == len(set(texts)) == min(most, len(every)) and set(texts) <= every


def test_kernel_is_the_share_of_common_grams():
    a, b = "abc", "abd"
    grams = lambda t: {t[i:i + n].encode() for n in range(1, 4) for i in range(len(t) - n + 1)}
    rows = language.presence([a, b])
    assert float(rows[0] @ rows[1]) == pytest.approx(len(grams(a) & grams(b)) / len(grams(a)), abs=1e-5)


def test_no_labels_no_language(spark, none):
    table = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language.classify(table, language.train(table)).first()["lang_pred"] == "und"
    assert language.classify(none, language.train(none)).count() == 0


# --- 7: neighbours ---

def brute_nearest(vectors: dict[int, list], k: int) -> dict[int, list[int]]:
    ids = np.array(sorted(vectors))
    m = np.array([vectors[i] for i in ids], np.float64)
    n = np.linalg.norm(m, axis=1)
    cos = m @ m.T / n / n[:, None]
    return {int(i): [int(ids[j]) for j in np.lexsort((ids, -np.round(cos[r], 12))) if j != r][:k] for r, i in enumerate(ids) if i % 50 == 0}


def test_neighbours_in_many_parts(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((20, 16))
    vectors = {i: (centres[i % 20] + 0.3 * rng.standard_normal(16)).tolist() for i in range(3000)}
    vectors |= {i: vectors[1] for i in range(3000, 3900)}  # a group of equal vectors larger than a part
    table = spark.createDataFrame([*vectors.items(), (5000, None), (5050, [0.0] * 16), (5100, [float("nan")] + [1.0] * 15), (5150, [None] + [1.0] * 15), (5200, [1.0, 2.0]), (None, [1.0] * 16), (50, vectors[50])],
                                  "vec_id long, embedding array<float>")
    got = neighbours.nearest(table.withColumn("point", F.lit(1)), F.col("id") % 50 == 0, part=256).collect()
    floats = {i: np.array(v, np.float32).astype(np.float64).tolist() for i, v in vectors.items()}
    want = brute_nearest(floats, 5)
    mine = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        mine[r["query_id"]].append(r["vec_id"])
        a, b = np.array(floats[r["query_id"]]), np.array(floats[r["vec_id"]])
        assert r["score"] == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
    assert set(mine) == set(want) and all(len(v) == 5 for v in mine.values())
    assert np.mean([len(set(mine[q]) & set(want[q])) / 5 for q in want]) >= 0.9
    assert all(mine[q] == want[q] for q in want if q >= 3000)  # ties to the smaller id


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(few, F.col("id") % 50 == 0).collect())
    assert got == [(0, 1, 50), (0, 2, 1), (50, 1, 0), (50, 2, 1)]
    assert neighbours.nearest(few.limit(0), F.col("id") % 50 == 0).count() == 0


@pytest.mark.parametrize("clusters", [0, 60])
def test_the_index_prunes_and_finds(clusters):
    """Even without any structure few vectors are verified; with clusters hardly any."""
    rng = np.random.default_rng(4)
    n, d = 30_000, 64
    vectors = rng.standard_normal((n, d))
    if clusters:
        vectors = rng.standard_normal((clusters, d))[np.arange(n) % clusters] + 0.4 * vectors
    planes, limit = neighbours.projection(d), neighbours.chi_square_quantile(neighbours.CHANCE, neighbours.PROJECTED)
    tree, asked = neighbours.Tree(np.arange(n), vectors, planes), neighbours.unit(vectors[::300])
    best = tree.search(asked, asked @ planes, 6, limit, np.full(len(asked), 4.0))
    cosines = asked @ neighbours.unit(vectors).T
    true = np.argsort(-cosines, axis=1)[:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(true, best.ids, strict=True)]) >= 0.9
    assert tree.verified / len(asked) / n < (0.05 if clusters else 0.3)


def test_very_large_and_small_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 8))
    scale = [(1.0, 1e200, 1e-200, 1e-310)[i % 4] for i in range(300)]
    table = spark.createDataFrame([(i, (v * x).tolist()) for i, (v, x) in enumerate(zip(base, scale, strict=True))], "vec_id long, embedding array<double>")
    got = neighbours.nearest(table, F.col("id") % 50 == 0).collect()
    u = base / np.linalg.norm(base, axis=1)[:, None]
    assert len(got) == 30
    for r in got:
        assert r["score"] == pytest.approx(u[r["query_id"]] @ u[r["vec_id"]], abs=1e-9 if 3 not in (r["query_id"] % 4, r["vec_id"] % 4) else 1e-2)


def test_chi_square_quantiles():
    for k, p, x in ((2, 0.95, 5.991465), (4, 0.95, 9.487729), (8, 0.98, 18.168231)):
        assert neighbours.chi_square_quantile(p, k) == pytest.approx(x, abs=1e-4)


# --- 8: decontamination ---

def brute_hits(docs, items, width: int = 10) -> collections.Counter:
    grams = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            if item is not None:
                grams[tuple(w[i:i + n])].add(str(item))
    out = collections.Counter()
    for i, text, *_ in docs:
        w, hit, found = ALNUM.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (own := grams.get(tuple(w[k:k + n]))):
                    hit |= set(range(k, k + n))
                    found |= own
        out[i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)] += 1
    return out


def test_benchmark_hits_equal_brute_force(spark, docs, rows):
    words = ALNUM.findall(rows[5][1].translate(LOWER))
    items = [(1, rows[2][1].upper()), (10, rows[2][1]), (2, " ".join(words[:12])), (3, words[0]), (4, None), (5, "!!"), (None, "the"), (6, "absent words of a test item that stands nowhere at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (decontaminate.MAX_WINDOWS, 60):
        got = collections.Counter(tuple(r) for r in decontaminate.digest(decontaminate.hit_words(docs, bench, max_windows=most)).collect())
        assert got == brute_hits(rows, items)
    kept = decontaminate.decontaminate(docs, bench)
    dirty = {k[0] for k in brute_hits(rows, items) if k[5]} - {None}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, *_ in rows} - dirty
    assert decontaminate.hit_words(docs, bench.limit(0)).filter("size(hits) > 0").count() == 0
    assert decontaminate.hit_words(docs.limit(0), bench).count() == 0


# --- 9: mixing ---

def brute_targets(sizes: dict, weights=(5, 2, 1), most: float = 3.0) -> dict:
    """Shares, cuts what is above the limit, shares that again by weight, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    open_, target, rest = set(order), {}, float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if rest * weight[s] / total > most * sizes[s] * (1 + 1e-12)]
        if not above:
            target |= {s: rest * weight[s] / total for s in open_}
            break
        for s in above:
            target[s] = most * sizes[s]
            open_.discard(s)
        rest = float(sum(sizes.values())) - sum(target.values())
    return target


def test_mix_meets_its_targets(spark, docs, rows):
    rng = random.Random(10)
    many = [(i, prose(rng, rng.randint(0, 60)), "en", rng.choice(["a", "a", "a", "a", "b", "é", "Z", None, ""]), 0) for i in range(4000)] + [(9000, "one two", "en", "tiny", 7), (9001, None, "en", "void", 0)]
    got = mixing.digest(mixing.mix(spark.createDataFrame(many, DOCS))).collect()
    again = mixing.digest(mixing.mix(spark.createDataFrame(many, DOCS).repartition(7))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in many}
    source = {i: s for i, _, _, s, _ in many}
    sizes = collections.Counter({s: 0 for s in source.values()})
    for i in size:
        sizes[source[i]] += size[i]
    want, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and r["taken"] <= 3 * r["size"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    assert mixing.mix(docs).count() == len(rows) and mixing.mix(docs.limit(0)).count() == 0


# --- 10: licenses ---

LICENSE_TEXTS = ["Licensed under the Apache License, Version 2.0.", "CC BY 4.0 and cc-by-sa 3.0", "This work is licensed under the GNU General Public License v3 or later. All rights reserved.", "all  rights\nreserved", "ALL RIGHTS RESERVED all rights reserved",
                 "SPDX-License-Identifier: MIT", "general public licenses", "xcc by", "cc byé", "the mit of it", "", "accby", "CC,BY", "general public license"]


def test_base_phrases_equal_brute_force(spark, docs, rows):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(LICENSE_TEXTS)] + [(99, None)], "doc_id long, text string")
    given = [*enumerate(LICENSE_TEXTS), (99, None)]
    for df, texts in ((table, given), (docs, [(r[0], r[1]) for r in rows])):
        want = collections.Counter()
        for i, t in texts:
            w = ALNUM.findall((t or "").translate(LOWER))
            places = sorted((k, label) for phrase, label in licenses.BASE.items() for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split())
            want[i, len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({p[1] for p in places}))] += 1
        got = licenses.digest(licenses.scan_licenses(df)).collect()
        assert collections.Counter(tuple(r)[:6] for r in got) == want
        assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)


def test_words_of_a_base_phrase_stand_any_distance_apart(spark):
    gaps = [" ", " -- ", "\n\n    ", " \t.;:!?-" * 50, "\r\n" * 3000]
    texts = [start + gap.join(phrase.split()) + end for phrase in licenses.BASE for gap in gaps for start, end in (("", ""), ("under", ""), ("under ", " 4"), ("* Some WORDS, ", " --  "))]
    given = [(i, t) for i, t in enumerate(texts)]
    want = {}
    for i, t in given:
        w = ALNUM.findall(t.translate(LOWER))
        want[i] = (len(w), [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()])
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert {i: (r["n_words"], [tuple(b) for b in r["base"]]) for i, r in got.items()} == want
    assert sum(bool(places) for _, places in want.values()) == len(texts) * 3 // 4
    assert all({b["label"] for b in r["base"]} <= {d["label"] for d in r["detections"]} for r in got.values() if r["base"] and r["base"][0]["label"] != "gpl")


def written(pattern: str) -> set[str]:
    """The texts that a rule's pattern stands for, with a digit for any digits."""
    for found in (r"\(\?:([^()]*)\)(\?)?", r"\[([sc])([sc])\]", r"(?<!\\)([a-z ])(\?)"):
        if m := re.search(found, pattern):
            options = m[1].split("|") + ([""] if m[2] == "?" else [m[2]] if m[2] else [])
            return set().union(*(written(pattern[:m.start()] + x + pattern[m.end():]) for x in options))
    for part, text in ((r"[\d ]*", ""), (r"[\d.]+", "9"), (r"\d+", "9"), (r"\d", "9"), ("\\ ", " ")):
        pattern = pattern.replace(part, text)
    return {pattern}


def test_every_name_is_found_in_a_text_that_holds_nothing_else():
    import pyarrow as pa
    wanted = {(r.label, text) for r in licenses.rules() if r.form == "name" for text in written(r.pattern)}
    assert {"expat license", "psf licence", "creative commons zero", "creative commons attribution noncommercial noderivs", "no part of this work may be reproduced", "copyright 1999"} <= {t for _, t in wanted}
    labels, texts = zip(*sorted(wanted), strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    found = [row["detections"] for out in licenses._scan(iter([batch])) for row in out.to_pylist()]
    missed = [(label, text) for label, text, d in zip(labels, texts, found, strict=True) if (0, len(text.split()) - 1, label) not in {(x["first"], x["last"], x["label"]) for x in d}]
    assert missed == []


def test_a_rule_stands_behind_a_literal_of_its_own_pattern():
    for r in licenses.rules():
        texts = written(r.pattern)
        assert all(re.fullmatch(r.pattern, t) and r.literal in t for t in texts) and len(r.literal) > 2, (r.label, r.form)
    for pattern, literal in (("a licen[sc]e", "a licen"), ("ab?cd", "cd"), ("(?:x (?:y )?)?abc", "abc"), (r"ab \d+ c", "ab ")):
        assert licenses.literal_of(pattern) == literal
    with pytest.raises(ValueError):
        licenses.literal_of("one licence|another")


def test_rules_and_suppression():
    assert len(licenses.rules()) > 300
    label = lambda t: [(r.label, r.form) for _, _, r in licenses.detect(" ".join(ALNUM.findall(t.translate(LOWER))).encode())]
    assert label("Licensed under the Apache License, Version 2.0") == [("apache", "notice")]
    assert label("the GNU Lesser General Public License") == [("lgpl", "name")]
    assert label("CC BY-SA 4.0") == [("cc-by-sa", "version")]
    assert label("SPDX-License-Identifier: Apache-2.0") == [("apache", "tag")]
    assert label("a clean sentence about licensing apples") == []
    found = licenses.detect(b"licensed under the gnu general public license 3 all rights reserved cc by nc nd 4 0")
    assert not any(a <= s and e <= b and (a, b) != (s, e) for s, e, _ in found for a, b, _ in found)


# --- All of them ---

@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_equals_sql(spark, name):
    problem = compare(llm.QUERIES[name](spark, FOLDER), connect(FOLDER), llm.ORACLE[name])
    assert problem is None, problem


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in llm.QUERIES) == list(range(1, 11))


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    """Each stage on its own input: what has to go goes, all other rows stay, whole."""
    rng = random.Random(11)
    source = f"{FOLDER}/documents.parquet"
    if not os.path.exists(source):
        pytest.skip("no test tables")
    table = spark.read.parquet(source).limit(300)
    given = [tuple(r) for r in table.collect()]
    base = given[0][1]
    bench = prose(rng, 30)
    words = base.split(" ")
    words[len(words) // 2] = "other"
    given += [(10_001, base, "fr", "src1", len(base)), (10_002, " ".join(words), "fr", "src2", 0), (10_003, given[1][1] + " " + bench, "en", None, 0), (10_004, "1234 !!", "en", "src1", 7), (10_005, None, None, "src1", None),
              (10_006, given[4][1] + ' token = "' + "1beb58b8af68854f0e01" * 2 + '"', "fr", "src3", 0)]
    folder = str(tmp_path)
    spark.createDataFrame(given, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        after = [tuple(r) for r in docs.collect()]
        if name != "mixing":
            assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
        gone = {r[0] for r in before} - {r[0] for r in after}
        if name == "language_id":
            assert gone == {10_004, 10_005}
        if name == "near_duplicates":
            want = brute_classes(before, minhash.weigh(spark.createDataFrame(before, DOCS), 5, "doc_id", "text"))
            assert gone == {i for i, c in want.items() if i != c} and {10_001, 10_002} <= gone
        if name == "decontamination":
            assert gone == {10_003}
        if name == "secrets":
            changed = {a[0] for a, b in zip(sorted(before), sorted(after), strict=True) if a[1] != b[1]}
            assert not gone and changed == {r[0] for r in before if secrets.find_spans(r[1])} and not any(brute_base_spans(r[1])[:1] for r in after if r[0] == 10_006)
        if name == "mixing":
            sizes = collections.Counter()
            for r in before:
                sizes[r[3]] += len(WORD.findall(r[1]))
            want, taken = brute_targets(sizes), collections.Counter()
            for r in docs.collect():
                taken[r["source"]] += len(WORD.findall(r["text"])) * r["copies"]
            longest = max(len(WORD.findall(r[1])) for r in before)
            assert all(abs(taken[s] - want[s]) <= longest for s in sizes)
    assert sorted_rows(corpus_pipeline.run(spark, folder)) == sorted_rows(docs)


# --- 10: signatures by hand, and suppression ---

def _lowered(text: str) -> bytes:
    return " ".join(ALNUM.findall(text.translate(LOWER))).encode()


def test_texts_that_name_no_licence_are_known():
    said = {"mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal"],
            "bsd": ["Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions are met:", "BSD-3-Clause"],
            "gpl": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "GPLv3", "released under GPL 3",
                    "https://www.gnu.org/licenses/gpl-3.0.html"],
            "psf": ["SPDX-License-Identifier: Python-2.0"], "apache": ["http://www.apache.org/licenses/LICENSE-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
            "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"], "cc-by-sa": ["https://creativecommons.org/licenses/by-sa/4.0/"], "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
            "unlicense": ["This is free and unencumbered software released into the public domain."], "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."]}
    for label, texts in said.items():
        for text in texts:
            assert label in {r.label for _, _, r in licenses.detect(_lowered(text))}, text


def test_literals_lose_no_match(spark):
    """The rules with and without a look for their literals, over the whole table and made-up texts of their own words."""
    rng = random.Random(3)
    vocabulary = sorted({w for r in licenses.rules() for w in re.findall("[a-z]+", r.pattern)})
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect() if r["text"]][:300] if os.path.isdir(FOLDER) else []
    texts += [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(100)]
    texts += [f"{rng.choice(vocabulary)} {p} {rng.choice(vocabulary)}" for r in licenses.rules() for p in (re.sub(r"\(\?:([^|()]*)[^()]*\)\??", r"\1", r.pattern),)]
    for text in texts:
        words = _lowered(text)
        assert sorted(licenses.candidates(words)) == sorted(licenses.candidates(words, gated=False))


def test_suppression_equals_a_comparison_with_all(monkeypatch):
    rng, rules = random.Random(4), licenses.rules()
    for _ in range(200):
        found = []
        for _ in range(rng.randint(0, 40)):
            s, k = rng.randrange(60), rng.randrange(len(rules))
            found.append((s, s + rng.randint(1, 25), k, rules[k]))
        kept = []
        for s, e, _, r in sorted(found, key=lambda f: (-f[3].priority, f[0] - f[1], f[2], f[0])):
            if not any(a <= s and e <= b for a, b, _ in kept):
                kept.append((s, e, r))
        assert licenses.suppressed(found) == sorted(kept, key=lambda k: k[:2])
    many = [(10 * i, 10 * i + 8, 0, rules[0]) for i in range(40_000)]
    start = time.perf_counter()
    assert len(licenses.suppressed(many)) == 40_000 and time.perf_counter() - start < 10
