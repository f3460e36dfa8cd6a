"""Secret scans: fixed patterns, and values in credential contexts whose guess cost is high by a minimum-cost segmentation."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A

#: Kinds of base spans in the order in which ties are listed, their patterns and the least length of the value (fixed values).
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
KINDS, MIN_VALUE, MIN_ACCESS, MIN_HEX = ("assign", "access", "hex", "guess"), 6, 20, 24
#: Hexadecimal runs are long enough to be seen in steps: every run of 24 has a character of every 24th place.
_HEX24 = re.compile("[0-9a-f]{24,}")

#: More names that announce a credential; their values count by guess cost alone. Groups: what stands between, an opening quote, the value.
CONTEXT = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|(?:access|private|auth|account|client)[_-]?(?:key|id|secret|token)|credentials?|bearer|authorization|auth)["']?\x20*([:=]|=>|\x20is\x20)\x20*(["']?)(?:(?:bearer|basic)\x20+)?([^\s"'<>,;]{6,})""", re.I | re.A)
_IS = re.compile("\x20[Ii][Ss]\x20")
#: Values that name a place where the secret is, rather than the secret: variables, templates, calls, members.
REFERENCE = re.compile(r"\$\{?\w|\{\{|%[({]|@\w+@|[A-Za-z_][\w.]*[(\[]|[A-Za-z_]+(?:(?:\.|::|->)[A-Za-z_]+)+$")
#: Ends of a sentence or of an expression, not of a value.
CLOSING = ".!?)]}:`*"
#: log10 of the guesses from which a value counts as a secret rather than a word or a placeholder.
LEAST_COST = 8.0

#: Words that people choose or that stand as placeholders, by falling frequency: the place is the number of guesses. Words of the corpus follow them (`learn_words`), so many of the most frequent.
RANKED = 50_000
WORDS = ("password", "admin", "welcome", "letmein", "monkey", "dragon", "master", "login", "princess", "sunshine", "shadow", "football", "baseball", "secret", "changeme", "example", "test", "user", "guest",
         "root", "default", "none", "null", "true", "false", "token", "value", "string", "your", "my", "the", "this", "here", "key", "pass", "word", "required", "optional", "hidden", "placeholder", "summer", "winter",
         "spring", "autumn", "love", "hello", "world", "super", "star", "iloveyou", "trustno", "batman", "soccer", "killer", "michael", "jordan", "computer", "internet", "server", "service", "account", "access",
         "public", "private", "system", "manager", "office", "company", "money", "freedom", "whatever", "cookie", "coffee", "cheese", "banana", "orange", "purple", "yellow", "silver", "golden", "diamond",
         "flower", "tiger", "eagle", "falcon", "phoenix", "ninja", "hunter", "ranger", "matrix", "blue", "green", "black", "white", "red", "one", "two", "three", "four", "five", "undefined", "env", "config")
#: Rows of keys: runs along a row, either way, are cheap.
KEY_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "0123456789")
SWAPS = str.maketrans("@4830157$!", "aabeoist" + "si")
DATES = tuple(map(re.compile, (r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d", r"(?:19|20)\d\d")))
#: A word of prose: letters with nothing of a name, path or number beside them.
_PROSE = "(?<![a-z0-9+/_=.-])[a-z]{3,24}(?![a-z0-9+/_=-])"
#: log10 of the guesses for where a segment ends, for a word in other case, and with letters swapped for signs.
MORE, CASED, SWAPPED = 0.5, 0.3, 0.6


@lru_cache(1)
def _steps() -> frozenset[str]:
    return frozenset(r[i:i + 2] for row in KEY_ROWS for r in (row, row[::-1]) for i in range(len(r) - 1))


class Ranks:
    """log10 of the guesses of each known word, and the length of the longest."""

    def __init__(self, words: Sequence[str] = ()):
        self.of: dict[str, float] = {}
        for word in (*WORDS, *words):
            self.of.setdefault(word, math.log10(len(self.of) + 2))
        self.longest = max(map(len, self.of))


@lru_cache(1)
def _fixed() -> Ranks:
    return Ranks()


def learn_words(docs: DataFrame, text_col: str = "text", most: int = RANKED) -> list[str]:
    """The words of prose that most texts have, lowered, most frequent first: `most` of them at most, whatever the corpus, and only those that two texts and one in 20,000 have, so that few are compared
    for the first places. A word counts once a text, in partial sums before the shuffle."""
    least = max(2, docs.count() // 20_000)
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_PROSE), F.lit(0)))
    words = docs.select(A.quoted(text_col).cast("string").alias("text")).select(F.explode(found).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return [r["w"] for r in words.filter(F.col("n") >= least).orderBy(F.desc("n"), "w").limit(most).collect()]


def _per_char(value: str) -> float:
    """log10 of the alphabet that a brute-force search of this value has to try for a character."""
    size = 26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value) + 10 * any("0" <= c <= "9" for c in value) + 33 * any(not (c.isascii() and c.isalnum()) for c in value)
    if size in (36, 10) and all(c in "0123456789abcdef" for c in value):
        size = 16 if size == 36 else 10
    return math.log10(max(size, 2))


def guess_cost(value: str, ranks: Ranks | None = None) -> tuple[float, list[tuple[int, int, str]]]:
    """(log10 of the guesses, segments) of the cheapest way to split a value into words, dates, repeats, keyboard walks and brute-force spans.

    Dynamic programming over prefixes, one state for a brute-force span that may go on and one for anything else. Each segment costs its guesses and MORE. An empty value costs nothing.
    Inside a run of one character, of a repeated block or of a walk, few starts can be cheapest (`starts`): another one is dearer than the run's begin. Runs are tried from these, to every end, so
    that the time follows the length of a value.
    """
    n, ranks, steps, char = len(value), ranks or _fixed(), _steps(), _per_char(value)
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(SWAPS)
    inf = math.inf
    free, brute = [0.0] + [inf] * n, [inf] * (n + 1)  # cheapest prefixes that end with another segment, or with a brute-force span
    from_free: list[tuple[int, str, bool]] = [(0, "", False)] * (n + 1)  # start, kind, whether the prefix before ends in a brute-force span
    from_brute = [0] * (n + 1)

    def put(i: int, j: int, cost: float, kind: str) -> None:
        before = min(free[i], brute[i])
        if before + cost + MORE < free[j] - 1e-12:
            free[j], from_free[j] = before + cost + MORE, (i, kind, brute[i] < free[i])

    def starts(i: int, run, width: int = 1) -> bool:
        """Whether a segment of a run may be cheapest from i: at its begin (in each phase), or behind a segment from before it, or a word out of phase."""
        if i < begins[run] + width:
            return True
        at, kind, _ = from_free[i]
        return free[i] <= brute[i] and (at < begins[run] or width > 1 and kind in ("word", "date") and (i - at) % width > 0)

    def run_end(i: int, same) -> int:
        j = i + 1
        while j < n and same(j):
            j += 1
        return j
    ends = {"repeat": 0, "walk": 0, 2: 0, 3: 0, 4: 0}
    begins = dict.fromkeys(ends, 0)
    for i in range(n):
        if brute[i] + char < brute[i + 1]:
            brute[i + 1], from_brute[i + 1] = brute[i] + char, from_brute[i]
        if free[i] + MORE + char < brute[i + 1]:
            brute[i + 1], from_brute[i + 1] = free[i] + MORE + char, i
        for j in range(i + 3, min(n, i + ranks.longest) + 1):
            if (rank := ranks.of.get(low[i:j])) is not None:
                put(i, j, rank + (CASED if low[i:j] != value[i:j] else 0.0), "word")
            elif (rank := ranks.of.get(plain[i:j])) is not None:
                put(i, j, rank + SWAPPED, "word")
        if value[i] in "0123":
            for k, pattern in enumerate(DATES):
                if m := pattern.match(value, i):
                    put(i, m.end(), 2.1 if k == 2 else 4.6, "date")
        if i + 1 >= ends["repeat"]:
            begins["repeat"], ends["repeat"] = i, run_end(i, lambda j: value[j] == value[j - 1])
        if ends["repeat"] - i >= 3 and starts(i, "repeat"):
            for j in range(i + 3, ends["repeat"] + 1):
                put(i, j, char + math.log10(j - i), "repeat")
        if i + 1 >= ends["walk"]:
            begins["walk"], ends["walk"] = i, run_end(i, lambda j: low[j - 1:j + 1] in steps)
        if ends["walk"] - i >= 3 and starts(i, "walk"):
            for j in range(i + 3, ends["walk"] + 1):
                put(i, j, 1.6 + math.log10(j - i), "walk")
        for width in (2, 3, 4):  # a block said again, if it is not a shorter one said several times
            if value[i:i + width] in (value[i] * width, value[i:i + 2] * (width // 2) if width == 4 else ""):
                continue
            if i + width >= ends[width]:
                begins[width], ends[width] = i, run_end(i + width - 1, lambda j: value[j] == value[j - width])
            if ends[width] - i >= 2 * width and starts(i, width, width):
                for j in range(i + 2 * width, ends[width] + 1, width):
                    put(i, j, width * char + math.log10((j - i) // width), "repeat")
    out, j, in_brute = [], n, n > 0 and brute[n] < free[n]
    while j:
        if in_brute:
            i, kind, before = from_brute[j], "brute", False
        else:
            i, kind, before = from_free[j]
        out.append((i, j, kind))
        j, in_brute = i, before
    return min(free[n], brute[n]), out[::-1]


def _is_placeholder(value: str) -> bool:
    """Fixed words joined by signs, such as your_token_here."""
    return all(not part.strip("x") or part in WORDS for part in re.split("[_.-]+", value.lower()))


def _is_prose(value: str) -> bool:
    """Letters alone, of one case but for the first."""
    return value.isalpha() and (value[1:].islower() or not any(c.lower() != c.upper() for c in value))


def find_spans(text: str, least_cost: float = LEAST_COST, ranks: Ranks | None = None) -> list[tuple[int, int, int, float]]:
    """(start, end, kind number, cost) of all spans, sorted by start, then kind. cost is 0 but for the method's own.

    A value in a credential context counts by its guess cost, without what closes the sentence behind it. A word of prose that stands without quotes does not count, nor does a value that
    says where the secret is (`REFERENCE`).
    """
    spans = []
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1, 0.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), m.end(), 2, 0.0) for m in _HEX24.finditer(text)]
    if ":" in text or "=" in text:
        spans += [(m.start(), m.end(), 0, 0.0) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= MIN_VALUE]
    if ":" in text or "=" in text or _IS.search(text):
        for m in CONTEXT.finditer(text):
            value = m[3].rstrip(CLOSING)
            if len(value) < MIN_VALUE or REFERENCE.match(value) or _is_placeholder(value) or not m[2] and _is_prose(value):
                continue
            cost, _ = guess_cost(value, ranks)
            if cost >= least_cost:
                spans.append((m.start(3), m.start(3) + len(value), 3, cost))
    return sorted(spans, key=lambda s: (s[0], s[2]))


SCHEMA = "doc_id long, spans array<struct<start: long, end: long, kind: string, cost: double>>, base_sha256 string, redacted string"


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k, _ in spans)


def redact(text: str, spans, mark: str = "[SECRET]") -> str:
    """The text with every stretch that spans cover replaced by the mark."""
    out, at = [], 0
    for s, e, _, _ in spans:
        if s > at or not out:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


def _scan(least_cost: float, with_text: bool, words: Sequence[str]):
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("cost", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(words)
        for batch in batches:
            spans, hashes, texts = [], [], []
            for text in batch.column(1):
                text = text.as_py()
                found = find_spans(text or "", least_cost, ranks)
                spans.append([{"start": s, "end": e, "kind": KINDS[k], "cost": c} for s, e, k, c in found])
                hashes.append(hashlib.sha256(_joined(f for f in found if f[2] < 3).encode()).hexdigest())
                texts.append(redact(text, found) if with_text and text is not None else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind)), pa.array(hashes, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "spans", "base_sha256", "redacted"])
    return run


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_cost: float = LEAST_COST, with_text: bool = True, words: Sequence[str] | None = None) -> DataFrame:
    """One row per document: doc_id, `spans` (start, end in code points, kind, cost) by start, then kind; base_sha256 of the base spans; and, unless left out, the text
    with all spans replaced by a mark.

    Base spans are assignments, access keys and hexadecimal runs; `guess` spans are values in a credential context whose guess cost is at least 10^`least_cost`. Null
    texts have no spans and stay null; empty texts have none; repeated rows give repeated rows. words: known words, most frequent first; without them those of the table are learned in a first pass. No text is shuffled.
    """
    known = learn_words(docs, text_col) if words is None else list(words)
    return A.texts_only(docs, id_col, text_col).mapInArrow(_scan(least_cost, with_text, known), SCHEMA)


def redact_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", least_cost: float = LEAST_COST, words: Sequence[str] | None = None) -> DataFrame:
    """All rows and columns, the text with its secrets masked and `chars_col`, where it exists, the new length. Null texts stay null. words: see `scan_secrets`."""
    fields, at = docs.schema, docs.columns.index(text_col)
    known = learn_words(docs, text_col) if words is None else list(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(known)
        for batch in batches:
            texts = [t if t is None else redact(t, find_spans(t, least_cost, ranks)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, fields)
    return out.withColumn(chars_col, F.length(A.quoted(text_col)).cast(fields[chars_col].dataType)) if chars_col and chars_col in docs.columns else out


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query."""
    count = "cast(size(filter(spans, s -> s.kind = '{}')) as long) n_{}"
    return found.selectExpr("doc_id", *(count.format(k, k) for k in KINDS), "base_sha256", "concat_ws(',', transform(spans, s -> concat_ws(':', s.kind, s.start, s.end))) spans")
