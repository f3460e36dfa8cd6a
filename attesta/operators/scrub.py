"""Replace known person names in texts, at any roster size."""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.text import collapse
from attesta.session import land

#: Names that are sent to every task at most.
NEAR = 100_000

_GAPS, _PIECES = re.compile(r"[^\S ]|\s{2}"), re.compile(r"\s+|\S+")


def _edges(left, right, whole_word: bool):
    """Join keys of one adjacent token pair: the whole pair, or every 1..3 character edge of it."""
    if whole_word:
        return F.array(F.concat(left, F.lit(" "), right))
    tails = [F.right(left, F.lit(n)) for n in (1, 2, 3)]
    heads = [F.left(right, F.lit(n)) for n in (1, 2, 3)]
    return F.array_distinct(F.array(*[F.concat(t, F.lit(" "), h) for t in tails for h in heads]))


def _words(c):
    return F.filter(F.split(c, r"[^\p{L}\p{N}_]+"), lambda t: t != "")


def _name_key(whole_word: bool):
    tokens = _words("name") if whole_word else F.split("name", " ")
    first, second = F.get(tokens, F.lit(0)), F.get(tokens, F.lit(1))
    if whole_word:
        return F.concat(first, F.lit(" "), second)
    return F.concat(F.right(first, F.lit(3)), F.lit(" "), F.left(second, F.lit(3)))


def _wordlike(c: str) -> bool:
    return c == "_" or c.isalnum() or unicodedata.category(c)[0] == "M"


def mask_names(text: str, names: Sequence[str], whole_word: bool, mask: str) -> str:
    """The text with these names replaced, the longest first, then by name and place; one pass of an automaton finds all of them. A run of white space in the text counts as one space of a name."""
    flat, origin = text, None
    if not names:
        return text
    if _GAPS.search(text):
        kept = [m.span() for m in _PIECES.finditer(text)]
        flat = "".join(" " if text[s].isspace() else text[s:e] for s, e in kept)
        origin = [i for s, e in kept for i in ((s,) if text[s].isspace() else range(s, e))] + [len(text)]
    found = ahocorasick.Automaton()
    for name in names:
        found.add_word(name, name)
    found.make_automaton()
    spans = [(-len(name), name, end + 1 - len(name)) for end, name in found.iter(flat)]
    if whole_word:
        edge = lambda i: (i > 0 and _wordlike(flat[i - 1])) != (i < len(flat) and _wordlike(flat[i]))
        spans = [x for x in spans if edge(x[2]) and edge(x[2] - x[0])]
    starts: list[int] = []
    ends: list[int] = []
    for minus, _, s in sorted(spans):
        k = bisect.bisect_right(starts, s)
        if (not k or ends[k - 1] <= s) and (k == len(starts) or s - minus <= starts[k]):
            starts.insert(k, s)
            ends.insert(k, s - minus)
    out, at = [], 0
    for s, e in zip(starts, ends, strict=True):
        s, e = (s, e) if origin is None else (origin[s], origin[e - 1] + 1)
        out += [text[at:s], mask]
        at = e
    return "".join(out) + text[at:]


def scrub(df: DataFrame, id: str, text: str, names: DataFrame, whole_word: bool = True,
          leak: str | None = None, mask: str = "[person]") -> DataFrame:
    """Adds {text}_scrubbed and changed.

    Names of the roster are replaced longest first, as whole words or anywhere; `leak` words are removed
    before. Candidates come from an equi join on adjacent token pairs, before any shuffle where the roster has NEAR names at most; a larger one is dealt by its first tokens. The names found in a
    text are looked for in one pass over it, however many they are. Runs of white space count as one space, in names and in texts.
    """
    names = names.select(collapse("name").alias("name")).filter("name != ''").distinct()
    base = F.regexp_replace(F.col(text), leak, "") if leak else F.col(text)
    d = df.withColumn("_base", base)
    tokens = _words("_base") if whole_word else F.split("_base", r"\s+")
    # the token array is its own column: inside a lambda an expression would be split again for every position
    near = d.select(id, tokens.alias("_t")).filter(F.size("_t") > 1)
    pairs = F.arrays_zip(F.slice("_t", F.lit(1), F.size("_t") - 1).alias("a"), F.slice("_t", F.lit(2), F.size("_t") - 1).alias("b"))
    keyed = F.flatten(F.transform(pairs, lambda p: _edges(p["a"], p["b"], whole_word)))
    keys = near.select(id, F.explode(F.array_distinct(keyed)).alias("_key"))
    roster = names.select("name", _name_key(whole_word).alias("_key"))
    roster = land(roster)  # a roster that fits goes to the texts, so that pairs that no name has are not shuffled
    listed = keys.join(F.broadcast(roster) if roster.count() <= NEAR else roster, "_key").groupBy(id).agg(F.collect_set("name").alias("_names"))

    @F.pandas_udf("string")
    def masked(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or n is None else mask_names(t, list(n), whole_word, mask) for t, n in zip(texts, lists, strict=True)], dtype=object)
    joined = d.join(listed, id, "left").withColumn("_done", masked("_base", "_names"))
    tidy = F.trim(F.regexp_replace("_done", r"\s{2,}", " "), F.lit(" -—")) if leak else F.col("_done")
    return joined.select(*df.columns, tidy.alias(f"{text}_scrubbed"), (F.col("_done") != F.col(text)).alias("changed"))


def scrub_site(df: DataFrame, id: str, text: str, names: DataFrame) -> DataFrame:
    """N21 for site texts: verdict words that would leak a label go first, then names anywhere."""
    return scrub(df, id, text, names, whole_word=False, leak=cfg.VERDICT_WORDS)
