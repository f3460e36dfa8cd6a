"""Text normalisation: Column -> Column. Built-in expressions except Unicode folding and entity unescaping."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta import config as cfg


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- small per-value helpers used inside Arrow batches
def fold_value(s):
    if s is None or s.isascii():
        return s
    return "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch))


@F.pandas_udf(T.StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(fold_value)


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda v: html.unescape(v) if v is not None and "&" in v else v)


# ---------------------------------------------------------------- columns
def afold(c) -> Column:
    """NFKD, combining marks dropped. Only non-ASCII values travel to Python; the rest go as nulls."""
    c = as_col(c)
    return F.coalesce(_fold(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def unescape(c) -> Column:
    """HTML entities decoded once. Only values with an ampersand travel to Python."""
    c = as_col(c)
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def collapse(c) -> Column:
    """Whitespace runs to one space, ends trimmed. The slower Unicode pattern is for texts beyond ASCII."""
    c = as_col(c)
    ascii_ = F.octet_length(c) == F.char_length(c)
    return F.trim(F.when(ascii_, F.regexp_replace(c, r"\s+", " ")).otherwise(F.regexp_replace(c, r"(?U)\s+", " ")))


def norm(c) -> Column:
    """Collapsed, trimmed, lower case."""
    return F.lower(collapse(c))


def slug_folded(folded) -> Column:
    return F.trim(F.regexp_replace(F.lower(as_col(folded)), "[^a-z0-9]+", "-"), F.lit("-"))


def slug(c) -> Column:
    """Folded, non-alphanumeric runs to one dash, no dash at the ends."""
    return slug_folded(afold(c))


def key_folded(folded) -> Column:
    return F.regexp_replace(F.lower(as_col(folded)), "[^a-z0-9]+", "")


def ckey(c) -> Column:
    """Folded, lower case, alphanumerics only."""
    return key_folded(afold(c))


def team_slug(c) -> Column:
    """Article and parentheticals off, trailing organisation words off twice, `and` as `&`."""
    return slug_of_team(afold(c))


def slug_of_team(folded) -> Column:
    """N8 of a folded text."""
    s = F.regexp_replace(F.lower(folded), r"^\s*(the|our|a)\s+", "")
    s = F.when(F.contains(s, F.lit("(")), F.regexp_replace(s, r"\(.*?\)", " ")).otherwise(s)
    s = F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))
    for _ in range(2):
        s = F.trim(F.regexp_replace(s, cfg.TEAM_TRAILING, ""))
    s = F.regexp_replace(s, r"\band\b", "&")
    return F.trim(F.regexp_replace(s, r"\s+", "-"), F.lit("-"))


def title_key(c) -> Column:
    """Folded, lower case, non-alphanumeric runs to one space."""
    return F.trim(F.regexp_replace(F.lower(afold(c)), "[^a-z0-9]+", " "))


def nname(c) -> Column:
    """A person name as its ASCII letters."""
    return F.regexp_replace(F.lower(as_col(c)), "[^a-z]+", "")


def dkey(title, url) -> Column:
    """The whole title and URL, trimmed, lower case."""
    low = lambda c: F.lower(F.trim(F.coalesce(as_col(c), F.lit(""))))
    return F.concat_ws("|", low(title), low(url))


def titleise(c, acronyms=None) -> Column:
    """A dashed slug as a title; listed acronyms in upper case."""
    known = F.array(*[F.lit(a) for a in (acronyms or cfg.TITLE_ACRONYMS)])
    words = F.filter(F.split(as_col(c), "-"), lambda w: w != "")
    cased = F.transform(words, lambda w: F.when(F.array_contains(known, w), F.upper(w)).otherwise(
        F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))))
    return F.array_join(cased, " ")


def html_to_text(c, blocks: str = cfg.DROP_BLOCKS) -> Column:
    """Non-content blocks dropped, tags to spaces, entities decoded once, whitespace collapsed."""
    bare = F.regexp_replace(F.regexp_replace(as_col(c), blocks, " "), r"(?s)<[^>]+>", " ")
    return collapse(unescape(bare))


def strip_markup(c) -> Column:
    """N16 for feed fields: decode, drop tags, decode again, collapse."""
    return collapse(unescape(F.regexp_replace(unescape(F.coalesce(as_col(c), F.lit(""))), r"<[^>]+>", " ")))


def page_form(c) -> Column:
    """N16 for source checks: curly quotes, dashes and hard spaces unified, collapsed, lower case."""
    return norm(F.translate(as_col(c), "’‘“”–— ", "''\"\"-- "))


def normal_forms(c) -> Column:
    """struct(soft, hard). Soft unifies look-alike punctuation; hard also drops punctuation, case and marks.

    Only values with an ampersand (entities) or beyond ASCII (folding) travel to Python.
    """
    one = {k: v for k, v in cfg.LOOKALIKE.items() if len(v) == 1}
    soft = F.translate(unescape(c), "".join(one), "".join(one.values()))
    for k, v in cfg.LOOKALIKE.items():
        if len(v) != 1:
            soft = F.replace(soft, F.lit(k), F.lit(v))
    soft = collapse(soft)
    hard = F.trim(F.regexp_replace(afold(F.lower(soft)), "[^a-z0-9]+", " "))
    return F.struct(soft.alias("soft"), hard.alias("hard"))


def word_set(c) -> Column:
    """Distinct lower-case words of more than two characters, stop words out."""
    stop = F.array(*[F.lit(w) for w in cfg.STORY_STOPWORDS])
    words = F.regexp_extract_all(F.lower(as_col(c)), F.lit("([a-z0-9$]+)"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 2) & ~F.array_contains(stop, w)))


def head_text(c) -> Column:
    """A named-head cell, placeholders as null."""
    t = F.trim(as_col(c))
    return F.when((t != "") & ~t.rlike(cfg.HEAD_PLACEHOLDER), t)


def owner_of(c) -> Column:
    """A deal-owner cell, literal nulls as null."""
    t = F.trim(as_col(c))
    return F.when(~F.lower(t).isin(cfg.OWNER_NULLS), t)


def split_head(c) -> Column:
    """N20: 'Name - Title' as struct(name, title); listed null words give null."""
    t = F.trim(as_col(c))
    cells = F.split(t, r"\s+[-–—]\s+", 2)
    return F.when((t != "") & ~norm(t).isin(cfg.HEAD_NULLS), F.struct(
        F.trim(cells[0]).alias("name"),
        F.when(F.size(cells) > 1, F.trim(F.get(cells, F.lit(1)))).alias("title")))
