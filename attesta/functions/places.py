"""Place keys: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.text import afold, as_col, key_folded


def _literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _keys(parts: Column) -> Column:
    """Comparison keys of a part list; two-letter codes and bare state or country names are not places."""
    stop = _literals(cfg.GEO_STOP)
    keys = F.transform(parts, key_folded)
    return F.array_distinct(F.filter(keys, lambda k: (F.length(k) > 2) & ~F.array_contains(stop, k)))


def city_keys(c) -> Column:
    """struct(primary, alias). The part before the first comma is the city; parentheticals are aliases."""
    raw = F.coalesce(afold(c), F.lit(""))
    inner = F.regexp_extract_all(raw, F.lit(r"\(([^)]*)\)"), F.lit(1))
    head = F.split_part(F.regexp_replace(raw, r"\([^)]*\)", " "), F.lit(","), F.lit(1))
    primary = _keys(F.split(head, r"[/&]|\bor\b"))
    alias = _keys(F.flatten(F.transform(inner, lambda p: F.split(p, "[,/&]"))))
    return F.struct(primary.alias("primary"), F.array_except(alias, primary).alias("alias"))


def metro_keys(c) -> Column:
    """Keys of the coarser metro cell."""
    raw = F.coalesce(afold(F.regexp_replace(as_col(c), r"\([^)]*\)", " ")), F.lit(""))
    return _keys(F.split(raw, "[,/&]"))


def slug_to_key(c) -> Column:
    """A URL city segment as a key; trailing state and country tokens fall off unless nothing would be left."""
    src = F.coalesce(as_col(c), F.lit(""))
    raw = afold(F.coalesce(F.try_url_decode(F.regexp_replace(src, r"\+", "%2B")), src))
    stop = _literals(cfg.GEO_STOP)
    tokens = F.filter(F.split(raw, r"[-_\s,]+"), lambda t: t != "")
    last = F.array_max(F.transform(tokens, lambda t, i: F.when(
        (F.length(t) > 2) & ~F.array_contains(stop, F.lower(t)), i + 1)))
    return F.when(last.isNull(), key_folded(raw)).otherwise(
        key_folded(F.array_join(F.slice(tokens, F.lit(1), last), "")))


def city_of(c) -> Column:
    """The first of a `;` list; 'N Locations' names no city."""
    t = F.trim(as_col(c))
    return F.when((t == "") | t.rlike(cfg.MULTI_LOCATION), F.lit(None)).otherwise(
        F.trim(F.split_part(t, F.lit(";"), F.lit(1))))


def city_place(c) -> Column:
    """A posting location as a city name, 'remote', or null when it names no city."""
    s = F.trim(F.lower(F.regexp_replace(afold(c), r"\([^)]*\)", " ")))
    part = F.when(F.contains(s, F.lit(" - ")), F.element_at(F.split(s, " - "), -1)).otherwise(
        F.split_part(s, F.lit(","), F.lit(1)))
    city = F.regexp_replace(F.regexp_replace(part, "[-_]+", " "), "[^a-z0-9 ]+", "")
    city = F.trim(F.regexp_replace(city, r"\s+", " "))
    spelling = F.create_map(*[F.lit(x) for kv in cfg.CITY_SPELLING.items() for x in kv])
    country = F.replace(city, F.lit(" "), F.lit("")).isin(cfg.GEO_STOP + cfg.MORE_COUNTRIES)
    return (F.when(F.trim(s, F.lit(" -")) == "", F.lit(None))
            .when(s.rlike(cfg.REMOTE), F.lit("remote"))
            .when(country | (city == ""), F.lit(None))
            .otherwise(F.coalesce(F.try_element_at(spelling, city), city)))


def city_proper(c) -> Column:
    """The city to search for; 'n/a', 'various' and the like give null."""
    t = F.split_part(F.coalesce(as_col(c), F.lit("")), F.lit(","), F.lit(1))
    t = F.trim(F.split_part(F.regexp_replace(t, r"\([^)]*\)", ""), F.lit("/"), F.lit(1)))
    nothing = ["n/a", "na", "tbd", "unknown"]
    low, whole = F.lower(t), F.lower(F.trim(as_col(c)))
    empty = (t == "") | low.isin(nothing) | F.coalesce(whole.isin(nothing), F.lit(False)) | low.startswith("various")
    return F.when(~empty, t)
