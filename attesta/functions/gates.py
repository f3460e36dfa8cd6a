"""Probability gates and small decision expressions: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.text import as_col, norm


def gate(p, yes: float = cfg.GATE_YES, no: float = cfg.GATE_NO) -> Column:
    """Yes at or above `yes`, no at or below `no`, else unsure."""
    p = as_col(p)
    return F.when(p >= yes, "yes").when(p <= no, "no").otherwise("unsure")


def gate_choice(choice, confidence, sure: float = cfg.CHOICE_SURE) -> Column:
    """A choice counts only at a sure confidence."""
    return F.when(as_col(confidence) >= sure, as_col(choice)).otherwise("unsure")


def top_option(probs) -> Column:
    """The most probable option of a map; equal probabilities take the lowest option name."""
    entries = F.map_entries(as_col(probs))
    best = F.array_max(F.transform(entries, lambda e: e["value"]))
    return F.array_min(F.transform(F.filter(entries, lambda e: e["value"] == best), lambda e: e["key"]))


def band(probs, confidence, levels=None, sure: float = cfg.CHOICE_SURE) -> Column:
    """The most probable level name, unsure below a sure confidence."""
    names = F.array(*[F.lit(x) for x in (levels or cfg.RELEVANCE_BANDS)])
    return F.when(as_col(confidence) >= sure, F.get(names, top_option(probs).cast("int"))).otherwise("unsure")


def fit_from_verdict(c) -> Column:
    """C4: keep -> yes, drop -> no, flag or gap -> soft, else unknown."""
    t = F.coalesce(norm(c), F.lit(""))
    return (F.when(t.startswith("keep"), "yes").when(t.startswith("drop"), "no")
            .when(t.startswith("flag") | t.startswith("gap"), "soft").otherwise("unknown"))


def keyword_label(c, small: str = cfg.KEYWORD_SMALL, biologic: str = cfg.KEYWORD_BIOLOGIC) -> Column:
    """Which of two keyword sets a text hits."""
    t = F.coalesce(as_col(c), F.lit(""))
    s, b = t.rlike(small), t.rlike(biologic)
    return (F.when(s & b, "mixed").when(s, "small_molecule_only").when(b, "biologic_only").otherwise("not_stated"))


def same_verdict(a, b) -> Column:
    """Equal, or both in the family of verdicts that all mean 'out'."""
    a, b = as_col(a), as_col(b)
    return F.coalesce((a == b) | (a.isin(cfg.OUT_FAMILY) & b.isin(cfg.OUT_FAMILY)), F.lit(False))


def confidence(n, tier3, quotes) -> Column:
    """struct(level, basis) derived from evidence volume, never asserted."""
    n, tier3, quotes = as_col(n), as_col(tier3), as_col(quotes)
    level = (F.when((n >= 3) | ((n >= 2) & (tier3 >= 2)), "high")
             .when((n >= 2) | (tier3 >= 1), "medium").otherwise("low"))
    plural = lambda k, one, many: F.when(k == 1, one).otherwise(many)
    basis = F.concat(n.cast("string"), plural(n, " posting, ", " postings, "), quotes.cast("string"),
                     plural(quotes, " verified quote", " verified quotes"))
    return F.struct(level.alias("level"), basis.alias("basis"))


def tier_rank(c) -> Column:
    """Position of an extraction tier; an unknown tier ranks below all."""
    tiers = F.array(*[F.lit(t) for t in cfg.TIERS])
    return (F.coalesce(F.array_position(tiers, as_col(c)), F.lit(0)) - 1).cast("int")


def confidence_rank(c) -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in cfg.CONFIDENCE_RANK.items() for x in kv])
    return F.coalesce(F.try_element_at(ranks, as_col(c)), F.lit(0))


def pipeline_group(c) -> Column:
    """struct(rank, name) of the pipeline group; an unknown status joins the middle group."""
    status = F.coalesce(as_col(c), F.lit(""))
    rank = F.lit(1)
    for i, (_, members) in reversed(list(enumerate(cfg.PIPELINE_GROUPS))):
        rank = F.when(status.isin(members), i).otherwise(rank)
    names = F.array(*[F.lit(name) for name, _ in cfg.PIPELINE_GROUPS])
    return F.struct(rank.alias("rank"), F.get(names, rank).alias("name"))


def pipeline_priority(c) -> Column:
    """1 live, 2 no deal or unknown, 3 lost."""
    table = F.create_map(*[F.lit(x) for kv in cfg.PIPELINE_PRIORITY.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.coalesce(as_col(c), F.lit(""))), F.lit(2))
