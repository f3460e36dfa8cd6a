"""Guards, agreement tables and reconciliation. Agreement, never accuracy: both sides are readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.gates import gate_choice
from attesta.operators.claims import GateFailed
from attesta.operators.grams import containments
from attesta.operators.parse import span_overlap
from attesta.operators.skew import first_per_group
from attesta.session import land


def fk_violations(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """V5: child rows whose non-null key is missing from the parent; must be empty."""
    p = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(p, key, "left_anti")


def guard_shrink(old: DataFrame, new: DataFrame, tol: float = cfg.SHRINK_TOLERANCE) -> None:
    """V6: raise when an accreting table would lose more than `tol` of its rows."""
    before, after = old.count(), new.count()
    if before and after < before * (1 - tol):
        raise GateFailed(f"refusing to shrink {before} rows to {after}")


def unflagged_notes(rollup: DataFrame) -> DataFrame:
    """V8: flagged rollup rows without a note; must be empty."""
    return rollup.filter((F.col("bias_flag") != "") & (F.coalesce("bias_note", F.lit("")) == ""))


def _hit_shape(hits: DataFrame, id: str, lineage: str) -> DataFrame:
    return hits.groupBy(id, "label").agg(F.min(F.col("negated").cast("int")).alias("_neg"),
                                         F.min((F.col("field") == lineage).cast("int")).alias("_lin"))


def agreement_table(labels: DataFrame, hits: DataFrame, id: str = "site_id", lineage: str = "acquired_lineage") -> DataFrame:
    """Per label the decided, yes, unsure and keyword-hit rows, how often a decided answer equals keyword presence, and
    both disagreement directions; a no against a keyword is split into negated, lineage-only and other mentions.

    labels: (id, label, state yes|no|unsure); hits: output of `kw_hits`.
    """
    d = labels.join(_hit_shape(hits, id, lineage), [id, "label"], "left")
    has, decided, yes = F.col("_neg").isNotNull(), F.col("state") != "unsure", F.col("state") == "yes"
    against = decided & ~yes & has
    neg, lin = F.col("_neg") == 1, F.col("_lin") == 1
    out = d.groupBy("label").agg(
        F.count_if(decided).alias("decided"), F.count_if(yes).alias("n_yes"), F.count_if(~decided).alias("unsure"),
        F.count_if(has).alias("kw_hit"), F.count_if(decided & (yes == has)).alias("agree"),
        F.count_if(yes & ~has).alias("yes_kw_absent"), F.count_if(against).alias("no_kw_present"),
        F.count_if(against & neg).alias("negated"), F.count_if(against & ~neg & lin).alias("lineage_only"),
        F.count_if(against & ~neg & ~lin).alias("other"))
    return out.withColumn("agree_pct", F.col("agree") / F.greatest(F.col("decided"), F.lit(1)))


def disagreements(labels: DataFrame, hits: DataFrame, id: str = "site_id", lineage: str = "acquired_lineage") -> DataFrame:
    """One row per disagreeing (id, label) with its bucket and the first plain mention, else the first mention."""
    first = first_per_group(hits, [id, "label"], [F.col("negated").asc(), F.col("field").asc(), F.col("pos").asc()])
    d = (labels.filter(F.col("state") != "unsure").join(_hit_shape(hits, id, lineage), [id, "label"], "left")
         .join(first.select(id, "label", "field", "keyword"), [id, "label"], "left"))
    has, yes = F.col("_neg").isNotNull(), F.col("state") == "yes"
    bucket = (F.when(yes, "synonym_or_inference").when(F.col("_neg") == 1, "negated_mention")
              .when(F.col("_lin") == 1, "lineage_only").otherwise("other"))
    return d.filter(yes != has).select(
        id, "label", F.when(yes, "yes_kw_absent").otherwise("no_kw_present").alias("direction"), bucket.alias("bucket"),
        F.coalesce("field", F.lit("")).alias("field"), F.coalesce("keyword", F.lit("")).alias("keyword"))


def confusion(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """(gold, pred, n)."""
    return df.groupBy(F.col(gold).alias("gold"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, gold: str, pred: str, labels) -> DataFrame:
    """V11 as one row per gold label and one column per listed prediction."""
    return df.groupBy(F.col(gold).alias("gold")).pivot(pred, list(labels)).count().na.fill(0)


def slice_agreement(df: DataFrame, decided, agree, slices: dict) -> DataFrame:
    """(slice, n, decided, agree): agreement of the decided rows within named, possibly overlapping slices."""
    rows = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in slices.items()]))
    d = df.select(decided.alias("_d"), agree.alias("_a"), F.explode(rows).alias("slice"))
    return d.groupBy("slice").agg(F.count(F.lit(1)).alias("n"), F.count_if("_d").alias("decided"),
                                  F.count_if(F.col("_d") & F.col("_a")).alias("agree"))


def label_agreement(df: DataFrame, gold: str, pred: str = "job_family", conf: str = "job_family_conf") -> DataFrame:
    """Per rule label and over all (ALL): rows, top choices that agree, decided rows, decided rows that agree."""
    shown = gate_choice(pred, conf)
    d = df.select(F.col(gold).alias("_g"), (F.col(pred) == F.col(gold)).alias("_top"), (shown != "unsure").alias("_dec"),
                  (shown == F.col(gold)).alias("_ok"))
    # ROLLUP gives the ALL row in the same pass
    out = d.rollup("_g").agg(F.grouping("_g").alias("_all"), F.count(F.lit(1)).alias("n"), F.count_if("_top").alias("top_agree"),
                             F.count_if("_dec").alias("decided"), F.count_if(F.col("_dec") & F.col("_ok")).alias("agree"))
    return out.select(F.when(F.col("_all") == 1, "ALL").otherwise(F.col("_g")).alias("label"), "n", "top_agree", "decided", "agree")


def noul_agreement(df: DataFrame, gold: str, pred: str, yes_labels) -> DataFrame:
    """Decided yes/no answers against membership of the rule label in a set."""
    dec = F.col(pred) != "unsure"
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(dec).alias("decided"),
                  F.count_if(dec & ((F.col(pred) == "yes") == F.col(gold).isin(list(yes_labels)))).alias("agree"))


def seniority_gold(rule) -> object:
    """The band a prefix rule implies; `lead` and the default imply none."""
    bands = F.create_map(*[F.lit(x) for kv in cfg.SENIORITY_BAND.items() for x in kv])
    return F.try_element_at(bands, F.col(rule) if isinstance(rule, str) else rule)


def publication_agreement(df: DataFrame, title: str = "title") -> DataFrame:
    """(measure, n, agree): keep against high and low source confidence; the process band and the process-data answer
    against keywords of the title, decided rows only."""
    hi_lo = F.col("source_confidence").isin("high", "low")
    band = F.col("relevance_band") != "unsure"
    data = F.col("process_data") != "unsure"
    kw = F.col(title).rlike(cfg.KEYWORD_PROCESS)
    measure = lambda name, on, ok: F.struct(F.lit(name).alias("measure"), on.alias("on"), ok.alias("ok"))
    rows = F.array(measure("keep_vs_source_confidence", hi_lo, F.col("keep") == (F.col("source_confidence") == "high")),
                   measure("process_band_vs_keyword", band, (F.col("relevance_band") == "process") == kw),
                   measure("process_data_vs_keyword", data, (F.col("process_data") == "yes") == kw))
    return df.select(F.inline(rows)).groupBy("measure").agg(F.count_if("on").alias("n"), F.count_if(F.col("on") & F.col("ok")).alias("agree"))


def reconcile(a: DataFrame, b: DataFrame, key, cols) -> DataFrame:
    """Per key whether two layers agree on the listed columns; side both, left or right."""
    key = [key] if isinstance(key, str) else list(key)
    l = a.select(*key, *[F.col(c).alias(f"{c}_a") for c in cols], F.lit(True).alias("_l"))
    r = b.select(*key, *[F.col(c).alias(f"{c}_b") for c in cols], F.lit(True).alias("_r"))
    d = l.join(r, key, "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in cols])
    side = F.when(F.col("_l").isNull(), "right").when(F.col("_r").isNull(), "left").otherwise("both")
    return d.withColumn("side", side).withColumn("equal", same & (F.col("side") == "both")).drop("_l", "_r")


def recall_containment(gold: DataFrame, pred: DataFrame, group: str, term: str) -> DataFrame:
    """Adds found to each distinct gold term: an equal, containing or contained predicted term in the same group. Terms meet by runs of characters that they share (`grams.containments`)."""
    each = lambda d, said: d.select(group, F.lower(F.trim(term)).alias(term), F.lit(said).alias("_said")).filter(F.col(term) != "")
    terms = land(each(gold, False).unionByName(each(pred, True)).groupBy(group, term).agg(F.bool_or("_said").alias("_said"), F.bool_or(~F.col("_said")).alias("_asked")))
    pairs = containments(terms, [group], term)
    near = pairs.select(group, F.col("_inner").alias(term), F.col("_outer").alias("_p")).unionByName(pairs.select(group, F.col("_outer").alias(term), F.col("_inner").alias("_p")))
    said = terms.filter("_said").select(group, F.col(term).alias("_p"))
    hit = near.join(said, [group, "_p"], "left_semi").select(group, term).distinct().withColumn("_near", F.lit(True))
    same = F.col("_said") & F.col(group).isNotNull()
    return terms.filter("_asked").join(hit, [group, term], "left").select(group, term, (same | F.coalesce("_near", F.lit(False))).alias("found"))


def segment_coverage(segs: DataFrame, quotes: DataFrame, id: str, quote: str) -> DataFrame:
    """One row: quotes scored, inside one segment, at least 60% in one segment, and percentiles of segment words."""
    best = span_overlap(segs, quotes, id, quote)
    cover = best.agg(F.count(F.lit(1)).alias("n_quotes"), F.count_if(F.col("share") >= 0.999).alias("n_inside"),
                     F.count_if(F.col("share") >= 0.6).alias("n_most"))
    words = segs.select(F.size(F.split(F.trim("text"), r"\s+")).alias("w")).agg(
        F.percentile("w", F.lit(0.5)).alias("words_median"), F.percentile("w", F.lit(0.95)).alias("words_p95"), F.max("w").alias("words_max"))
    rows = cover.unionByName(words, allowMissingColumns=True)  # two rows, each with nulls for what the other has
    return rows.agg(*(F.max(c).alias(c) for c in rows.columns))


def field_agreement(df: DataFrame, pairs, conf: str | None = None, sure: float = 0.9) -> DataFrame:
    """(field, n, agree, n_sure, agree_sure) for pairs of columns that read the same field; empty equals null."""
    same = lambda a, b: F.coalesce(F.col(a).cast("string"), F.lit("")) == F.coalesce(F.col(b).cast("string"), F.lit(""))
    rows = F.array(*[F.struct(F.lit(name).alias("field"), same(a, b).alias("ok")) for name, a, b in pairs])
    certain = (F.col(conf) >= sure) if conf else F.lit(True)
    d = df.select(certain.alias("_s"), F.inline(rows))
    return d.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("agree"), F.count_if("_s").alias("n_sure"),
                                  F.count_if(F.col("_s") & F.col("ok")).alias("agree_sure"))
