"""Rule classification, admission, priority, and label precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.gates import gate
from attesta.functions.text import as_col, team_slug, title_key
from attesta.operators.parse import first_match


def classify(df: DataFrame, slug: str = "role_slug", families=None, seniority=None, hard: str = cfg.HARD_EXCLUDE,
             soft: str = cfg.SOFT_EXCLUDE) -> DataFrame:
    """Adds job_family, job_family_rule, seniority_rank, seniority_rule, excluded.

    The first matching family wins and its matched text is kept; seniority is an ordered prefix rule, default
    rank 1; a hard exclude is named before a soft one. Empty strings mean no match.
    """
    s = F.concat(F.lit("-"), F.lower(F.coalesce(F.col(slug), F.lit(""))), F.lit("-"))
    d = first_match(df.withColumn("_s", s), "_s", families or cfg.FAMILIES, "job_family", "job_family_rule")
    bare = F.lower(F.coalesce(F.col(slug), F.lit("")))
    rank = F.struct(F.lit(1).alias("rank"), F.lit("default").alias("rule"))
    for r, pattern in reversed(list(seniority or cfg.SENIORITY)):
        rank = F.when(bare.rlike(pattern), F.struct(
            F.lit(r).alias("rank"), F.regexp_extract(bare, pattern, 0).alias("rule"))).otherwise(rank)
    named = lambda kind, p: F.concat(F.lit(kind + ":"), F.regexp_extract("_s", p, 0))
    excluded = F.when(F.col("_s").rlike(hard), named("hard", hard)).when(F.col("_s").rlike(soft), named("soft", soft)).otherwise("")
    return (d.withColumn("_r", rank).withColumn("seniority_rank", F.col("_r.rank"))
            .withColumn("seniority_rule", F.col("_r.rule")).withColumn("excluded", excluded).drop("_s", "_r"))


def admit(slug: str = "role_slug", core=None, bioprocess=None, tool: str = cfg.NAMED_TOOL,
          min_rank: int = cfg.BIOPROCESS_MIN_RANK) -> Column:
    """Worth a body fetch. Fit gates everything and a hard exclude never passes; a core family always does, a
    bioprocess family from `min_rank` or with a named tool; only a core family passes a soft exclude."""
    fam, ex = F.col("job_family"), F.col("excluded")
    is_core = fam.isin(core or cfg.CORE_FAMILIES)
    tooled = F.coalesce(F.col(slug), F.lit("")).rlike(tool)
    able = is_core | (fam.isin(bioprocess or cfg.BIOPROCESS_FAMILIES) & ((F.col("seniority_rank") >= min_rank) | tooled))
    return F.col("icp_fit").isin("yes", "soft") & ~ex.startswith("hard:") & able & (~ex.startswith("soft:") | is_core)


def score(as_of, last_seen: str = "last_seen", seen_count: str = "seen_count", core=None) -> Column:
    """3 x rank, plus 4 core / 1 other, 3 fit yes / 1 other, 2 seen within a year, up to 3 for repeats."""
    recent = F.datediff(as_col(as_of).cast("date"), F.col(last_seen)) <= cfg.RECENT_DAYS
    repeats = F.least(F.greatest(F.coalesce(F.col(seen_count), F.lit(1)).cast("int") - 1, F.lit(0)), F.lit(3))
    return (3 * F.col("seniority_rank") + F.when(F.col("job_family").isin(core or cfg.CORE_FAMILIES), 4).otherwise(1)
            + F.when(F.col("icp_fit") == "yes", 3).otherwise(1) + F.when(recent, 2).otherwise(0) + repeats).cast("int")


def resolve_label(df: DataFrame, labels: DataFrame, title: str = "role_title") -> DataFrame:
    """C11: adds family, is_digital, is_bioprocess, label_source.

    A rule label wins; then `excluded`; then a title without a label is `not_labeled`; else the gated model label.
    labels: (title_key, job_family_gated, digital_data_it_gated, bioprocess_core_gated).
    """
    lab = labels.select(F.col("title_key").alias("_tk"), F.col("job_family_gated").alias("_f"),
                        F.col("digital_data_it_gated").alias("_d"), F.col("bioprocess_core_gated").alias("_b"))
    d = df.withColumn("_k", title_key(title)).join(lab, F.col("_k") == F.col("_tk"), "left")
    fam = F.coalesce(F.col("job_family"), F.lit(""))
    ruled, out = fam != "", F.coalesce(F.col("excluded"), F.lit("")) != ""
    model = ~ruled & ~out & F.col("_tk").isNotNull()
    family = F.when(ruled, fam).when(out, "excluded").when(model, F.col("_f")).otherwise("not_labeled")
    digital = F.when(ruled, fam.isin(cfg.CORE_FAMILIES)).when(model, F.col("_d") == "yes").otherwise(False)
    bio = F.when(ruled, fam.isin(cfg.BIOPROCESS_CORE)).when(model, F.col("_b") == "yes").otherwise(False)
    source = F.when(ruled, "rule").when(model, "model").otherwise("")
    return d.select(*df.columns, family.alias("family"), digital.alias("is_digital"), bio.alias("is_bioprocess"),
                    source.alias("label_source"))


def title_scope(groups: DataFrame, answers: DataFrame) -> DataFrame:
    """The scope gates per title and the veto: a rule-digital title the model reads as decisively not digital.

    groups: (title_key, digital_source); answers: (title_key, global_scope_p, site_scope_p, digital_data_it_p).
    """
    d = groups.join(answers, "title_key")
    for q in ("global_scope", "site_scope", "digital_data_it"):
        d = d.withColumn(f"{q}_gated", gate(f"{q}_p"))
    return d.withColumn("veto", (F.col("digital_source") == "rule") & (F.col("digital_data_it_gated") == "no"))


def veto(df: DataFrame, scope: DataFrame, title: str = "role_title") -> DataFrame:
    """Rows whose title is not vetoed."""
    out = scope.filter("veto").select(F.col("title_key").alias("_tk"))
    return df.withColumn("_k", title_key(title)).join(out, F.col("_k") == F.col("_tk"), "left_anti").drop("_k")


def _root(domain) -> Column:
    """The label before the public suffix; two-part suffixes such as co.jp count as one."""
    d = F.lower(as_col(domain))
    labels = F.split(d, r"\.")
    two = d.rlike(r"\.(co|com|org|net|ac|gov)\.[a-z]{2}$")
    pick = F.when(two, F.get(labels, F.size(labels) - 3)).otherwise(F.get(labels, F.size(labels) - 2))
    return F.when(F.size(labels) > 1, F.coalesce(pick, labels[0])).otherwise(d)


def email_status(df: DataFrame, domains: DataFrame, email: str = "email", status: str = "email_status") -> DataFrame:
    """Adds email_checked. Initials or a two-character local part is `suspect`; a domain whose root neither holds
    nor is held by one of the account's domain roots is `suspect_domain`; anything not `found` keeps its status.

    domains: (account_id, domain).
    """
    em = F.trim(F.col(email))
    local = F.split_part(em, F.lit("@"), F.lit(1))
    roots = domains.select("account_id", _root("domain").alias("_r")).filter("_r != ''").distinct()
    # asked once per distinct (account, root of an address), against the account's own domains one by one
    asked = df.select("account_id", _root(F.split_part(em, F.lit("@"), F.lit(2))).alias("_er")).filter("_er != ''").distinct()
    near = asked.join(roots, "account_id").filter(F.contains("_er", F.col("_r")) | F.contains("_r", F.col("_er")))
    near = near.select("account_id", "_er").distinct().withColumn("_known", F.lit(True))
    d = df.withColumn("_er", _root(F.split_part(em, F.lit("@"), F.lit(2)))).join(near, ["account_id", "_er"], "left")
    known = F.coalesce("_known", F.lit(False))
    start = F.coalesce(F.col(status), F.lit("found"))
    weak = local.rlike(r"(?i)^[a-z](\.[a-z])?$") | (F.length(local) <= 2)
    checked = (F.when(F.coalesce(em, F.lit("")) == "", F.col(status)).when(weak, "suspect")
               .when((start == "found") & F.contains(em, F.lit("@")) & ~known, "suspect_domain").otherwise(start))
    return d.select(*df.columns, checked.alias("email_checked"))


def drop_boilerplate(df: DataFrame, companies: DataFrame, parent: str = "parent_org") -> DataFrame:
    """Rows whose parent is a real unit: not too short, not generic, not a company (bare or with group, plc, inc)."""
    base = companies.select(team_slug("company").alias("_c")).filter(F.col("_c") != "").distinct()
    forms = base.select(F.explode(F.array(*[F.concat("_c", F.lit(x)) for x in ("", "-group", "-plc", "-inc")])).alias("_p")).distinct()
    d = df.withColumn("_p", team_slug(parent))
    return d.filter((F.length("_p") >= 3) & ~F.col("_p").isin(cfg.GENERIC_PARENTS)).join(forms, "_p", "left_anti").drop("_p")
