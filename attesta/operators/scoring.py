"""Question banks, cached scoring and the budget gate. The scorer itself is a plug-in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.functions.ids import request_hash
from attesta.session import cut

EMPTY_PROBS = "map<string,double>"


class BudgetExceeded(RuntimeError):
    """The projected cost would pass the budget."""


def question_bank(items: DataFrame, questions, options: DataFrame | None = None, per_account: str = "site") -> DataFrame:
    """(item columns, question, kind, options): every question of a fixed set for every item.

    The set is a literal array exploded per row, so no cross join is planned. options (account_id, option_id) adds a
    choice over the item's own account: `option_set` names the account whose options count, with `company_wide` as the last one. They are joined when
    the question is scored (`with_options`), once per distinct request, so no list travels with every item.
    """
    rows = F.array(*[F.struct(F.lit(q).alias("question"), F.lit(k).alias("kind"),
                              F.array(*[F.lit(o) for o in opts]).cast("array<string>").alias("options"))
                     for q, k, opts in questions])
    bank = items.select("*", F.inline(rows))
    if options is None:
        return bank
    own = options.select("account_id").distinct()
    more = items.join(own, "account_id", "left_semi").select(
        *items.columns, F.lit(per_account).alias("question"), F.lit("choice").alias("kind"), F.array().cast("array<string>").alias("options"), F.col("account_id").alias("option_set"))
    return bank.withColumn("option_set", F.lit(None).cast("string")).unionByName(more)


def option_table(options: DataFrame) -> DataFrame:
    """(option_set, option): the choices of each account, `company_wide` among them."""
    own = options.select(F.col("account_id").alias("option_set"), F.col("option_id").alias("option"))
    return own.unionByName(own.select("option_set", F.lit("company_wide").alias("option"))).distinct()


def with_options(reqs: DataFrame, options: DataFrame) -> DataFrame:
    """(request_hash, …, option): the requests over an account's options, one row for each option."""
    return reqs.filter(F.col("option_set").isNotNull()).dropDuplicates(["request_hash"]).join(option_table(options), "option_set")


def requests(bank: DataFrame, state) -> DataFrame:
    """Adds request_hash over the item state and the question; equal requests share one answer."""
    parts = [*state, "kind", "options", "question", *(c for c in ("option_set",) if c in bank.columns)]
    return bank.withColumn("request_hash", request_hash(*[F.col(c) for c in sorted(parts)]))


def misses(reqs: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct requests without a cached answer."""
    return reqs.dropDuplicates(["request_hash"]).join(cache.select("request_hash").distinct(), "request_hash", "left_anti")


def budget_gate(reqs: DataFrame, cache: DataFrame, tokens: str, price: float, budget: float, spent: float = 0.0) -> DataFrame:
    """One row (n_requests, n_cached, n_new, mean_tokens, projected, allowed).

    Only distinct uncached requests cost; the mean token count comes from the distinct requests.
    """
    distinct = reqs.dropDuplicates(["request_hash"])
    known = cache.select("request_hash").distinct().withColumn("_hit", F.lit(1))
    d = distinct.join(known, "request_hash", "left")
    out = d.agg(F.count(F.lit(1)).alias("n_requests"), F.count("_hit").alias("n_cached"),
                F.count_if(F.col("_hit").isNull()).alias("n_new"), F.avg(tokens).alias("mean_tokens"))
    cost = F.coalesce(F.col("n_new") * F.col("mean_tokens") * F.lit(price), F.lit(0.0))
    return out.withColumn("projected", cost).withColumn("allowed", (F.lit(spent) + cost) < budget)


def require_budget(gate: DataFrame) -> None:
    """Raise when the one-row projection is over budget."""
    row = gate.first()
    if not row["allowed"]:
        raise BudgetExceeded(f"{row['n_new']} new requests project to {row['projected']:.4f}")


def score(reqs: DataFrame, cache: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(answers for every request, the grown cache). Only misses reach the scorer.

    scorer: (request_hash, …) -> (request_hash, p, choice, confidence, probs, error). Rows with an error are answered
    with it and stay out of the cache, so a rerun tries them again. The fresh answers are checkpointed: both results read
    them, and a scorer is the costly step.
    """
    fresh = cut(scorer(misses(reqs, cache)))
    grown = cache.unionByName(fresh.filter(F.col("error").isNull()).drop("error"))
    known = cache.withColumn("error", F.lit(None).cast("string")).unionByName(fresh)
    return reqs.join(known, "request_hash", "left"), grown


def hash_unit(*parts):
    """A reproducible number in [0, 1] from the md5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 4)
    return F.conv(digits, 16, 10).cast("int") / F.lit(65535.0)


def rule_scorer(text: str, rules: dict[str, str], sure: float = 0.95) -> Callable[[DataFrame], DataFrame]:
    """A deterministic scorer: a yes/no question is sure when its keyword rule hits the text; a choice takes its first
    option whose name occurs in the text, else its last option at low confidence."""
    def run(df: DataFrame) -> DataFrame:
        t = F.lower(F.coalesce(F.col(text), F.lit("")))
        hit = F.lit(False)
        for q, rx in rules.items():
            hit = F.when(F.col("question") == q, t.rlike(rx)).otherwise(hit)
        found = F.get(F.filter("options", lambda o: F.contains(t, F.lower(o))), F.lit(0))
        last = F.try_element_at("options", F.lit(-1))
        noul = F.col("kind") == "noul"
        choice = F.when(~noul, F.coalesce(found, last))
        conf = F.when(~noul, F.when(found.isNotNull(), sure).otherwise(0.5))
        probs = F.when(~noul, F.map_from_arrays(F.array(F.coalesce(choice, F.lit(""))), F.array(F.coalesce(conf, F.lit(0.0)))))
        return df.select("request_hash", F.when(noul, F.when(hit, sure).otherwise(1 - sure)).alias("p"),
                         choice.alias("choice"), conf.alias("confidence"), probs.cast(EMPTY_PROBS).alias("probs"),
                         F.lit(None).cast("string").alias("error"))
    return run
