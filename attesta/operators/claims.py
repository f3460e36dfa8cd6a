"""The verbatim gate: a claim survives only if its quote is in the source body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions.text import normal_forms, page_form, team_slug, unescape
from attesta.operators.grams import CHARS, runs
from attesta.operators.rules import drop_boilerplate
from attesta.session import cut


class GateFailed(RuntimeError):
    """A guard refused the data."""


def verify_quotes(quotes: DataFrame, bodies: DataFrame, elided: bool = True, on: str = "posting_id",
                  quote: str = "quote_text", body: str = "text") -> DataFrame:
    """V1: adds verbatim_verified, match_method, has_body.

    In order: empty, too_short (<12), exact, soft (look-alike punctuation unified), hard (also case, marks and punctuation
    dropped), elided (every fragment between ellipses longer than 18 characters occurs), not_found. Nothing fuzzy.

    The join is on the posting. Normal forms need Python, so they are built only for bodies that still have an
    unresolved quote after the exact pass. `elided` works on the soft text, where the ellipsis still exists; False
    leaves that step out.
    """
    q = F.trim(F.col(quote))
    b = bodies.select(F.col(on).alias("_id"), F.col(body).alias("_body"))
    d = quotes.withColumn("_q", F.coalesce(q, F.lit(""))).join(b, F.col(on) == F.col("_id"), "left")
    has = F.coalesce(F.length("_body") > 0, F.lit(False))
    first = (F.when((F.col("_q") == "") | ~has, "empty").when(F.length("_q") < cfg.MIN_QUOTE, "too_short")
             .when(F.contains(F.col("_body"), F.col("_q")), "exact"))
    step = d.withColumn("has_body", has).withColumn("match_method", first).drop("_body", "_id")
    open_ = step.filter(F.col("match_method").isNull()).drop("match_method")
    need = open_.select(F.col(on).alias("_id")).distinct()
    forms = b.join(need, "_id", "left_semi").select("_id", normal_forms("_body").alias("_b"))
    o = open_.withColumn("_n", normal_forms("_q")).join(forms, F.col(on) == F.col("_id"))
    within = lambda f: (F.col(f"_n.{f}") != "") & F.contains(F.col(f"_b.{f}"), F.col(f"_n.{f}"))
    method = F.when(within("soft"), "soft").when(within("hard"), "hard")
    if elided:
        plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9 ]+", " "), r"\s+", " "))
        pieces = F.filter(F.transform(F.split("_n.soft", r"\s*\.\.\.\s*"), plain), lambda f: F.length(f) > cfg.MIN_FRAGMENT)
        method = method.when((F.size(pieces) > 1) & F.forall(pieces, lambda f: F.contains(F.col("_b.hard"), f)), "elided")
    late = o.withColumn("match_method", method.otherwise("not_found"))
    cols = [*quotes.columns, "match_method", "has_body"]
    done = step.filter(F.col("match_method").isNotNull()).select(*cols).unionByName(late.select(*cols))
    return done.withColumn("verbatim_verified", F.col("match_method").isin("exact", "soft", "hard", "elided"))


def quarantine(verified: DataFrame) -> DataFrame:
    """Claims whose quote failed, with the reason."""
    reason = F.when(~F.col("has_body"), "no cached body to check against").otherwise(F.col("match_method"))
    return verified.filter(~F.col("verbatim_verified")).withColumn("reason", reason)


#: Quotes are looked for by runs of WORDS neighbouring words, shorter ones by runs of CHARS characters, and those with fewer characters as they are.
WORDS = 3
#: Of the anchors that most bodies hold, so many are dealt over several keys, one for each SALT_ROWS bodies.
HOT, SALT_ROWS = 10_000, 100_000


def _grams(df: DataFrame, id: str, text: str, kinds, inner: bool) -> DataFrame:
    """(id, _kind, _k): the runs of each kind that a text has: kind 0 of words, kind n of n characters. inner: words whose ends are inside the text only."""
    out = None
    for kind in kinds:
        # arrays of words or characters are columns of their own: inside a lambda an expression would be split again for every position
        parts = F.split(text, r"\s+") if kind == 0 else F.split(text, "")
        if inner and kind == 0:
            parts = F.when(F.size(parts) > 2, F.slice(parts, F.lit(2), F.size(parts) - 2)).otherwise(F.array().cast("array<string>"))
        part = runs(df.select(id, parts.alias("_w")), id, "_w", kind or WORDS).select(id, F.lit(kind).alias("_kind"), "_k")
        out = part if out is None else out.unionByName(part)
    return out


def find_quotes(quotes: DataFrame, bodies: DataFrame, quote_id: str, body_id: str, quote: str = "text",
                body: str = "text", broadcast_rows: int = 100_000, salt_rows: int = SALT_ROWS) -> DataFrame:
    """V1 over a whole corpus: (quote_id, body_id) wherever the quote, of any length but not empty, is an exact substring of a body.

    Every complete inner word run of a quote is a run of the body, every run of its characters too. Each quote is looked for by its anchor: the one of its runs that fewest bodies have, counted over all
    bodies for runs of quotes alone; a quote with a run that no body has is done. Only bodies with the anchor are read for the exact check. Up to `broadcast_rows` wanted runs go to the scan itself,
    so a run that no quote asks for never leaves its task; more are joined by a shuffle, in which an anchor of many bodies is dealt over several keys. No quote reaches the driver, only how many there are of each kind.
    """
    q = quotes.select(F.col(quote_id).alias("_qid"), F.col(quote).alias("_q")).filter(F.length("_q") > 0)
    b = bodies.select(F.col(body_id).alias("_bid"), F.col(body).alias("_b"))
    kind = F.when(F.size(F.split("_q", r"\s+")) >= WORDS + 2, 0).otherwise(F.least(F.length("_q"), F.lit(CHARS)))
    q = cut(q.withColumn("_of", kind))
    kinds = [r[0] for r in q.select("_of").distinct().orderBy("_of").collect()]
    if not kinds:
        return q.join(b, F.lit(False)).select(F.col("_qid").alias(quote_id), F.col("_bid").alias(body_id))
    asked = cut(_grams(q, "_qid", "_q", kinds, True).join(q.select("_qid", "_of"), "_qid").filter("_kind = _of").select("_qid", "_kind", "_k"))
    near = lambda d, n: F.broadcast(d) if n <= broadcast_rows else d
    wanted = cut(asked.select("_kind", "_k").distinct())
    seen = _grams(b, "_bid", "_b", kinds, False)
    spread = cut(seen.join(near(wanted, wanted.count()), ["_kind", "_k"]).groupBy("_kind", "_k").agg(F.count(F.lit(1)).alias("_n")))
    rarest = asked.join(spread, ["_kind", "_k"], "left").groupBy("_qid").agg(F.min_by(F.struct("_kind", "_k", "_n"), F.struct(F.coalesce("_n", F.lit(0)), "_k")).alias("_a"))
    probe = cut(rarest.filter("_a._n is not null").select("_qid", "_a.*"))
    n = probe.count()
    if n <= broadcast_rows:
        pairs = seen.join(F.broadcast(probe.drop("_n")), ["_kind", "_k"])
    else:
        hot = probe.filter(F.col("_n") > salt_rows).select("_kind", "_k", F.ceil(F.col("_n") / salt_rows).cast("int").alias("_salts")).distinct().orderBy(F.desc("_salts"), "_k").limit(HOT)
        salts = F.coalesce("_salts", F.lit(1))
        held = seen.join(probe.select("_kind", "_k").distinct(), ["_kind", "_k"], "left_semi").join(F.broadcast(hot), ["_kind", "_k"], "left").withColumn("_salt", F.pmod(F.xxhash64("_bid"), salts).cast("int"))
        each = probe.join(F.broadcast(hot), ["_kind", "_k"], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        pairs = held.drop("_salts").join(each.drop("_salts", "_n"), ["_kind", "_k", "_salt"])
    found = pairs.select("_qid", "_bid").join(q.select("_qid", "_q"), "_qid").join(b, "_bid").filter(F.contains(F.col("_b"), F.col("_q")))
    return found.select(F.col("_qid").alias(quote_id), F.col("_bid").alias(body_id))


def require_pass_rate(verified: DataFrame, pct: float = cfg.PASS_RATE) -> None:
    """V2: raise unless at least `pct` percent of the quotes verified; no quotes at all fails too."""
    row = verified.agg(F.count(F.lit(1)).alias("n"), F.count_if("verbatim_verified").alias("ok")).first()
    if row["n"] == 0:
        raise GateFailed("no quotes to verify")
    if 100.0 * row["ok"] / row["n"] < pct:
        raise GateFailed(f"{row['ok']} of {row['n']} quotes verified, below {pct}%")


def verify_excerpts(excerpts: DataFrame, pages: DataFrame, on: str = "url", excerpt: str = "excerpt", page: str = "page_text") -> DataFrame:
    """V3: adds excerpt_ok: the whole normalised text of a web excerpt occurs in the page."""
    p = pages.select(F.col(on).alias("_u"), page_form(page).alias("_p"))
    d = excerpts.join(p, F.col(on) == F.col("_u"), "left")
    ok = F.contains(F.col("_p"), page_form(excerpt))
    return d.withColumn("excerpt_ok", F.coalesce(ok, F.lit(False))).drop("_u", "_p")


def _low(c) -> Column:
    return F.lower(F.trim(unescape(c)))


def _backs(slug, low, quote_slug, quote_low) -> Column:
    """Whether a quote has the subject slug of a claim, or names its subject (three or more characters)."""
    return (slug == quote_slug) | ((F.length(low) >= 3) & F.contains(quote_low, low))


def backed(claims: DataFrame, quotes: DataFrame) -> DataFrame:
    """The claims backed by a verified quote of the same posting and type: same subject slug, or a quote naming the
    subject (three or more characters).

    claims: (posting_id, claim_type, subject, …). An equi join on (posting, type) with the rest as residual.
    """
    c = claims.withColumn("_slug", team_slug("subject")).withColumn("_low", F.coalesce(_low("subject"), F.lit(""))).alias("c")
    v = quotes.filter("verbatim_verified").select("posting_id", "claim_type", team_slug("subject").alias("_qslug"), _low("quote_text").alias("_qlow")).alias("v")
    same = _backs(F.col("c._slug"), F.col("c._low"), F.col("v._qslug"), F.col("v._qlow"))
    on = (F.col("c.posting_id") == F.col("v.posting_id")) & (F.col("c.claim_type") == F.col("v.claim_type")) & same
    return c.join(v, on, "left_semi").drop("_slug", "_low")


def with_backing(claims: DataFrame, quotes: DataFrame) -> DataFrame:
    """All claims, with `_kept`: whether they are `backed`. For quotes of real postings, which a posting's text bounds: those of a posting are gathered and joined by the posting alone, so claims that are dealt by it are not shuffled."""
    v = quotes.filter("verbatim_verified").select("posting_id", "claim_type", team_slug("subject").alias("slug"), _low("quote_text").alias("low"))
    v = v.groupBy("posting_id").agg(F.collect_list(F.struct("claim_type", "slug", "low")).alias("_quotes"))
    # slugs take a row through Python, which loses how it was dealt: after the join
    c = claims.join(v, "posting_id", "left").withColumn("_slug", team_slug("subject")).withColumn("_low", F.coalesce(_low("subject"), F.lit("")))
    same = lambda q: (q["claim_type"] == F.col("claim_type")) & _backs(F.col("_slug"), F.col("_low"), q["slug"], q["low"])
    return c.withColumn("_kept", F.coalesce(F.exists("_quotes", same), F.lit(False))).select(*claims.columns, "_kept")


SINGLE_CLAIMS = [("team_name", "team_name"), ("parent_org", "parent_org"), ("team_acronym", "team_acronym"),
                 ("hiring_manager", "hiring_manager"), ("reports_to_title", "reports_to"), ("site_stated", "site_stated")]

CLAIM_TYPES = [*(kind for _, kind in SINGLE_CLAIMS), "supports_team", "tech"]


def extract_claims(extracts: DataFrame) -> DataFrame:
    """One row per stated field of an extract: (posting_id, field, claim_type, subject)."""
    one = [F.struct(F.lit(f).alias("field"), F.lit(t).alias("claim_type"), F.trim(F.col(f)).alias("subject")) for f, t in SINGLE_CLAIMS]
    many = lambda col, name, field, kind: F.transform(F.coalesce(F.col(col), F.array().cast(extracts.schema[col].dataType)), lambda s: F.struct(
        F.lit(field).alias("field"), F.lit(kind).alias("claim_type"), F.trim(s[name]).alias("subject")))
    rows = F.concat(F.array(*one), many("supports_teams", "team", "supports", "supports_team"), many("tech_stack", "tool", "tech", "tech"))
    return extracts.select("posting_id", F.inline(rows)).filter(F.coalesce("subject", F.lit("")) != "")


def drop_unsupported(extracts: DataFrame, quotes: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """V4: one row per posting: surviving fields, surviving lists, dropped names, counts and ok/thin status.

    An acronym also survives on its team name's evidence. A parent that is company boilerplate is dropped. Status is ok
    when a team, parent, tool or supported team is left.
    """
    state = with_backing(extract_claims(extracts), quotes.filter(F.col("claim_type").isin(*CLAIM_TYPES)))
    if companies is not None:
        parents = state.filter((F.col("field") == "parent_org") & F.col("_kept"))
        real = drop_boilerplate(parents, companies, "subject").select("posting_id", F.lit("parent_org").alias("field"),
                                                                       F.lit(True).alias("_real"))
        state = state.join(real, ["posting_id", "field"], "left").withColumn(
            "_plate", (F.col("field") == "parent_org") & F.col("_kept") & F.col("_real").isNull())
        state = state.withColumn("_kept", F.col("_kept") & ~F.col("_plate")).drop("_real")
    else:
        state = state.withColumn("_plate", F.lit(False))
    team = F.max(F.when((F.col("field") == "team_name") & F.col("_kept"), F.col("subject")))
    value = lambda f: F.max(F.when((F.col("field") == f) & F.col("_kept"), F.col("subject")))
    listed = lambda f: F.array_sort(F.collect_set(F.when((F.col("field") == f) & F.col("_kept"), F.col("subject"))))
    label = F.when(F.col("_plate"), "parent_org(boilerplate)").when(
        F.col("field").isin("supports", "tech"), F.concat("field", F.lit(":"), "subject")).otherwise(F.col("field"))
    out = state.groupBy("posting_id").agg(
        team.alias("team_name"), value("parent_org").alias("parent_org"), value("team_acronym").alias("_acro"),
        F.max(F.when(F.col("field") == "team_acronym", F.col("subject"))).alias("_acro_any"),
        value("hiring_manager").alias("hiring_manager"), value("reports_to_title").alias("reports_to_title"),
        value("site_stated").alias("site_stated"), listed("supports").alias("supports_teams"), listed("tech").alias("tech_stack"),
        F.array_sort(F.collect_list(F.when(~F.col("_kept"), label))).alias("_dropped"))
    acro = F.when(F.col("_acro").isNotNull() | F.col("team_name").isNotNull(), F.col("_acro_any"))
    out = out.withColumn("team_acronym", acro)
    saved = F.col("_acro").isNull() & F.col("team_acronym").isNotNull()
    dropped = F.when(saved, F.array_remove("_dropped", "team_acronym")).otherwise(F.col("_dropped"))
    alive = (F.col("team_name").isNotNull() | F.col("parent_org").isNotNull() | (F.size("tech_stack") > 0) | (F.size("supports_teams") > 0))
    out = (out.withColumn("dropped", dropped).withColumn("n_claims_dropped", F.size("dropped"))
           .withColumn("team_slug", team_slug("team_name")).withColumn("parent_slug", team_slug("parent_org"))
           .withColumn("extract_status", F.when(alive, "ok").otherwise("thin")).drop("_acro", "_acro_any", "_dropped"))
    bare = extracts.select("posting_id").distinct()
    return bare.join(out, "posting_id", "left").withColumn("n_claims_dropped", F.coalesce("n_claims_dropped", F.lit(0))).withColumn(
        "extract_status", F.coalesce("extract_status", F.lit("thin")))


def verified_vocabulary(extracts: DataFrame, bodies: DataFrame) -> DataFrame:
    """V4: the vocabulary phrases that pass the verbatim gate: (posting_id, pos, phrase)."""
    rows = extracts.select("posting_id", F.posexplode("vocabulary").alias("pos", "quote_text"))
    return verify_quotes(rows, bodies).filter("verbatim_verified").select("posting_id", "pos", F.col("quote_text").alias("phrase"))
