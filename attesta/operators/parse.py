"""Parsing and extraction from text. Regex work stays in built-in expressions; three operators need Python batches."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta import config as cfg
from attesta.functions.places import slug_to_key
from attesta.functions.text import collapse
from attesta.operators.grams import containments
from attesta.operators.skew import first_per_group, top_per_group


# ---------------------------------------------------------------- X1 URL shapes
def _groups(pattern: str) -> list[str]:
    return re.findall(r"\(\?<(\w+)>", pattern)


def parse_url_shapes(df: DataFrame, url: str = "url", shapes=None, prefer: str | None = None) -> DataFrame:
    """Adds city_slug, city_raw, role_slug, req_id, url_form; rows that are not one posting are dropped.

    The preferred shape is tried first, then the rest in order. A slashed request id is a legacy date path:
    form `phenom_datepath`, no request id.
    """
    shapes = list(shapes or cfg.URL_SHAPES)
    shapes.sort(key=lambda s: s[0] != prefer)
    path = F.try_parse_url(F.col(url), F.lit("PATH"))
    found = F.lit(None).cast("struct<kind:string,city:string,role:string,req:string>")
    for kind, pattern in reversed(shapes):
        names = _groups(pattern)
        part = lambda g: (F.regexp_extract(path, pattern, names.index(g) + 1) if g in names else F.lit(""))
        found = F.when(path.rlike(pattern), F.struct(
            F.lit(kind).alias("kind"), part("city").alias("city"), part("role").alias("role"),
            F.trim(part("req"), F.lit("/")).alias("req"))).otherwise(found)
    hit = df.filter(~F.col(url).rlike(cfg.NOT_A_POSTING)).withColumn("_m", found).filter(F.col("_m").isNotNull())
    dated = (F.col("_m.kind") == "phenom") & F.contains(F.col("_m.req"), F.lit("/"))
    decoded = lambda c: F.coalesce(F.try_url_decode(F.regexp_replace(c, r"\+", "%2B")), c)
    return hit.select(
        *df.columns,
        slug_to_key(F.col("_m.city")).alias("city_slug"), decoded(F.col("_m.city")).alias("city_raw"),
        F.trim(F.regexp_replace(F.lower(decoded(F.col("_m.role"))), r"[^a-z0-9\-]+", "-"), F.lit("-")).alias("role_slug"),
        F.when(dated, "").otherwise(F.col("_m.req")).alias("req_id"),
        F.when(dated, "phenom_datepath").otherwise(F.col("_m.kind")).alias("url_form"))


# ---------------------------------------------------------------- X2 ordered detector
def first_match(df: DataFrame, col: str, rules, name: str = "rule", text: str = "matched", extra=()) -> DataFrame:
    """The first rule of an ordered table that matches, its matched text, and its further values."""
    c = F.coalesce(F.col(col), F.lit(""))
    fields = [name, text, *extra]
    out = F.struct(*[F.lit("").alias(f) for f in fields])
    for rule in reversed(list(rules)):
        values = [F.lit(rule[0]).alias(name), F.regexp_extract(c, rule[1], 0).alias(text)]
        values += [F.lit(v).alias(f) for f, v in zip(extra, rule[2:])]
        out = F.when(c.rlike(rule[1]), F.struct(*values)).otherwise(out)
    return df.withColumn("_hit", out).select(*df.columns, *[F.col(f"_hit.{f}").alias(f) for f in fields])


def detect_ats(df: DataFrame, html: str = "html") -> DataFrame:
    """Applicant-tracking system named by the page, its marker, what history it can give, and the shape of its interface: JSON by a
    get or a post, a feed, or pages rendered on the server."""
    rules = [(n, "(?i)" + p, b, shape) for n, p, b, shape in cfg.ATS_MARKERS]
    return first_match(df, html, rules, "ats", "ats_host", ("bucket", "api_shape"))


# ---------------------------------------------------------------- X3 JSON-LD
JOB_POSTING = "struct<`@type`:string,title:string,datePosted:string,description:string,identifier:string,jobLocation:string>"


def json_ld(df: DataFrame, html: str = "html") -> DataFrame:
    """has_job_posting, and the first JobPosting object of the page's JSON-LD blocks (bare or in a list)."""
    blocks = F.regexp_extract_all(
        F.col(html), F.lit(r"(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    named = F.filter(blocks, lambda b: F.contains(b, F.lit("JobPosting")))
    listed = lambda b: F.ltrim(b).startswith("[")
    one = lambda b: F.from_json(b, JOB_POSTING)
    from_list = lambda b: F.get(F.filter(F.from_json(b, f"array<{JOB_POSTING}>"),
                                         lambda o: o["@type"] == "JobPosting"), F.lit(0))
    parsed = F.transform(named, lambda b: F.when(listed(b), from_list(b)).otherwise(one(b)))
    good = F.filter(parsed, lambda o: (o["@type"] == "JobPosting") | o["title"].isNotNull())
    return df.withColumn("has_job_posting", F.exists(
        blocks, lambda b: F.contains(b, F.lit('"JobPosting"')) | F.contains(b, F.lit("'JobPosting'")))
    ).withColumn("job_posting", F.get(good, F.lit(0)))


# ---------------------------------------------------------------- X4 sitemap and robots facts
def sitemap_urls(df: DataFrame, text: str = "text", pattern: str = cfg.JOB_URL) -> DataFrame:
    """One row per job-looking <loc> of a sitemap text."""
    locs = F.regexp_extract_all(F.col(text), F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(locs).alias("loc")).filter(F.col("loc").rlike(pattern))


def robots_allows(df: DataFrame, text: str = "text", pattern: str = cfg.JOB_URL) -> DataFrame:
    """allows_jobs and the directive count, from the rules that follow a `User-agent: *` line.

    A rule belongs to the agent line most recently above it; the scan is one fold over the lines of a file, which keeps a name, a count and a flag.
    """
    lines = F.filter(F.transform(F.split(F.col(text), r"\r?\n"), F.trim), lambda l: (l != "") & ~l.startswith("#"))
    agent = r"(?i)^user-agent:\s*(\S+)"
    state = lambda name, n, blocked: F.struct(name.alias("agent"), n.alias("n"), blocked.alias("blocked"))
    path = lambda l: F.regexp_replace(l, r"(?i)disallow:\s*", "")
    blocks = lambda l: l.rlike("(?i)^disallow:") & ((path(l) == "/") | ((path(l) != "") & path(l).rlike(pattern)))
    scan = F.aggregate(lines, state(F.lit(""), F.lit(0), F.lit(False)), lambda acc, l: F.when(
        l.rlike(agent), state(F.regexp_extract(l, agent, 1), acc["n"], acc["blocked"])
    ).when(acc["agent"] == "*", state(acc["agent"], acc["n"] + 1, acc["blocked"] | blocks(l))).otherwise(acc))
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, scan.alias("_scan")).select(*rest, F.col("_scan.n").alias("n_directives"), (~F.col("_scan.blocked")).alias("allows_jobs"))


# ---------------------------------------------------------------- X5 segments, X6 span overlap
_BREAK = re.compile(cfg.SENTENCE_BREAK)
_ABBREVIATION = re.compile(cfg.ABBREVIATION)
_LIST = re.compile(cfg.LIST_BREAK)


def in_blocks(rows: Iterator[tuple], names: list[str], size: int = 20_000) -> Iterator[pd.DataFrame]:
    """Frames of at most `size` rows, so that what one batch of long texts yields is never held whole."""
    rows = iter(rows)
    while block := list(itertools.islice(rows, size)):
        yield pd.DataFrame(block, columns=names)


def sentence_spans(body: str, max_words: int = cfg.MAX_SEGMENT_WORDS) -> Iterator[tuple[int, int]]:
    """Slices of one text: sentences, with over-long ones cut again at list punctuation."""
    edges, begin = [], 0
    for gap in _BREAK.finditer(body):
        # an abbreviation is at most a few characters, so its last 16 characters decide
        if not _ABBREVIATION.search(body, max(begin, gap.start() - 16), gap.start()):
            edges.append((begin, gap.start()))
            begin = gap.end()
    edges.append((begin, len(body)))
    for lo, hi in edges:
        gaps = [(lo, lo)]
        if len(body[lo:hi].split()) > max_words:
            gaps += [g.span() for g in _LIST.finditer(body, lo, hi)]
        gaps.append((hi, hi))
        for (_, left), (right, _) in zip(gaps, gaps[1:]):
            if body[left:right].strip():
                yield left, right


def segment(df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, seg_no, seg_id, text, start, end); every segment is the exact slice text[start:end] in code points."""
    id_type = df.schema[id].dataType
    schema = T.StructType([T.StructField(id, id_type), T.StructField("seg_no", T.IntegerType()),
                           T.StructField("seg_id", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])

    def cut_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from in_blocks(((key, i, f"S{i:03d}", body[s:e], s, e) for key, body in zip(pdf[id], pdf[text])
                                  if body is not None for i, (s, e) in enumerate(sentence_spans(body))), schema.names)

    return df.select(id, text).mapInPandas(cut_batches, schema)


def _bins(lo: Column, hi: Column, width: int) -> Column:
    """The stretches of `width` code points that a span touches, the one of its start at least."""
    first = F.floor(lo / width)
    return F.sequence(first, F.greatest(first, F.floor((hi - 1) / width)))


def span_overlap(segs: DataFrame, quotes: DataFrame, id: str, quote: str, width: int = 2048) -> DataFrame:
    """Per quote the segment covering the largest share of its span; lowest segment number on ties.

    quotes: (id, quote, q_start, q_end). Spans meet in stretches of `width` code points of a text, and a pair counts in the first stretch that both touch. So a text of any length is many
    keys, and a quote is compared with the segments near it. A quote that no segment overlaps has a share of 0.
    """
    s = segs.select(F.col(id).alias("_id"), "seg_no", "start", "end", F.explode(_bins(F.col("start"), F.col("end"), width)).alias("_bin"))
    q = quotes.select(id, quote, "q_start", "q_end", F.explode(_bins(F.col("q_start"), F.col("q_end"), width)).alias("_qbin"))
    first = F.floor(F.greatest("start", "q_start") / width)
    on = (F.col(id) == F.col("_id")) & (F.col("_bin") == F.col("_qbin")) & (F.col("_bin") == first) & (F.col("start") < F.col("q_end")) & (F.col("end") > F.col("q_start"))
    share = (F.least("end", "q_end") - F.greatest("start", "q_start")) / F.greatest(F.lit(1), F.col("q_end") - F.col("q_start"))
    pairs = q.join(s, on).select(id, quote, share.alias("share"), (-F.col("seg_no")).alias("neg"))
    none = quotes.select(id, quote, F.lit(0.0).alias("share"), F.lit(None).cast("int").alias("neg"))
    best = pairs.unionByName(none).groupBy(id, quote).agg(F.max(F.struct("share", "neg")).alias("_b"))
    return best.select(id, quote, (-F.col("_b.neg")).alias("seg_no"), F.col("_b.share").alias("share"))


# ---------------------------------------------------------------- X7, X13 fields in bodies
def regex_fields(df: DataFrame, body: str = "body", title: str = "title") -> DataFrame:
    """site_stated and posted_date by ordered patterns; an impossible calendar date is null."""
    b, t = F.col(body), F.coalesce(F.col(title), F.lit(""))
    loc = F.trim(F.regexp_extract(b, cfg.LOCATION_FIELD, 1))
    first = F.regexp_extract(loc, cfg.FIRST_LOCATION, 1)
    after = F.substr(b, F.length(t) + 1)
    lead = F.regexp_extract(after, r"^(.*?)" + cfg.POSTED_ISO, 1)
    titled = (t != "") & F.startswith(b, t) & after.rlike(r"^.{0,79}?" + cfg.POSTED_ISO)
    site = (F.when(b.rlike(cfg.LOCATION_FIELD), F.when(first != "", first).otherwise(loc))
            .when(titled, F.trim(lead)))
    number = lambda p, i: F.regexp_extract(b, p, i)
    us, named, iso = (r"\bDate [Pp]osted\s+(\d{1,2})/(\d{1,2})/(\d{4})",
                      r"\bDate [Pp]osted\s+(\d{1,2})-([A-Za-z]{3})-(\d{4})",
                      r"\bPosted\s+(\d{4})-(\d{2})-(\d{2})")
    day = lambda *parts: F.try_to_date(F.concat_ws("-", *parts), "yyyy-M-d")
    date = (F.when(b.rlike(us), day(number(us, 3), number(us, 2), number(us, 1)))
            .when(b.rlike(named), F.try_to_date(F.concat_ws("-", number(named, 1), F.initcap(number(named, 2)),
                                                            number(named, 3)), "d-MMM-yyyy"))
            .when(b.rlike(iso), day(number(iso, 1), number(iso, 2), number(iso, 3))))
    return df.withColumn("site_stated", site).withColumn("posted_date", date)


def body_date(df: DataFrame, body: str = "body", tier: str = "tier", date: str = "posted_date") -> DataFrame:
    """Rows from a live body that lack a date take the first posted-date pattern of the body."""
    found = F.regexp_extract(F.col(body), cfg.BODY_DATE, 1)
    fill = F.col(date).isNull() & (F.col(tier) == "tier3_live_body") & (found != "")
    return (df.withColumn("posted_date_source", F.when(fill, "body_posted_date"))
            .withColumn(date, F.when(fill, found).otherwise(F.col(date))))


# ---------------------------------------------------------------- X8, X9 candidate phrases
_TOKEN = re.compile(cfg.PHRASE_TOKEN)
_SLASHED = re.compile(cfg.PHRASE_SLASHED)
_PHRASE_BREAK = re.compile(cfg.PHRASE_BREAK)
_SHAPE = re.compile(cfg.PHRASE_SHAPE)
_STOP = frozenset(cfg.PHRASE_STOP)
#: Letters beyond ASCII that match an ASCII letter in either case.
_FOLDS = "\u017f\u0130\u0131\u212a"


def phrases(text: str, longest: int = 3, max_chars: int | None = None) -> list[str]:
    """Distinct 1..longest token slices that could name a tool: slashed names first, then by position."""
    tokens = list(_TOKEN.finditer(text))
    named = {}
    for m in _SLASHED.finditer(text):
        named.setdefault(m.group().lower(), m.group())
    # what a slice is follows from its tokens and the gaps between them, each looked at once; letters that fold into ASCII ones may tie a token to a gap
    words = [m.group() for m in tokens]
    low = [w.lower() for w in words]
    stop = [w in _STOP for w in low]
    shaped = [w != l or _SHAPE.search(w) is not None for w, l in zip(words, low, strict=True)]
    starts, ends = [m.start() for m in tokens], [m.end() for m in tokens]
    gaps = [text[e:s] for e, s in zip(ends, starts[1:], strict=False)]
    broken = [g != " " and _PHRASE_BREAK.search(g) is not None for g in gaps]
    marked = [g != " " and (_SHAPE.search(g) is not None or any(ch.isupper() for ch in g)) for g in gaps]
    folds = not text.isascii() and any(ch in text for ch in _FOLDS)
    for i, at in enumerate(starts):
        if stop[i]:
            continue
        on = False
        for j in range(i, min(i + longest, len(starts))):
            if j > i:
                if broken[j - 1]:
                    break
                on = on or marked[j - 1]
            on = on or shaped[j]
            if not stop[j] and (on or folds):
                piece = text[at:ends[j]]
                if on or _SHAPE.search(piece):
                    named.setdefault(piece.lower(), piece)
    return [p for p in named.values() if max_chars is None or len(p) <= max_chars]


def candidates(df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, pos, phrase), one row per candidate phrase of a text."""
    schema = T.StructType([T.StructField(id, df.schema[id].dataType), T.StructField("pos", T.IntegerType()),
                           T.StructField("phrase", T.StringType())])

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from in_blocks(((key, i, p) for key, t in zip(pdf[id], pdf[text]) if t is not None
                                  for i, p in enumerate(phrases(t))), schema.names)

    return df.select(id, text).mapInPandas(spread, schema)


def suppress_nested(df: DataFrame, seg, phrase: str = "phrase", p: str = "p") -> DataFrame:
    """Of phrases nested in one another inside one segment keep the most probable, the longer on ties.

    Nested phrases are found by runs of characters that they share (`grams.containments`), not by comparing all phrases of a segment; of each phrase the strongest one nested with it decides.
    """
    seg = [seg] if isinstance(seg, str) else list(seg)
    d = df.withColumn("_n", F.lower(collapse(phrase)))
    pairs = containments(d, seg, "_n")
    both = pairs.select(*seg, F.col("_inner").alias("_n"), F.col("_outer").alias("_o")).unionByName(pairs.select(*seg, F.col("_outer").alias("_n"), F.col("_inner").alias("_o")))
    strength = d.filter(F.col(p).isNotNull()).groupBy(*seg, F.col("_n").alias("_o")).agg(F.max(p).alias("_op"))
    best = both.join(strength, [*seg, "_o"]).groupBy(*seg, "_n").agg(F.max(F.struct("_op", F.length("_o").alias("_ol"))).alias("_best"))
    beaten = (F.col("_best._op") > F.col(p)) | ((F.col("_best._op") == F.col(p)) & (F.col("_best._ol") > F.length("_n")))
    return d.join(best, [*seg, "_n"], "left").filter(~F.coalesce(beaten, F.lit(False))).select(*df.columns)


# ---------------------------------------------------------------- X10, X11 people and lineage
def names_in(df: DataFrame, text: str) -> DataFrame:
    """One row per 'Name, Title' clause; organisation words in the name or a title without a title word drop it."""
    c = F.coalesce(F.col(text), F.lit(""))
    names = F.regexp_extract_all(c, F.lit(cfg.PERSON_CLAUSE), F.lit(1))
    titles = F.regexp_extract_all(c, F.lit(cfg.PERSON_CLAUSE), F.lit(2))
    rows = df.withColumn("_z", F.explode(F.arrays_zip(names.alias("name"), titles.alias("title"))))
    name = F.trim(F.col("_z.name"))
    title = F.regexp_replace(F.trim(F.col("_z.title")), r"[,;.\- ]+$", "")
    words = F.transform(F.split(name, r"\s+"), lambda t: F.trim(F.lower(t), F.lit(".")))
    stop = F.array(*[F.lit(w) for w in cfg.NOT_A_PERSON])
    return (rows.filter(~F.arrays_overlap(words, stop) & title.rlike(cfg.PERSON_TITLE))
            .select(*df.columns, name.alias("name"), title.alias("title_hint")))


def lineage(df: DataFrame, text: str) -> DataFrame:
    """X11: one row per 'Name (year): note' fragment of a `;` list."""
    rows = df.withColumn("_f", F.explode(F.split(F.col(text), ";"))).filter(F.col("_f").rlike(cfg.LINEAGE))
    part = lambda i: F.trim(F.regexp_extract("_f", cfg.LINEAGE, i))
    return rows.select(*[c for c in df.columns if c != text], part(2).cast("int").alias("year"),
                       part(1).alias("acquired"), part(3).alias("note"))


# ---------------------------------------------------------------- X12 best body
def best_body(versions: DataFrame, id: str = "posting_id", min_chars: int = cfg.MIN_BODY,
              captures: int | None = None) -> DataFrame:
    """The usable version of each body: API, else live, else the fattest archive capture; else a shell row.

    versions: (id, source api|live|archive, captured_at, length, text). With `captures` only so many of the fattest
    archive captures count.
    """
    usable = (F.length("text") >= min_chars) & (
        (F.col("source") == "api") | ~F.coalesce(F.col("text").rlike(cfg.EXPIRED_PAGE), F.lit(False)))
    archive = versions.filter(F.col("source") == "archive")
    if captures:
        archive = top_per_group(archive, [id], [F.col("length").desc(), F.col("captured_at").asc()], captures)
    pool = versions.filter(F.col("source").isin("api", "live")).unionByName(archive).filter(usable)
    rank = F.when(F.col("source") == "api", 0).when(F.col("source") == "live", 1).otherwise(2)
    best = first_per_group(pool, [id], [rank.asc(), F.col("length").desc(), F.col("captured_at").asc()])
    tier = F.when(F.col("source") == "archive", "tier2_archive_body").otherwise("tier3_live_body")
    good = best.select(id, "source", "text", F.length("text").alias("body_chars"), tier.alias("tier"), F.lit("ok").alias("status"))
    shell = versions.select(id).distinct().join(best.select(id), id, "left_anti").select(
        id, F.lit("").alias("source"), F.lit("").alias("text"), F.lit(0).alias("body_chars"),
        F.lit("tier1_shell").alias("tier"), F.lit("body_unavailable").alias("status"))
    return good.unionByName(shell)


# ---------------------------------------------------------------- X14 keyword hits
def kw_hits(df: DataFrame, id: str, fields, rules, window: int = 80) -> DataFrame:
    """(id, label, field, pos, keyword, negated) per match; negated when a cue closes the 80 characters before."""
    compiled = [(label, re.compile(rx, re.I)) for label, rx in rules]
    cue = re.compile(cfg.NEGATION)
    schema = T.StructType([T.StructField(id, df.schema[id].dataType), T.StructField("label", T.StringType()),
                           T.StructField("field", T.StringType()), T.StructField("pos", T.IntegerType()),
                           T.StructField("keyword", T.StringType()), T.StructField("negated", T.BooleanType())])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hits = ((key, label, field, m.start(), m.group(), bool(cue.search(value[max(0, m.start() - window):m.start()])))
                    for field in fields for key, value in zip(pdf[id], pdf[field])
                    for label, rx in (compiled if value else ()) for m in rx.finditer(value))
            yield from in_blocks(hits, schema.names)

    return df.select(id, *fields).mapInPandas(scan, schema)
