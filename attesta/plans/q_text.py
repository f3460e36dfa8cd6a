"""Queries over texts and pages: keys, markup, segments, phrases, the verbatim gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta import config as cfg
from attesta.functions import dates, ids, places, text
from attesta.operators import claims, dedupe, parse, quality, scrub, tallies
from attesta.operators.rules import drop_boilerplate
from attesta.plans import derive as dv
from attesta.plans.base import query
from attesta.plans.derive import with_
from attesta.sources import feeds

FOLD = "strip_accents(text)"


@query("text_keys", f"""SELECT doc_id, md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS norm, md5(trim(regexp_replace(lower({FOLD}), '[^a-z0-9]+', '-', 'g'), '-')) AS slug,
  md5(regexp_replace(lower({FOLD}), '[^a-z0-9]', '', 'g')) AS ckey, md5(trim(regexp_replace(lower({FOLD}), '[^a-z0-9]+', ' ', 'g'))) AS title_key,
  md5(regexp_replace(lower(text), '[^a-z]', '', 'g')) AS nname, substr(sha1(source || '|' || lang), 1, 10) AS h10 FROM documents""")
def text_keys(t):
    """N2, N3, N4, N9, N10, N18 over whole texts; the long keys are shown as their md5."""
    d = F.md5
    return t.documents.select("doc_id", d(text.norm("text")).alias("norm"), d(text.slug("text")).alias("slug"), d(text.ckey("text")).alias("ckey"),
                              d(text.title_key("text")).alias("title_key"), d(text.nname("text")).alias("nname"), ids.h10("source", "lang").alias("h10"))


@query("folded_text", f"SELECT doc_id, md5({FOLD}) AS folded FROM documents")
def folded_text(t):
    return t.documents.select("doc_id", F.md5(text.afold("text")).alias("folded"))


@query("place_keys", with_(dv.SITES_SQL) + """SELECT site_id, city_key AS "primary", alias_key AS alias, metro_key AS metro, city_key || 'side' AS from_slug,
  'Town' || substr(city_key, 5) AS proper FROM sites""")
def place_keys(t):
    c = places.city_keys("city")
    url_slug = F.concat(F.split_part("city", F.lit(" "), F.lit(1)), F.lit("-Side-MA"))
    return dv.sites(t).select("site_id", F.array_join(c["primary"], "|").alias("primary"), F.array_join(c["alias"], "|").alias("alias"),
                              F.array_join(places.metro_keys("metro"), "|").alias("metro"), places.slug_to_key(url_slug).alias("from_slug"),
                              places.city_proper("city").alias("proper"))


@query("periods", """SELECT o_orderkey, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS from_text,
  CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d')
    WHEN 2 THEN strftime(o_orderdate - INTERVAL (o_orderkey % 40) DAY, '%Y-%m-%d') ELSE '' END AS rel FROM orders""")
def periods(t):
    k = F.col("o_orderkey")
    said = (F.when(k % 4 == 0, "Posted today").when(k % 4 == 1, "posted Yesterday").when(k % 4 == 2, F.concat((k % 40).cast("string"), F.lit(" days ago")))
            .otherwise("30+ days ago"))
    rel = dates.rel_date(said, "o_orderdate")["date"]
    return t.orders.select("o_orderkey", dates.quarter("o_orderdate").alias("period"), dates.quarter_of_text(F.date_format("o_orderdate", "yyyyMMdd")).alias("from_text"),
                           F.coalesce(rel.cast("string"), F.lit("")).alias("rel"))


@query("posting_titles", with_(dv.POSTINGS_SQL) + """SELECT posting_id, CASE role_slug WHEN 'lims-administrator' THEN 'LIMS Administrator' WHEN 'qc-analyst' THEN 'QC Analyst'
  WHEN 'msat-lead' THEN 'MSAT Lead' WHEN 'head-of-mes' THEN 'Head Of MES' ELSE array_to_string(list_transform(string_split(role_slug, '-'), lambda w: upper(w[1]) || w[2:]), ' ') END AS title FROM postings""")
def posting_titles(t):
    return dv.postings(t).select("posting_id", text.titleise("role_slug").alias("title"))


def _strip_sql(col: str) -> str:
    out = col
    for tag in ("script", "style", "noscript", "svg", "head", "nav", "footer"):
        out = f"regexp_replace({out}, '(?is)<{tag}[^>]*>.*?</{tag}>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?s)<[^>]+>', ' ', 'g')"
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


@query("html_text", f"SELECT page_id, length({_strip_sql('html')}) AS n_chars, md5({_strip_sql('html')}) AS body FROM pages")
def html_text(t):
    body = t.pages.select("page_id", text.html_to_text("html").alias("b"))
    return body.select("page_id", F.length("b").cast("long").alias("n_chars"), F.md5("b").alias("body"))


@query("detect_ats", """SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'workday' WHEN 1 THEN 'greenhouse' WHEN 2 THEN 'icims' WHEN 3 THEN 'phenom' ELSE '' END AS ats,
  CASE page_id % 5 WHEN 0 THEN 'api_current_only' WHEN 1 THEN 'api_current_only' WHEN 2 THEN 'history_available' WHEN 3 THEN 'history_available' ELSE '' END AS bucket,
  CASE page_id % 5 WHEN 0 THEN 'post_json' WHEN 1 THEN 'get_json' WHEN 2 THEN 'pages' WHEN 3 THEN 'pages' ELSE '' END AS api_shape FROM pages""")
def detect_ats(t):
    """Whole pages with a careers link put in; a page can carry markers of two systems, the first rule wins."""
    k = F.col("page_id")
    link = dv.pick(["https://acme.wd3.myworkdayjobs.com/x jobs.lever.co/y", "boards.greenhouse.io/acme taleo", "jobs-acme.icims.com", "/job/town/lead/12/345", "none"], k % 5)
    return parse.detect_ats(t.pages.select("page_id", F.concat("html", F.lit(" "), link).alias("html"))).select("page_id", "ats", "bucket", "api_shape")


@query("ats_census", """SELECT CASE page_id % 5 WHEN 4 THEN 'needs_work' WHEN 2 THEN 'history_available' WHEN 3 THEN 'history_available' ELSE 'api_current_only' END AS bucket,
  count(*) AS n, median(length(html)) AS median_chars FROM pages GROUP BY 1""")
def ats_census(t):
    k = F.col("page_id")
    link = dv.pick(["acme.wd3.myworkdayjobs.com", "boards.greenhouse.io/acme", "jobs-acme.icims.com", "/job/town/lead/12/345", "none"], k % 5)
    d = parse.detect_ats(t.pages.select("page_id", F.length("html").alias("chars"), F.concat("html", F.lit(" "), link).alias("html")))
    return tallies.census(d, "bucket", measures=["chars"])


@query("json_ld", """SELECT page_id, page_id % 4 <> 3 AS has_job_posting, CASE WHEN page_id % 4 IN (0, 1) THEN 'Role ' || page_id ELSE '' END AS title,
  CASE WHEN page_id % 4 = 0 THEN '2024-01-02' ELSE '' END AS posted FROM pages""")
def json_ld(t):
    """Whole pages with a JSON-LD block put in: an object, a list, broken JSON, or none."""
    k = F.col("page_id")
    obj = F.format_string('{"@type":"JobPosting","title":"Role %d","datePosted":"2024-01-02"}', k)
    block = (F.when(k % 4 == 0, obj).when(k % 4 == 1, F.format_string('[{"@type":"Org","title":"x"},{"@type":"JobPosting","title":"Role %d"}]', k))
             .when(k % 4 == 2, '{"@type":"JobPosting", broken').otherwise('{"@type":"Article"}'))
    html = F.concat("html", F.lit('<script type="application/ld+json">'), block, F.lit("</script>"))
    d = parse.json_ld(t.pages.select("page_id", html.alias("html")))
    return d.select("page_id", "has_job_posting", F.coalesce("job_posting.title", F.lit("")).alias("title"),
                    F.coalesce("job_posting.datePosted", F.lit("")).alias("posted"))


@query("sitemap_urls", "SELECT page_id, rtrim(url, '/') || '/job/' || page_id AS loc FROM pages")
def sitemap_urls(t):
    job = F.concat(F.rtrim("url", F.lit("/")), F.lit("/job/"), F.col("page_id").cast("string"))
    body = F.concat(F.lit("<urlset><url><loc> "), job, F.lit(" </loc></url><url><loc>https://x.example/about</loc></url></urlset>"), "html")
    return parse.sitemap_urls(t.pages.select("page_id", body.alias("text")))


@query("robots_allows", """SELECT page_id, CASE WHEN page_id % 3 = 2 THEN 1 ELSE 2 END AS n_directives, page_id % 3 <> 1 AS allows_jobs FROM pages""")
def robots_allows(t):
    k = F.col("page_id")
    rules = (F.when(k % 3 == 0, "Disallow: /admin\nAllow: /").when(k % 3 == 1, "Disallow: /jobs/\nDisallow: /x").otherwise("Disallow:"))
    body = F.concat(F.lit("# robots\nUser-agent: other\nDisallow: /\n\nUser-agent: *\n"), rules, F.lit("\nUser-agent: bad\nDisallow: /job/\n"), "html")
    return parse.robots_allows(t.pages.select("page_id", body.alias("text")))


@query("careers_probe", r"""WITH c AS (SELECT len(regexp_extract_all(html, '<a href="/t')) AS jobs, len(regexp_extract_all(html, '<b>')) AS structured FROM pages)
SELECT CASE WHEN jobs > 0 AND structured > 0 THEN 'scrapeable_structured' WHEN jobs > 0 THEN 'scrapeable_unstructured' ELSE 'no_html_listing' END AS verdict, count(*) AS n FROM c GROUP BY 1""")
def careers_probe(t):
    """Links of one kind stand for jobs, bold text for structure, counted in whole pages."""
    d = t.pages.select(F.regexp_count("html", F.lit('<a href="/t')).alias("n_jobs"), F.regexp_count("html", F.lit("<b>")).alias("n_structured"))
    return tallies.census(d.withColumn("verdict", tallies.probe_verdict("n_jobs", "n_structured")), "verdict")


# ---------------------------------------------------------------- feeds and payloads
@query("parse_feed", """SELECT doc_id, sha1('https://n.example/' || doc_id) AS item_id, 'Story ' || doc_id AS title, source, strftime(DATE '2025-01-01' + CAST(doc_id % 300 AS INT), '%Y-%m-%d') AS published,
  md5(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) AS snippet FROM documents WHERE doc_id % 10 <> 9""")
def parse_feed(t):
    """Documents as RSS items: the whole text is the description; every tenth item has no link."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("doc_id") % 300).cast("int"))
    pub = F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 08:00:00 GMT"))
    k = F.col("doc_id").cast("string")
    link = F.when(F.col("doc_id") % 10 == 9, F.lit("")).otherwise(F.concat(F.lit("https://n.example/"), k))
    clean = F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")
    xml = F.concat(F.lit("<item><title>Story "), k, F.lit(" - "), F.col("source"), F.lit("</title><link>"), link, F.lit("</link><pubDate>"), pub, F.lit("</pubDate><source>"),
                   F.col("source"), F.lit("</source><description>"), esc(esc(clean)), F.lit("</description></item>"))
    d = feeds.parse_feed(t.documents.select("doc_id", xml.alias("item_xml")))
    return d.select("doc_id", "item_id", "title", "source", F.coalesce(F.col("published").cast("string"), F.lit("")).alias("published"), F.md5("snippet").alias("snippet"))


@query("read_extracts", """SELECT 'c' || conv_id || '-' || turn AS posting_id, role || ' R&D' AS team_name, 1 AS n_quotes, md5(text) AS quote FROM conversations""")
def read_extracts(t):
    """Conversation turns as extraction payloads, one per file, either nested under `result` or not, with entities in a name."""
    post = F.array(F.struct(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("posting_id"),
                            F.concat(F.col("role"), F.lit(" R&amp;D")).alias("team_name"),
                            F.array(F.struct(F.lit("team_name").alias("claim_type"), F.col("role").alias("subject"),
                                             F.replace("text", F.lit("&"), F.lit("&amp;")).alias("quote_text"))).alias("quotes")))
    plain, nested = F.to_json(F.struct(post.alias("postings"))), F.to_json(F.struct(F.struct(post.alias("postings")).alias("result")))
    d = feeds.parse_extracts(t.conversations.select(F.when(F.col("turn") % 2 == 0, plain).otherwise(nested).alias("payload")))
    return d.select("posting_id", "team_name", F.size("quotes").alias("n_quotes"), F.md5(F.col("quotes")[0]["quote_text"]).alias("quote"))


@query("read_enrichment", """SELECT 'a' || (doc_id % 7) AS account_id, CASE doc_id % 3 WHEN 0 THEN 'publication' WHEN 1 THEN 'capex' ELSE 'conference_talk' END AS signal_type,
  'Doc ' || doc_id AS title, CAST(n_chars AS VARCHAR) AS date, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END AS n_people, md5(text) AS topic FROM documents""")
def read_enrichment(t):
    item = F.array(F.struct(F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"), F.col("n_chars").cast("string").alias("year"),
                            F.lit("capex").alias("signal_type"), F.col("text").alias("topic"), F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("A B"), F.lit("C D"))).alias("authors_named")))
    acct = F.concat(F.lit("a"), (F.col("doc_id") % 7).cast("string"))
    pubs = F.to_json(F.struct(F.array(F.struct(acct.alias("account_id"), item.alias("publications"))).alias("publications_by_account")))
    pilot = lambda group: F.to_json(F.struct(F.struct(acct.alias("account_id"), F.struct(item.alias("signals")).alias(group)).alias("pilot")))
    k = F.col("doc_id") % 3
    d = feeds.parse_enrichment(t.documents.select(F.when(k == 0, pubs).when(k == 1, pilot("news")).otherwise(pilot("conference")).alias("payload")))
    return d.select("account_id", "signal_type", "title", "date", F.size("named_people").alias("n_people"), F.md5("topic").alias("topic"))


@query("people_append", """WITH r AS (SELECT c_custkey AS k, 'a' || c_nationkey AS account_id, 'p' || translate(CAST(c_custkey % 700 AS VARCHAR), '0123456789', 'abcdefghij') AS nn FROM customer)
SELECT account_id, nn AS key, coalesce(min(k) FILTER (k % 2 = 0), min(k)) AS first_row, substr(sha256(account_id || '|' || nn), 1, 16) AS id FROM r GROUP BY ALL""")
def people_append(t):
    """Three spellings of a person for each customer; a person is new when the letters of the name are new in the account. The people of even customers are known before."""
    name = F.concat(F.lit("P "), F.translate((F.col("c_custkey") % 700).cast("string"), "0123456789", "abcdefghij"))
    items = t.customer.select(F.concat(F.lit("a"), F.col("c_nationkey").cast("string")).alias("account_id"), F.col("c_custkey"),
                              F.format_string("%012d", F.col("c_custkey")).alias("seq"), F.array(name, F.upper(name), F.concat(name, F.lit("."))).alias("named_people"))
    rows = dedupe.named_people(items, "named_people").withColumn("person_id", F.lit(None).cast("string"))
    even = F.col("c_custkey") % 2 == 0
    state = dedupe.append_people(rows.filter(F.lit(False)), rows.filter(even))
    out = dedupe.append_people(state, rows.filter(~even), prefix="p")
    return out.select("account_id", text.nname("name").alias("key"), F.col("c_custkey").alias("first_row"), F.substring("person_id", 2, 16).alias("id"))


@query("people_from_heads", with_(dv.SITES_SQL) + """SELECT account_id, site_id, regexp_extract(named_site_head, '^(.*), VP', 1) AS name, 'VP Operations' AS title FROM sites WHERE s_suppkey % 6 >= 3""")
def people_from_heads(t):
    dashed = dv.sites(t).withColumn("named_site_head", F.when(F.col("s_suppkey") % 6 >= 3, F.replace("named_site_head", F.lit(", VP"), F.lit(" - VP"))).otherwise("none"))
    return dedupe.people_from_heads(dashed)


# ---------------------------------------------------------------- segments, phrases, people
_ABBR = cfg.ABBREVIATION.removeprefix(r"(?i)\b(").removesuffix(r")\.$")
# a break becomes mark, gap, mark; the marks before an abbreviation's gap go again; long sentences are marked once more at list punctuation
SEGMENTS_SQL = rf"""marked AS (SELECT doc_id, text, regexp_replace(regexp_replace(text, '([.!?])(\s+)([A-Z0-9"“(])', '\1' || chr(1) || '\2' || chr(1) || '\3', 'g'),
  '(^|[^\pL\pN_])((?i:{_ABBR})\.)\x01(\s+)\x01', '\1\2\3', 'g') AS m FROM documents),
cut AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS part FROM (SELECT doc_id, string_split(m, chr(1)) AS l FROM marked)),
placed AS (SELECT doc_id, i, part, coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spot FROM cut),
trim_cut AS (SELECT doc_id, i, spot, string_split(CASE WHEN len(regexp_extract_all(part, '\S+')) > {cfg.MAX_SEGMENT_WORDS}
    THEN regexp_replace(regexp_replace(part, '(\s+)(•)', chr(2) || '\1' || chr(2) || '\2', 'g'), '(;)(\s+)', '\1' || chr(2) || '\2' || chr(2), 'g') ELSE part END, chr(2)) AS l FROM placed WHERE i % 2 = 1),
pieces AS (SELECT doc_id, i, spot, generate_subscripts(l, 1) AS j, unnest(l) AS piece FROM trim_cut),
spots AS (SELECT doc_id, i, j, piece, spot + coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM pieces),
segs AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INT) AS seg_no, piece, CAST(s AS INT) AS s, CAST(s + length(piece) AS INT) AS e FROM spots WHERE j % 2 = 1 AND regexp_matches(piece, '\S'))"""


@query("segment", with_(SEGMENTS_SQL) + """SELECT doc_id, seg_no, printf('S%03d', seg_no) AS seg_id, md5(piece) AS text, s AS start, e AS "end" FROM segs""")
def segment(t):
    d = parse.segment(t.documents, "doc_id", "text")
    return d.select("doc_id", "seg_no", "seg_id", F.md5("text").alias("text"), "start", "end")


QUOTED_SQL = """quoted AS (SELECT doc_id, CAST(floor(length(text) / 3) AS INT) AS qs, CAST(least(floor(length(text) / 3) + 40, length(text)) AS INT) AS qe FROM documents),
shares AS (SELECT q.doc_id, seg_no, coalesce((least(e, qe) - greatest(s, qs)) / greatest(1, qe - qs), 0) AS share FROM quoted q LEFT JOIN segs ON segs.doc_id = q.doc_id AND s < qe AND e > qs),
best AS (SELECT doc_id, seg_no, share FROM shares QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY share DESC, seg_no) = 1)"""


def doc_quotes(t):
    """A slice of every document, with its span."""
    n = F.length("text")
    start = F.floor(n / 3)
    return t.documents.select("doc_id", F.lit("q").alias("quote_id"), start.cast("int").alias("q_start"), F.least(start + 40, n).cast("int").alias("q_end"))


@query("segment_spans", with_(SEGMENTS_SQL, QUOTED_SQL) + "SELECT doc_id, 'q' AS quote_id, seg_no, round(share, 6) AS share FROM best")
def segment_spans(t):
    """Quotes whose best segment holds all of their span, or the largest share of it."""
    d = parse.span_overlap(parse.segment(t.documents, "doc_id", "text"), doc_quotes(t), "doc_id", "quote_id")
    return d.withColumn("share", F.round("share", 6))


@query("segment_coverage", with_(SEGMENTS_SQL, QUOTED_SQL) + r"""SELECT count(*) AS n_quotes, count(*) FILTER (share >= 0.999) AS n_inside, count(*) FILTER (share >= 0.6) AS n_most,
  (SELECT quantile_cont(len(regexp_extract_all(piece, '\S+')), 0.5) FROM segs) AS words_median, (SELECT quantile_cont(len(regexp_extract_all(piece, '\S+')), 0.95) FROM segs) AS words_p95,
  (SELECT max(len(regexp_extract_all(piece, '\S+'))) FROM segs) AS words_max FROM best""")
def segment_coverage(t):
    d = quality.segment_coverage(parse.segment(t.documents, "doc_id", "text"), doc_quotes(t), "doc_id", "quote_id")
    return d.withColumns({c: F.col(c).cast("double") for c in ("words_median", "words_p95")}).withColumn("words_max", F.col("words_max").cast("long"))


_STOP_SQL = "', '".join(cfg.PHRASE_STOP)
PHRASES_SQL = rf"""parts AS (SELECT doc_id, text, generate_subscripts(l, 1) AS i, unnest(l) AS part FROM (SELECT doc_id, text, string_split(regexp_replace(text, '({cfg.PHRASE_TOKEN})', chr(1) || '\1' || chr(1), 'g'), chr(1)) AS l FROM documents)),
spots AS (SELECT *, 1 + coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM parts),
tokens AS (SELECT doc_id, text, lower(part) AS w, s, s + length(part) AS e, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM spots WHERE i % 2 = 0),
slices AS (SELECT a.doc_id, a.k, b.k - a.k AS more, substr(a.text, CAST(a.s AS BIGINT), CAST(b.e - a.s AS BIGINT)) AS phrase, b.w AS last FROM tokens a JOIN tokens b ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + 2
  WHERE a.w NOT IN ('{_STOP_SQL}') AND b.w NOT IN ('{_STOP_SQL}')),
shaped AS (SELECT doc_id, k, more, phrase FROM slices WHERE (regexp_matches(phrase, '\p{{Lu}}') OR regexp_matches(phrase, '{cfg.PHRASE_SHAPE}')) AND NOT regexp_matches(phrase, '{cfg.PHRASE_BREAK}')),
slashed AS (SELECT doc_id, generate_subscripts(l, 1) - 1000000000 AS k, 0 AS more, unnest(l) AS phrase FROM (SELECT doc_id, regexp_extract_all(text, '{cfg.PHRASE_SLASHED}') AS l FROM documents)),
named AS (SELECT doc_id, lower(phrase) AS low, min((k, more, phrase)) AS f FROM (SELECT * FROM slashed UNION ALL SELECT * FROM shaped) GROUP BY ALL)"""


@query("candidate_phrases", with_(PHRASES_SQL) + "SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY f) - 1 AS INT) AS pos, f[3] AS phrase FROM named")
def candidate_phrases(t):
    return parse.candidates(t.documents, "doc_id", "text")


@query("suppress_phrases", """WITH r AS (SELECT o_custkey AS seg, lower(o_orderpriority) AS n, o_orderpriority AS phrase, (o_orderkey % 7) / 10.0e0 AS p, o_orderkey FROM orders),
x AS (SELECT * FROM r UNION ALL SELECT seg, lower(right(phrase, 3)), right(phrase, 3), p, -o_orderkey FROM r WHERE o_orderkey % 2 = 0)
SELECT seg, phrase, round(p, 3) AS p, o_orderkey FROM x i WHERE NOT EXISTS (SELECT 1 FROM x o WHERE o.seg = i.seg AND o.n <> i.n AND (contains(o.n, i.n) OR contains(i.n, o.n))
  AND (o.p > i.p OR (o.p = i.p AND length(o.n) > length(i.n))))""")
def suppress_phrases(t):
    d = t.orders.select(F.col("o_custkey").alias("seg"), F.col("o_orderpriority").alias("phrase"), ((F.col("o_orderkey") % 7) / F.lit(10.0)).alias("p"), "o_orderkey")
    inner = d.filter(F.col("o_orderkey") % 2 == 0).select("seg", F.right("phrase", F.lit(3)).alias("phrase"), "p", (-F.col("o_orderkey")).alias("o_orderkey"))
    return parse.suppress_nested(d.unionByName(inner), "seg").withColumn("p", F.round("p", 3))


@query("names_in", with_(dv.SITES_SQL) + """SELECT site_id, regexp_extract(named_site_head, '^(.*), VP Operations$', 1) AS name, 'VP Operations' AS title_hint
  FROM sites WHERE s_suppkey % 6 >= 3""")
def names_in(t):
    return parse.names_in(dv.sites(t).select("site_id", "named_site_head"), "named_site_head").select("site_id", "name", "title_hint")


@query("heads_and_owners", with_(dv.SITES_SQL) + """SELECT site_id, CASE WHEN s_suppkey % 6 >= 3 THEN named_site_head ELSE '' END AS head,
  CASE WHEN s_suppkey % 6 >= 3 THEN regexp_extract(named_site_head, '^(.*), VP', 1) || ' - VP' ELSE '' END AS split_name FROM sites""")
def heads_and_owners(t):
    h = text.split_head(F.regexp_replace("named_site_head", ", VP Operations$", " – Head of – VP"))
    joined = F.when(text.head_text("named_site_head").isNotNull(), F.concat(h["name"], F.lit(" - "), F.regexp_replace(h["title"], "^Head of – ", "")))
    return dv.sites(t).select("site_id", F.coalesce(text.head_text("named_site_head"), F.lit("")).alias("head"), F.coalesce(joined, F.lit("")).alias("split_name"))


@query("lineage", """SELECT s_suppkey, 1990 + s_suppkey % 30 AS year, 'Old Co ' || s_suppkey AS acquired, 'all sites' AS note FROM supplier
  UNION ALL SELECT s_suppkey, 1980, 'First', '' FROM supplier WHERE s_suppkey % 2 = 0""")
def lineage(t):
    k = F.col("s_suppkey")
    one = F.concat(F.lit("Old Co "), k.cast("string"), F.lit(" ("), (1990 + k % 30).cast("string"), F.lit("): all sites"))
    cell = F.when(k % 2 == 0, F.concat(one, F.lit("; First (1980); junk"))).otherwise(one)
    return parse.lineage(t.supplier.select("s_suppkey", cell.alias("l")), "l").withColumn("year", F.col("year").cast("long"))


@query("regex_fields", """SELECT doc_id, 'Newtown, Ohio, United States' AS site_stated, strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INT), '%Y-%m-%d') AS posted_date FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, 'Oldtown, MA', strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INT), '%Y-%m-%d') FROM documents WHERE doc_id % 2 = 1""")
def regex_fields(t):
    """Whole documents behind a posting header of either style."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    title = F.concat(F.lit("Lead "), F.col("source"))
    a = F.concat(F.lit("Job Location Newtown, Ohio, United States Leeds, Kent, United Kingdom Job ID 9 Date Posted "), F.date_format(day, "dd/MM/yyyy"), F.lit(" "), F.col("text"))
    b = F.concat(title, F.lit(" Oldtown, MA Posted "), F.date_format(day, "yyyy-MM-dd"), F.lit(" "), F.col("text"))
    d = parse.regex_fields(t.documents.select("doc_id", F.when(F.col("doc_id") % 2 == 0, a).otherwise(b).alias("body"), title.alias("title")))
    return d.select("doc_id", "site_stated", F.col("posted_date").cast("string").alias("posted_date"))


@query("body_dates", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '2024-05-01' WHEN doc_id % 3 = 1 THEN '2020-01-01' ELSE '' END AS posted_date,
  CASE WHEN doc_id % 3 = 0 THEN 'body_posted_date' ELSE '' END AS source_kind FROM documents""")
def body_dates(t):
    k = F.col("doc_id") % 3
    d = t.documents.select("doc_id", F.concat(F.lit("posted: 2024-05-01 "), F.col("text")).alias("body"), F.when(k == 2, "tier2_archive_body").otherwise("tier3_live_body").alias("tier"),
                           F.when(k == 1, "2020-01-01").alias("posted_date"))
    out = parse.body_date(d)
    return out.select("doc_id", F.coalesce("posted_date", F.lit("")).alias("posted_date"), F.coalesce("posted_date_source", F.lit("")).alias("source_kind"))


@query("best_body", """WITH v AS (SELECT doc_id % 200 AS posting_id, CASE WHEN doc_id % 7 = 0 THEN 'api' WHEN doc_id % 7 < 3 THEN 'live' ELSE 'archive' END AS source, doc_id AS cap, n_chars AS len, length(text) AS chars FROM documents),
u AS (SELECT * FROM v WHERE chars >= 1500),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY CASE source WHEN 'api' THEN 0 WHEN 'live' THEN 1 ELSE 2 END, len DESC, cap) = 1)
SELECT k.posting_id, coalesce(b.source, '') AS source, coalesce(b.chars, 0) AS body_chars,
  CASE WHEN b.source IS NULL THEN 'tier1_shell' WHEN b.source = 'archive' THEN 'tier2_archive_body' ELSE 'tier3_live_body' END AS tier
FROM (SELECT DISTINCT posting_id FROM v) k LEFT JOIN b USING (posting_id)""")
def best_body(t):
    k = F.col("doc_id") % 7
    v = t.documents.select((F.col("doc_id") % 200).alias("posting_id"), F.when(k == 0, "api").when(k < 3, "live").otherwise("archive").alias("source"),
                           F.col("doc_id").alias("captured_at"), F.col("n_chars").alias("length"), "text")
    return parse.best_body(v).select("posting_id", "source", F.col("body_chars").cast("long").alias("body_chars"), "tier")


KW = [("and_word", r"\band\b"), ("the_word", r"\bthe\b")]


@query("negated_hits", rf"""WITH cut AS (SELECT doc_id, string_split(regexp_replace(text || ' sold and', '(?i)\b(and)\b', chr(1) || '\1' || chr(1), 'g'), chr(1)) AS l, text || ' sold and' AS t FROM documents),
p AS (SELECT doc_id, t, generate_subscripts(l, 1) AS i, unnest(l) AS part FROM cut),
k AS (SELECT doc_id, t, i, 1 + coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM p)
SELECT doc_id, CAST(s - 1 AS INT) AS pos, regexp_matches(substr(t, CAST(greatest(1, s - 80) AS BIGINT), CAST(s - greatest(1, s - 80) AS BIGINT)), '{cfg.NEGATION}') AS negated FROM k WHERE i % 2 = 0""")
def negated_hits(t):
    """Every place of a keyword in whole texts that end on a negated one, with its negation flag."""
    d = t.documents.select("doc_id", F.concat("text", F.lit(" sold and")).alias("text"))
    return parse.kw_hits(d, "doc_id", ["text"], KW[:1]).select("doc_id", "pos", "negated")


@query("keyword_hits", r"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\band\b')) AS k, 'and_word' AS label FROM documents
  UNION ALL SELECT doc_id, unnest(regexp_extract_all(lower(text), '\bthe\b')), 'the_word' FROM documents)
SELECT doc_id, label, count(*) AS n FROM h GROUP BY ALL""")
def keyword_hits(t):
    """Match counts over whole texts; `negated_hits` has the flags."""
    return parse.kw_hits(t.documents, "doc_id", ["text"], KW).groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n"))


STOP = "', '".join(cfg.STORY_STOPWORDS)


@query("word_sets", f"""SELECT conv_id, turn, len(list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9$]+'), lambda w: length(w) > 2 AND w NOT IN ('{STOP}')))) AS n_words FROM conversations""")
def word_sets(t):
    return t.conversations.select("conv_id", "turn", F.size(text.word_set("text")).cast("long").alias("n_words"))


# ---------------------------------------------------------------- person scrub
@query("scrub_names", "SELECT doc_id, md5(text || ' by [person], and Jo Ann Leely') AS scrubbed, true AS changed FROM documents")
def scrub_names(t):
    """Whole texts signed with the name of their source's editor; longer words that merely contain a name stay."""
    letters = F.translate(F.regexp_replace("source", "src", ""), "0123456789", "abcdefghij")
    name = F.concat(F.lit("Ann Lee"), letters, F.lit(" Vo"))
    d = t.documents.select("doc_id", F.concat(F.col("text"), F.lit(" by "), name, F.lit(", and Jo Ann Leely")).alias("text"))
    names = dedupe.roster(t.documents.select(name.alias("name")), t.documents.select(F.lit("Ann Lee").alias("name")))
    out = scrub.scrub(d, "doc_id", "text", names)
    return out.select("doc_id", F.md5("text_scrubbed").alias("scrubbed"), "changed")


@query("roster", """SELECT DISTINCT c_mktsegment || ' ' || n_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey UNION SELECT s_name || ' X' FROM supplier""")
def roster(t):
    a = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat_ws(" ", "c_mktsegment", "n_name").alias("n"))
    return dedupe.roster(a, t.supplier.select(F.concat("s_name", F.lit(" X")).alias("n")), t.customer.select("c_name"))


# ---------------------------------------------------------------- the verbatim gate
_LOW = "abcdefghijklmnopqrstuvwxyz"


def gate_quotes(t):
    """Eight quotes for each document, from the middle of it: as it stands, with an entity, with hard spaces, in capitals, two pieces of it with dots between, reworded, short; and
    one from the document before it."""
    at = F.floor(F.length("text") / 2).cast("int")
    piece = F.substr("text", at, F.lit(60))
    kind = lambda name, q, shift=0: F.struct(F.lit(name).alias("kind"), q.alias("q"), (F.col("doc_id") + shift).alias("posting_id"))
    kinds = F.array(kind("exact", piece), kind("entity", F.concat(F.lit("&quot;"), piece)), kind("spaces", F.replace(piece, F.lit(" "), F.lit("\u00a0"))), kind("upper", F.translate(piece, _LOW, _LOW.upper())),
                    kind("elided", F.concat(F.substr("text", at, F.lit(50)), F.lit(" … "), F.substr("text", at + 70, F.lit(50)))),
                    kind("reworded", F.concat(F.lit("zq "), piece)), kind("short", F.substr("text", at, F.lit(5))), kind("foreign", piece, 1))
    return t.documents.select(F.inline(kinds)).select("posting_id", "kind", F.col("q").alias("quote_text"))


def _soft_sql(c: str) -> str:
    out = f"replace({c}, '&quot;', '\"')"
    for k, v in cfg.LOOKALIKE.items():
        out = f"replace({out}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def _hard_sql(soft: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({soft})), '[^a-z0-9]+', ' ', 'g'))"


_AT = "CAST(floor(length(text) / 2) AS BIGINT)"
# Spark's substr from 0 starts at the first character, as from 1
_PIECE = f"substr(text, greatest({_AT}, 1), 60)"
GATE_SQL = rf"""asked AS (SELECT doc_id AS posting_id, unnest([{{'kind': 'exact', 'q': {_PIECE}}}, {{'kind': 'entity', 'q': '&quot;' || {_PIECE}}}, {{'kind': 'spaces', 'q': replace({_PIECE}, ' ', chr(160))}},
    {{'kind': 'upper', 'q': translate({_PIECE}, '{_LOW}', '{_LOW.upper()}')}}, {{'kind': 'elided', 'q': substr(text, greatest({_AT}, 1), 50) || ' … ' || substr(text, {_AT} + 70, 50)}}, {{'kind': 'reworded', 'q': 'zq ' || {_PIECE}}},
    {{'kind': 'short', 'q': substr(text, greatest({_AT}, 1), 5)}}], recursive := true) FROM documents UNION ALL SELECT doc_id + 1, 'foreign', {_PIECE} FROM documents),
trimmed AS (SELECT posting_id, kind, trim(q) AS q FROM asked),
body AS MATERIALIZED (SELECT doc_id, text, {_hard_sql('soft')} AS hard, soft FROM (SELECT doc_id, text, {_soft_sql('text')} AS soft FROM documents)),
forms AS (SELECT posting_id, kind, q, qs, {_hard_sql('qs')} AS qh, b.text, coalesce(length(b.text) > 0, false) AS has_body, b.soft, b.hard,
  list_filter(list_transform(regexp_split_to_array(qs, '\s*\.\.\.\s*'), lambda x: trim(regexp_replace(regexp_replace(lower(x), '[^a-z0-9 ]+', ' ', 'g'), '\s+', ' ', 'g'))), lambda x: length(x) > {cfg.MIN_FRAGMENT}) AS bits
  FROM (SELECT *, {_soft_sql('q')} AS qs FROM trimmed) LEFT JOIN body b ON b.doc_id = posting_id),
gated AS (SELECT posting_id, kind, has_body, CASE WHEN q = '' OR NOT has_body THEN 'empty' WHEN length(q) < {cfg.MIN_QUOTE} THEN 'too_short' WHEN contains(text, q) THEN 'exact' WHEN qs <> '' AND contains(soft, qs) THEN 'soft'
  WHEN qh <> '' AND contains(hard, qh) THEN 'hard' WHEN len(bits) > 1 AND list_bool_and(list_transform(bits, lambda x: contains(hard, x))) THEN 'elided' ELSE 'not_found' END AS match_method FROM forms)"""
VERIFIED_SQL = "match_method IN ('exact', 'soft', 'hard', 'elided')"


def gate_bodies(t):
    return t.documents.select(F.col("doc_id").alias("posting_id"), "text")


@query("verbatim_gate", with_(GATE_SQL) + f"SELECT posting_id, kind, match_method, {VERIFIED_SQL} AS verbatim_verified FROM gated")
def verbatim_gate(t):
    return claims.verify_quotes(gate_quotes(t), gate_bodies(t)).select("posting_id", "kind", "match_method", "verbatim_verified")


@query("verbatim_exact", """SELECT doc_id AS posting_id, trim(substr(text, greatest(length(text) // 2, 1), 60)) AS q, CASE WHEN trim(substr(text, greatest(length(text) // 2, 1), 60)) = '' THEN 'empty'
  WHEN length(trim(substr(text, greatest(length(text) // 2, 1), 60))) < 12 THEN 'too_short' ELSE 'exact' END AS match_method FROM documents""")
def verbatim_exact(t):
    n = F.greatest(F.floor(F.length("text") / 2).cast("int"), F.lit(1))
    q = t.documents.select(F.col("doc_id").alias("posting_id"), F.substr("text", n, F.lit(60)).alias("quote_text"))
    out = claims.verify_quotes(q, t.documents.select(F.col("doc_id").alias("posting_id"), "text"))
    return out.select("posting_id", F.trim("quote_text").alias("q"), "match_method")


@query("corpus_quotes", "SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def corpus_quotes(t):
    """Every benchmark text that is an exact substring of any document."""
    return claims.find_quotes(t.benchmark, t.documents, "item_id", "doc_id")


@query("gate_stats", with_(GATE_SQL) + f"""SELECT match_method, count(*) AS n, round(100e0 * (SELECT count(*) FROM gated WHERE {VERIFIED_SQL}) / (SELECT count(*) FROM gated), 6) AS pass_rate FROM gated GROUP BY 1""")
def gate_stats(t):
    out = claims.verify_quotes(gate_quotes(t), gate_bodies(t))
    return tallies.gate_stats(out).select("match_method", "n", F.round("pass_rate", 6).alias("pass_rate"))


@query("quarantine", with_(GATE_SQL) + f"""SELECT posting_id, kind, CASE WHEN NOT has_body THEN 'no cached body to check against' ELSE match_method END AS reason FROM gated WHERE NOT {VERIFIED_SQL}""")
def quarantine(t):
    return claims.quarantine(claims.verify_quotes(gate_quotes(t), gate_bodies(t))).select("posting_id", "kind", "reason")


@query("web_excerpts", """SELECT page_id, page_id % 3 <> 2 AS excerpt_ok FROM pages""")
def web_excerpts(t):
    """Page bodies against excerpts of them; every third excerpt is altered."""
    body = text.html_to_text("html")
    pages = t.pages.select(F.col("page_id").cast("string").alias("url"), "page_id", body.alias("page_text"))
    said = F.when(F.col("page_id") % 3 == 2, F.concat(F.lit("zqx "), F.col("page_text"))).otherwise(F.col("page_text"))
    out = claims.verify_excerpts(pages.select("url", "page_id", said.alias("excerpt")), pages.select("url", "page_text"))
    return out.select("page_id", "excerpt_ok")


@query("claim_backing", """WITH q AS (SELECT conv_id, role, text, turn FROM conversations), c AS (SELECT conv_id, turn, role, split_part(trim(text), ' ', 1) AS subject FROM conversations)
SELECT conv_id, turn FROM c WHERE EXISTS (SELECT 1 FROM q WHERE q.conv_id = c.conv_id AND q.role = c.role AND q.turn % 2 = 0 AND length(c.subject) >= 3 AND contains(lower(q.text), lower(c.subject)))""")
def claim_backing(t):
    """Each turn claims its first word; the even turns of the same speaker are the verified quotes."""
    c = t.conversations.select(F.col("conv_id").alias("posting_id"), F.col("role").alias("claim_type"), F.split_part(F.trim("text"), F.lit(" "), F.lit(1)).alias("subject"), "turn")
    q = t.conversations.select(F.col("conv_id").alias("posting_id"), F.col("role").alias("claim_type"), F.lit("none of these").alias("subject"),
                               F.col("text").alias("quote_text"), (F.col("turn") % 2 == 0).alias("verbatim_verified"))
    return claims.backed(c, q).select(F.col("posting_id").alias("conv_id"), "turn")


@query("boilerplate_parents", """SELECT p_partkey FROM part WHERE p_partkey % 5 NOT IN (0, 1, 2)""")
def boilerplate_parents(t):
    k = F.col("p_partkey")
    parent = (F.when(k % 5 == 0, F.concat(F.col("p_brand"), F.lit(" Group"))).when(k % 5 == 1, "the Organization").when(k % 5 == 2, "IT")
              .otherwise(F.concat(F.col("p_name"), F.lit(" operations"))))
    d = t.part.select("p_partkey", parent.alias("parent_org"))
    return drop_boilerplate(d, t.part.select(F.concat(F.lit("The "), F.col("p_brand")).alias("company")).unionByName(t.part.select(F.concat("p_brand", F.lit(" Group")).alias("company")))).select("p_partkey")

