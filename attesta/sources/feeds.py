"""Landed files of external feeds: URL index rows, API pages, RSS, extracts, enrichment, bodies. Nothing is fetched here."""

from __future__ import annotations

import html
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta import config as cfg
from attesta.functions.dates import feed_date, rel_date
from attesta.functions.ids import item_id
from attesta.functions.places import city_of
from attesta.functions.text import ckey, strip_markup

API_PAGE = ("struct<jobPostings:array<struct<title:string,externalPath:string,locationsText:string,postedOn:string,"
            "bulletFields:array<string>>>>")
FEED_ITEM = "link string, title string, source string, pubDate string, description string"
EXTRACT = ("struct<posting_id:string,team_name:string,team_acronym:string,parent_org:string,reports_to_title:string,"
           "hiring_manager:string,site_stated:string,posted_date:string,autonomy_flag:string,acquisition_flag:string,"
           "supports_teams:array<struct<team:string,verbatim:string>>,tech_stack:array<struct<tool:string,verbatim:string>>,"
           "vocabulary:array<string>,quotes:array<struct<claim_type:string,subject:string,quote_text:string>>,notes:string>")
PAYLOAD = f"struct<result:struct<postings:array<{EXTRACT}>>,postings:array<{EXTRACT}>>"
ITEM = ("struct<title:string,url:string,date:string,year:string,topic:string,matched_city:string,confidence:string,source:string,"
        "signal_type:string,authors_named:array<string>,named_people:array<string>>")
ENRICHMENT = (f"struct<pilot:struct<account_id:string,news:struct<signals:array<{ITEM}>>,conference:struct<signals:array<{ITEM}>>,"
              f"publications:struct<publications:array<{ITEM}>>>,"
              f"publications_by_account:array<struct<account_id:string,publications:array<{ITEM}>>>>")


def sightings_from_index(df: DataFrame, since: str = "20240101") -> DataFrame:
    """(account_id, url, seen_at) from index rows (account_id, url, timestamp yyyymmddhhmmss): http only, from `since`,
    one row per url key (the url without scheme, www, fragment and trailing slash, lower case), the earliest capture."""
    key = F.lower(F.regexp_replace(F.regexp_replace("url", r"(?i)^https?://(www\.)?", ""), r"(#.*|/+)$", ""))
    ok = F.startswith("url", F.lit("http")) & (F.col("timestamp") >= since)
    d = df.filter(ok).groupBy("account_id", key.alias("urlkey")).agg(
        F.min(F.struct("timestamp", "url")).alias("_f"))
    return d.select("account_id", "urlkey", F.col("_f.url").alias("url"),
                    F.try_to_timestamp(F.col("_f.timestamp"), F.lit("yyyyMMddHHmmss")).alias("seen_at"))


def postings_from_api(df: DataFrame, as_of, payload: str = "payload") -> DataFrame:
    """Postings of API pages (account_id, payload JSON). The first bullet shaped like a request id is the request id;
    relative posting dates count back from `as_of`."""
    pages = df.select("account_id", F.explode(F.from_json(payload, API_PAGE)["jobPostings"]).alias("p"))
    req = F.get(F.filter("p.bulletFields", lambda b: b.rlike(cfg.REQ_ID)), F.lit(0))
    d = pages.select(
        "account_id", F.col("p.title").alias("role_title"), F.col("p.externalPath").alias("path"),
        F.coalesce(req, F.lit("")).alias("req_id"), city_of("p.locationsText").alias("city_raw"),
        F.trim(F.regexp_replace(F.lower(F.coalesce("p.title", F.lit(""))), "[^a-z0-9]+", "-"), F.lit("-")).alias("role_slug"),
        rel_date("p.postedOn", as_of).alias("_d"))
    return d.withColumn("city_slug", ckey(F.split_part(F.coalesce("city_raw", F.lit("")), F.lit(","), F.lit(1)))).select(
        "*", F.col("_d.date").alias("posted_date"), F.col("_d.kind").alias("posted_date_source")).drop("_d")


def parse_feed(df: DataFrame, xml: str = "item_xml", snippet: int | None = None) -> DataFrame:
    """The fields of RSS <item> texts: the source suffix comes off the title, the date is ISO, the description is plain text
    (of at most `snippet` characters, if given). Malformed XML or no link drops the row."""
    item = F.from_xml(F.col(xml), FEED_ITEM, {"mode": "PERMISSIVE", "rowTag": "item"})
    d = df.withColumn("_i", item)
    link, source = F.trim("_i.link"), F.trim(F.coalesce("_i.source", F.lit("")))
    d = d.filter(F.coalesce(link, F.lit("")) != "")
    title, plain = strip_markup("_i.title"), strip_markup("_i.description")
    suffix = F.concat(F.lit(" - "), source)
    title = F.when((source != "") & F.endswith(title, suffix), F.left(title, F.length(title) - F.length(suffix))).otherwise(title)
    keep = [c for c in df.columns if c != xml]
    return d.select(*keep, item_id(link).alias("item_id"), title.alias("title"), source.alias("source"), link.alias("url"),
                    feed_date("_i.pubDate").alias("published"), (F.substring(plain, 1, snippet) if snippet else plain).alias("snippet"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """S7 over feed files: one row per <item>, malformed files dropped."""
    raw = spark.read.format("xml").schema(FEED_ITEM).option("rowTag", "item").option("mode", "DROPMALFORMED").load(path)
    return parse_feed(raw.select(F.to_xml(F.struct("*"), {"rowTag": "item"}).alias("item_xml")))


def _decode(value):
    """Entities decoded once on every string leaf of a JSON value."""
    if isinstance(value, str):
        return html.unescape(value)
    if isinstance(value, list):
        return [_decode(v) for v in value]
    if isinstance(value, dict):
        return {k: _decode(v) for k, v in value.items()}
    return value


def _decode_payload(text):
    if text is None or "&" not in text:
        return text
    try:
        return json.dumps(_decode(json.loads(text)), ensure_ascii=False)
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def decode_leaves(s: pd.Series) -> pd.Series:
    return s.map(_decode_payload)


def parse_extracts(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per extracted posting of `{result: {postings}}` or `{postings}` payloads, entities decoded once on every
    string leaf."""
    keep = [c for c in df.columns if c != payload]
    d = df.select(*keep, decode_leaves(payload).alias("_json")).withColumn("_p", F.from_json("_json", PAYLOAD))
    return d.select(*keep, F.explode(F.coalesce("_p.result.postings", "_p.postings")).alias("e")).select(*keep, "e.*")


def read_extracts(spark: SparkSession, path: str) -> DataFrame:
    """S8 over JSON files, one payload per file."""
    return parse_extracts(spark.read.text(path, wholetext=True).select(F.col("value").alias("payload")))


def parse_enrichment(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Signal rows (account_id, signal_type, title, url, date, topic, people, …) of enrichment payloads: the pilot groups and
    the per-account publications."""
    p = F.from_json(payload, ENRICHMENT)
    base = df.select(*[c for c in df.columns if c != payload], p.alias("p"))
    keep = [c for c in base.columns if c != "p"]

    def rows(account, items, kind):
        return base.select(*keep, account.alias("account_id"), F.posexplode(items).alias("pos", "i"), kind.alias("kind"))

    pilot = F.col("p.pilot.account_id")
    parts = [rows(pilot, F.col("p.pilot.news.signals"), F.lit("program_news")),
             rows(pilot, F.col("p.pilot.conference.signals"), F.lit("conference_talk")),
             rows(pilot, F.col("p.pilot.publications.publications"), F.lit("publication"))]
    blocks = base.select(*keep, F.explode("p.publications_by_account").alias("b"))
    parts.append(blocks.select(*keep, F.col("b.account_id").alias("account_id"), F.posexplode("b.publications").alias("pos", "i"),
                               F.lit("publication").alias("kind")))
    d = parts[0]
    for x in parts[1:]:
        d = d.unionByName(x)
    kind = F.when(F.col("kind") == "program_news", F.coalesce("i.signal_type", "kind")).otherwise(F.col("kind"))
    return d.select(*keep, "account_id", kind.alias("signal_type"), "pos", "i.title", "i.url",
                    F.coalesce("i.date", "i.year").alias("date"), "i.topic", "i.confidence", "i.source", "i.matched_city",
                    F.coalesce("i.named_people", "i.authors_named", F.array().cast("array<string>")).alias("named_people"))


def read_enrichment(spark: SparkSession, path: str) -> DataFrame:
    """S9 over JSON files."""
    return parse_enrichment(spark.read.text(path, wholetext=True).select(F.col("value").alias("payload")))


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """(posting_id, text) from one text file per posting: `<posting_id>.txt`, or a file in a folder `posting_id=<posting_id>`."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("_f", F.input_file_name())
    part = F.regexp_extract("_f", r"posting_id=([^/]+)/[^/]+$", 1)  # names of partitions are escaped once more
    name = F.when(part != "", F.try_url_decode(F.try_url_decode(part))).otherwise(F.try_url_decode(F.regexp_extract("_f", r"([^/]+)\.txt$", 1)))
    return raw.select(name.alias("posting_id"), F.col("value").alias("text"))
