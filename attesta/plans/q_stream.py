"""Streaming queries: the same answers as their batch forms, from file streams over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from attesta.functions.dates import quarter
from attesta.plans.base import query
from attesta.plans.derive import with_
from attesta.plans.q_text import GATE_SQL, gate_bodies, gate_quotes
from attesta.plans.q_corpus import ACCRETED, FACTS_SQL, SHARE_SQL, SIGHTINGS_SQL, show_accreted, show_mix
from attesta.session import scratch
from attesta.streaming import mixes, streams


def places(t) -> tuple[str, str]:
    """A fresh sink and checkpoint folder in the shared folder."""
    base = f"{scratch(t.spark)}/streams/{uuid.uuid4().hex}"
    return base + "/out", base + "/checkpoint"


def events(t):
    d = streams.read_files(t.spark, t.folder, "events", t.events.schema)
    return d.select(F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("posting_id"), F.date_format("ts", "yyyyMMdd").alias("run_id"),
                    F.col("ts").alias("seen_at"), F.concat(F.lit("a"), (F.col("user_id") % 20).cast("string")).alias("account_id"), "value")


@query("accrete_stream", ACCRETED)
def accrete_stream(t):
    return show_accreted(streams.accrete_stream(events(t), "posting_id", *places(t)))


@query("once_per_run", with_(SIGHTINGS_SQL) + "SELECT posting_id, count(DISTINCT run) AS n_runs FROM sightings GROUP BY 1")
def once_per_run(t):
    landed = streams.once_per_run(events(t), "posting_id", *places(t))
    return landed.groupBy("posting_id").agg(F.count(F.lit(1)).alias("n_runs"))


@query("mix_counts_stream", with_(FACTS_SQL) + "SELECT account_id, period, dim_key, count(*) AS n FROM facts GROUP BY ALL")
def mix_counts_stream(t):
    orders = streams.read_files(t.spark, t.folder, "orders", t.orders.schema)
    d = orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    d = d.select(F.col("n_name").alias("account_id"), quarter("o_orderdate").alias("period"), F.col("o_orderpriority").alias("dim_key"), "o_orderkey")
    by = ["account_id", "period", "dim_key"]
    out, checkpoint = places(t)
    streams.mix_counts_stream(d, by, out, checkpoint)
    return streams.mix_counts(d, out, by)


@query("mix_shares_stream", SHARE_SQL)
def mix_shares_stream(t):
    """A1 from the state that a stream of orders leaves."""
    orders = streams.read_files(t.spark, t.folder, "orders", t.orders.schema)
    d = orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    d = d.select(F.col("n_name").alias("account"), quarter("o_orderdate").alias("period"), F.col("o_orderpriority").alias("family"))
    out, checkpoint = places(t)
    mixes.mix_shares_stream(d, "account", "period", "family", out, checkpoint)
    return show_mix(mixes.mix_shares(t.spark, out, burst=1.5))


@query("verify_stream", with_(GATE_SQL) + "SELECT posting_id, kind, match_method FROM gated")
def verify_stream(t):
    """The quotes of the batch gate, as they land."""
    class Landing:
        documents = streams.read_files(t.spark, t.folder, "documents", t.documents.schema)
    bodies = gate_bodies(t)
    landed = streams.run_available(streams.verify_stream(gate_quotes(Landing), bodies), *places(t))
    return streams.settle(landed, bodies).select("posting_id", "kind", "match_method")


@query("dedupe_news_stream", "SELECT DISTINCT 'a' || (user_id % 20) AS account_id, sha1(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) AS item_id FROM events")
def dedupe_news_stream(t):
    d = events(t).select("account_id", F.sha1(F.floor("value").cast("string")).alias("item_id"), F.col("seen_at").cast("timestamp").alias("published"))
    return streams.dedupe_news_stream(d, *places(t)).select("account_id", "item_id")
