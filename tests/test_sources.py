from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from attesta.operators.claims import GateFailed
from attesta.sources import exports, feeds, spine, tables


def test_read_spine_files(spark, tmp_path):
    (tmp_path / "us.csv").write_text('﻿Site map,,,\n\nAccount,Site,City,Verdict\nAcme,"Plant, big\nnew",Town,KEEP\n,,,\nKeep,legend,,\nAcme,,Town,\n'
                                     'Bio,Lab,City,Flag: R&D\nMethod notes,x,,\nLate,Row,,KEEP\n', encoding="utf-8")
    got = spine.read_spine(spark, str(tmp_path / "us.csv")).select("account", "site", spine.spine_fit().alias("fit")).collect()
    assert sorted((r["account"], r["site"], r["fit"]) for r in got) == [("Acme", "Plant, big\nnew", "yes"), ("Bio", "Lab", "soft")]


def test_wide_sheet_keeps_its_columns(spark, tmp_path):
    wide = lambda a, s: ",".join(["x"] * 70 + [a, s])
    (tmp_path / "wide.csv").write_text("\n".join([wide("Account", "Site"), wide("Acme", "Plant")]))
    assert [(r["account"], r["site"]) for r in spine.read_spine(spark, str(tmp_path / "wide.csv")).collect()] == [("Acme", "Plant")]


def test_read_accounts(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("﻿Company,Exclude,HQ\nAcme Bio,x,Basel\nNova,,\n,,\n", encoding="utf-8")
    got = {r["account_id"]: (r["active"], r["hq"]) for r in spine.read_accounts(spark, str(p)).collect()}
    assert got == {"acme-bio": (False, "Basel"), "nova": (True, None)}


def test_tables_round_trip_and_guard(spark, tmp_path):
    path = str(tmp_path / "people")
    assert tables.load(spark, path, "people").count() == 0
    d = spark.createDataFrame([("p1", "a", "Ann", "extra")], "person_id string, account_id string, name string, junk string")
    tables.save(d, path, "people")
    row = tables.load(spark, path, "people").first()
    assert row["name"] == "Ann" and row["site_id"] is None and "junk" not in row.asDict()
    quotes = spark.range(100).select(F.col("id").cast("string").alias("quote_id"))
    with pytest.raises(GateFailed):
        tables.save(quotes.limit(50), str(tmp_path / "q"), "quotes", previous=quotes)


def test_csv_exchange(spark, tmp_path):
    d = spark.createDataFrame([("s1", ["A B", "C D"])], "signal_id string, named_people array<string>")
    out = tables.to_text(tables.conform(d, tables.schema_of("signals")))
    assert out.first()["named_people"] == "A B|C D" and out.first()["title"] == ""
    out.write.option("header", True).csv(str(tmp_path / "csv"))
    back = tables.load_csv(spark, str(tmp_path / "csv"), "signals").first()
    assert back["named_people"] == ["A B", "C D"] and back["title"] is None
    flags = spark.createDataFrame([("True",), ("false",), ("",)], "b string").select(tables.from_text("b", tables.schema_of("accounts")["active"].dataType).alias("b"))
    assert [r["b"] for r in flags.collect()] == [True, False, None]


def test_run_ledger(spark, tmp_path):
    path = str(tmp_path / "runs")
    d, seen = tables.counted(spark.range(10), "c", n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    d.write.format("noop").mode("overwrite").save()
    tables.log_run(spark, path, {"run_id": "r1", "kind": "index", "urls_seen": seen.get["n"], "new_urls": seen.get["odd"], "started_at": dt.datetime(2024, 1, 1)})
    tables.log_run(spark, path, {"run_id": "r2"})
    assert sorted((r["run_id"], r["urls_seen"], r["new_urls"]) for r in tables.load(spark, path, "runs").collect()) == [("r1", 10, 5), ("r2", None, None)]


def test_feed_files(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>Plant opens - Daily</title><link>https://n/1</link><source url='u'>Daily</source><pubDate>Tue, 07 Oct 2025 07:00:00 GMT</pubDate>"
                                    "<description>&lt;a href='x'&gt;Plant&lt;/a&gt;&amp;nbsp;opens</description></item><item><title>No link</title></item></channel></rss>")
    bad = spark.createDataFrame([("<item><title>x</item>",), ("<item><title>T - S</title><link>l</link><source>S</source></item>",)], "item_xml string")
    got = feeds.parse_feed(bad).collect()
    assert [(r["title"], r["source"], r["published"]) for r in got] == [("T", "S", None)]


def test_extract_payloads_decode_once(spark):
    d = spark.createDataFrame([('{"result":{"postings":[{"posting_id":"p","team_name":"R&amp;amp;D &quot;X&quot;"}]}}',), ('{"postings":[{"posting_id":"q"}]}',), ("broken &amp;",)], "payload string")
    got = {r["posting_id"]: r["team_name"] for r in feeds.parse_extracts(d).collect()}
    assert got == {"p": 'R&amp;D "X"', "q": None}


def test_bodies_and_export(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a--jr-1.txt").write_text("line one\nline two")
    assert feeds.read_bodies(spark, str(tmp_path / "b")).collect()[0].asDict() == {"posting_id": "a--jr-1", "text": "line one\nline two"}
    index = spark.createDataFrame([("a", "p1", 5), ("a", "p2", 9), ("b", "p3", 1)], "shown_account string, posting_id string, score int")
    exports.write_jobs_index(index, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 3


def test_bodies_are_written_by_many_tasks(spark, tmp_path):
    """Small rows that make many files are not left to one task."""
    import re

    import __spark_entry__ as entry
    spark.range(40).selectExpr("id AS s_suppkey", "concat('Supplier ', id) AS s_name", "cast(id % 5 AS int) AS s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    out = entry.queries()["bodies_from_files"](spark, str(tmp_path))
    assert len({re.search(r"/part-(\d+)", f)[1] for f in out.inputFiles()}) > 1
    assert {tuple(r) for r in out.collect()} == {(f"Supplier {i}", f"Supplier {i}\nfrom nation {i % 5}\n") for i in range(40)}
