"""Masking of names by one pass over a text."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from attesta.operators import scrub


def one_by_one(text: str, names: list[str], whole_word: bool) -> str:
    for n in sorted(set(names), key=lambda n: (-len(n), n)):
        text = re.sub((r"\b%s\b" if whole_word else "%s") % re.escape(n), "[person]", text)
    return text


@pytest.mark.parametrize("whole_word", [True, False])
def test_one_pass_equals_one_name_at_a_time(whole_word):
    rng = random.Random(1)
    words = ["Jo", "Ann", "Lee", "Li", "José", "O'Neil", "Bo", "and", "x"]
    for _ in range(3000):
        names = [" ".join(rng.choice(words[:7]) for _ in range(rng.randint(2, 3))) for _ in range(rng.randint(0, 6))]
        text = "".join(rng.choice(words) + rng.choice((" ", " ", " ", ", ", "-", "")) for _ in range(rng.randint(0, 25)))
        assert scrub.mask_names(text, names, whole_word, "[person]") == one_by_one(text, names, whole_word), (text, names)


def test_white_space_in_texts_counts_as_one_space(spark):
    assert scrub.mask_names("by  Jo \n Ann\tLee and  others", ["Jo Ann Lee"], True, "[person]") == "by  [person] and  others"
    d = spark.createDataFrame([(1, "by Jo  Ann\nLee."), (2, "by Jo Annie"), (3, None), (4, "")], "id int, t string")
    got = {r["id"]: (r["t_scrubbed"], r["changed"]) for r in scrub.scrub(d, "id", "t", spark.createDataFrame([("Jo   Ann Lee",), ("Jo Ann",), ("",), (None,)], "name string")).collect()}
    assert got == {1: ("by [person].", True), 2: ("by Jo Annie", False), 3: (None, None), 4: ("", False)}


def test_a_text_of_ten_thousand_names(spark):
    names = spark.range(10_000).select(F.concat(F.lit("Ada"), F.col("id"), F.lit(" Byron"), F.col("id")).alias("name"))
    text = names.agg(F.concat_ws(", ", F.collect_list("name")).alias("t")).withColumn("id", F.lit(1))
    r = scrub.scrub(text, "id", "t", names).first()
    assert r["t_scrubbed"] == ", ".join(["[person]"] * 10_000) and r["changed"]
