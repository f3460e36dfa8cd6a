"""Reading of large spreadsheets in parts equals one reader of the whole file."""

from __future__ import annotations

import csv
import io
import random

import pytest

from attesta.sources import cells


def whole(text: str) -> list[list[str]]:
    return [[c.strip().replace("﻿", "") for c in row] for row in csv.reader(io.StringIO(text.lstrip("﻿"), newline=""))]


def sheet(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = ["a", "é😀", "x" * 40, '"', '""', ",", "\n", "\r\n", "\r", '"q, ""w""\nline', '"closed"', '5" pipe', "", " ", '"multi\n\n\nline\r\nend"', '"a"b"c']
    return "".join(rng.choice(parts) for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
def test_states_and_blocks_equal_one_reader(seed):
    """Any cut of a text into ranges of lines."""
    rng = random.Random(seed)
    for k in range(150):
        text = sheet(seed * 1000 + k, rng.randint(0, 40))
        lines = text.split("\n")
        lines = lines[:-1] if lines[-1] == "" else lines
        cuts = sorted({0, *(rng.randrange(len(lines) + 1) for _ in range(3))}) if lines else []
        rows, held, inside = [], [], False
        for a, b in zip(cuts, [*cuts[1:], len(lines)]):
            block = cells._Block("f", a, inside)
            out = [r for line in lines[a:b] for r in block.add(line)] + list(block.end())
            for _, _, part, _, row, piece in out:
                if part == cells.BODY:
                    if held:
                        rows += cells._parsed("\n".join(held))
                        held = []
                    rows.append(row)
                elif part == cells.TAIL:
                    rows += cells._parsed("\n".join(held)) if held else []
                    held = [piece]
                else:
                    held.append(piece)
            for line in lines[a:b]:
                inside = cells.ends_inside(line, inside)
        rows += cells._parsed("\n".join(held)) if held else []
        assert rows == whole(text), repr(text)


def test_a_file_in_many_ranges(spark, tmp_path):
    texts = {"one.csv": "﻿h1,h2\n" + "".join(f'{i},"cell {i}\nsecond ""line"", {i}"\r\n' if i % 3 else f"{i},plain\n" for i in range(400)), "two.csv": "a,b\n\n1,2\n", "long.csv": 'x,"' + "inside\n" * 900 + '",y\nz\n', "open.csv": 'p,q\nr,"never closed\n1\n2\n'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        assert cells._lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 8
        rows = cells.read_cells(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name, text in texts.items():
        own = sorted((r["row_no"], r["cells"]) for r in rows if r["file"].endswith(name))
        assert [n for n, _ in own] == list(range(len(own))) and [c for _, c in own] == whole(text), name
