"""Spreadsheet exports as rows of cells, a large file read by many tasks although quoted cells may hold line ends."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attesta.operators.parse import in_blocks
from attesta.session import land

#: Lines that are given to the reader of cells together.
LINES = 20_000


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open behind a line, given whether one is before it: a quote opens a cell at its begin only, two quotes inside one are a quote, and elsewhere quotes are characters."""
    at, n = 0, len(line)
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1:at + 2] == '"':
                at += 2
                continue
            inside, at = False, at + 1
        elif at < n and line[at] == '"':
            inside, at = True, at + 1
            continue
        while at < n and line[at] not in ",\r":  # the rest of a cell without quotes
            cuts = [c for c in (line.find(",", at), line.find("\r", at)) if c >= 0]
            at = min(cuts) if cuts else n
        if at >= n:
            return False
        at += 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (the byte its part of the file starts at), value: the lines, in order inside a block. Spark deals the byte ranges of a file to tasks."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block: whether a cell is open behind it, if none or if one is open before it."""
    now, states = None, (False, True)
    for pdf in batches:
        for file, block, line in zip(pdf["file"], pdf["block"], pdf["value"]):
            if (file, block) != now:
                if now:
                    yield pd.DataFrame([(*now, *states)], columns=["file", "block", "if_out", "if_in"])
                now, states = (file, block), (False, True)
            if '"' in line:
                states = tuple(ends_inside(line, s) for s in states)
    if now:
        yield pd.DataFrame([(*now, *states)], columns=["file", "block", "if_out", "if_in"])


#: Parts of a block: HEAD ends a row that an earlier block began, BODY holds whole rows, TAIL begins one that a later block ends.
HEAD, BODY, TAIL = 0, 1, 2
_PIECES = "file string, block long, part int, at long, cells array<string>, text string"


def _parsed(text: str) -> list[list[str]]:
    csv.field_size_limit(1 << 30)
    return [[c.strip().replace("\ufeff", "") for c in row] for row in csv.reader(io.StringIO(text, newline=""))]


class _Block:
    """The lines of a byte range so far, given whether a cell is open before it."""

    def __init__(self, file: str, block: int, inside: bool):
        self.key, self.inside, self.in_head, self.head = (file, block), inside, inside, []
        self.held: list[str] = []
        self.opened = self.at = 0  # the line of `held` at which the last row began; rows given so far

    def _whole(self, lines: list[str]) -> Iterator[tuple]:
        rows = _parsed("\n".join(lines) + "\n") if lines else []
        for k, cells in enumerate(rows):
            yield (*self.key, BODY, self.at + k, cells, None)
        self.at += len(rows)

    def add(self, line: str) -> Iterator[tuple]:
        if not self.inside:
            self.opened = len(self.held)
        (self.head if self.in_head else self.held).append(line)
        if self.inside or '"' in line:
            self.inside = ends_inside(line, self.inside)
        self.in_head = self.in_head and self.inside
        if len(self.held) >= LINES and not self.inside:
            yield from self._whole(self.held)
            self.held = []

    def end(self) -> Iterator[tuple]:
        if self.head:
            yield (*self.key, HEAD, 0, None, "\n".join(self.head))
        is_open = self.inside and not self.in_head
        yield from self._whole(self.held[:self.opened] if is_open else self.held)
        if is_open:
            yield (*self.key, TAIL, 0, None, "\n".join(self.held[self.opened:]))


def _rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows that lie in one block, and the open ends of others. Lines come with the state before their block."""
    def pieces() -> Iterator[tuple]:
        own = None
        for pdf in batches:
            for file, block, line, inside in zip(pdf["file"], pdf["block"], pdf["value"], pdf["inside"]):
                if own is None or own.key != (file, block):
                    if own:
                        yield from own.end()
                    own = _Block(file, block, bool(inside))
                    line = line.lstrip("\ufeff") if block == 0 else line
                yield from own.add(line)
        if own:
            yield from own.end()
    yield from in_blocks(pieces(), [c.split()[0] for c in _PIECES.split(", ")])


def _put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["file", "block", "part", "at", "cells"]
    yield from in_blocks(((file, block, TAIL, k, cells) for pdf in batches for file, block, text in zip(pdf["file"], pdf["block"], pdf["text"]) for k, cells in enumerate(_parsed(text))), names)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Spreadsheet exports as (file, row_no, cells), with as many cells as each row has, numbered from 0 in each file.

    A first pass finds for each byte range of a file what its lines do to an open quoted cell; a prefix over the ranges, of which a file has few, gives each the state before it; a second pass reads the rows. A row over several ranges
    is put together from its pieces. So the ranges of one file are read by many tasks, and the rows are those that one reader of the whole file gives.
    """
    lines = _lines(spark, path)
    blocks = land(lines.mapInPandas(_states, "file string, block long, if_out boolean, if_in boolean"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    moves = F.collect_list(F.struct("if_out", "if_in")).over(before)
    state = F.aggregate(moves, F.lit(False), lambda s, m: F.when(s, m["if_in"]).otherwise(m["if_out"]))
    known = blocks.select("file", "block", state.alias("inside"))
    pieces = land(lines.join(F.broadcast(known), ["file", "block"]).select("file", "block", "value", "inside").mapInPandas(_rows_of, _PIECES))
    # a tail and the heads behind it, up to the one that closes, are one row
    ends = pieces.filter(F.col("part") != BODY)
    order = Window.partitionBy("file").orderBy("block", "part")
    number = F.sum(F.when(F.col("part") == TAIL, 1).otherwise(0)).over(order)
    texts = ends.select("file", "block", "part", "text", number.alias("n")).groupBy("file", "n").agg(F.min("block").alias("block"), F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("t"))
    joined = texts.select("file", "block", F.array_join(F.col("t.text"), "\n").alias("text"))
    stitched = joined.mapInPandas(_put_together, "file string, block long, part int, at long, cells array<string>")  # a row for each range of a file at most
    every = pieces.filter(F.col("part") == BODY).select("file", "block", "part", "at", "cells").unionByName(stitched)
    sizes = every.groupBy("file", "block", "part").agg(F.count(F.lit(1)).alias("n"))
    shift = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("file", "block", "part", shift.alias("shift"))
    return every.join(F.broadcast(shifts), ["file", "block", "part"]).select("file", (F.col("at") + F.col("shift")).alias("row_no"), "cells")
