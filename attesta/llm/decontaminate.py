"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every window of the training texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A

#: Windows of one broadcast hash set. A larger benchmark is scanned in so many sets.
MAX_WINDOWS = 2_000_000
#: Bits of the table that is asked before the sorted set.
TABLE_BITS = 22
FOUND = "doc_id long, text string, n_words long, hits array<long>, items array<string>"


def benchmark_windows(items: list[tuple[str, str]], width: int) -> list[tuple[int, int, list[bytes], str]]:
    """(hash, words, the words, item) of every window; an item of fewer words than `width` is one window."""
    texts = pa.array([t for _, t in items], pa.string())
    data, offsets = A.buffers(A.as_texts(texts))
    data = A.LOWER[data]
    starts, ends, first = A.words_of(data, offsets, A.ALNUM)
    hashes, out = A.word_hashes(data, starts, ends), []
    raw = data.tobytes()
    for k, (item, _) in enumerate(items):
        n = int(first[k + 1] - first[k])
        w = min(width, n)
        if not w:
            continue
        lo = int(first[k])
        words = [raw[s:e] for s, e in zip(starts[lo:lo + n], ends[lo:lo + n], strict=True)]
        out += [(int(h), w, words[i:i + w], item) for i, h in enumerate(A.window_hashes(hashes[lo:lo + n], w))]
    return out


class HashSet:
    """The windows of one length: sorted hashes behind a bit table, and what each stands for."""

    def __init__(self, windows: list[tuple[int, int, list[bytes], str]]):
        self.meaning: dict[int, dict[bytes, set[str]]] = {}
        for h, _, words, item in windows:
            self.meaning.setdefault(h, {}).setdefault(b" ".join(words), set()).add(item)
        self.hashes = np.array(sorted(self.meaning), A.U)
        self.bits = np.zeros(1 << TABLE_BITS, bool)
        self.bits[(self.hashes >> A.U(64 - TABLE_BITS)).astype(np.int64)] = True

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.bits[(hashes >> A.U(64 - TABLE_BITS)).astype(np.int64)])
        near = np.searchsorted(self.hashes, hashes[at])
        near[near == len(self.hashes)] = 0
        return at[self.hashes[near] == hashes[at]]


def _scan(sets: dict[int, HashSet]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offsets in A.text_blocks(A.as_texts(batch.column(1))):
                data = A.LOWER[data]
                starts, ends, first = A.words_of(data, offsets, A.ALNUM)
                hashes = A.word_hashes(data, starts, ends)
                last = np.repeat(first[1:], np.diff(first))
                # what sets before this one have found
                hits = {k: set(x) for k, x in enumerate(batch.column(3).slice(a, b - a).to_pylist()) if x} if batch.num_columns > 3 else {}
                items = {k: set(x) for k, x in enumerate(batch.column(4).slice(a, b - a).to_pylist()) if x} if batch.num_columns > 3 else {}
                for width, known in sets.items():
                    for i in known.candidates(A.window_hashes(hashes, width)):
                        if i + width > last[i]:
                            continue
                        words = b" ".join(data[s:e].tobytes() for s, e in zip(starts[i:i + width], ends[i:i + width], strict=True))
                        if found := known.meaning[int(A.window_hashes(hashes[i:i + width], width)[0])].get(words):
                            row = int(np.searchsorted(first, i, "right")) - 1
                            hits.setdefault(row, set()).update(range(int(i - first[row]), int(i - first[row]) + width))
                            items.setdefault(row, set()).update(found)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(np.diff(first), pa.int64()), pa.array([sorted(hits.get(k, ())) for k in range(b - a)], pa.list_(pa.int64())),
                    pa.array([sorted(items.get(k, ())) for k in range(b - a)], pa.list_(pa.string()))], names=["doc_id", "text", "n_words", "hits", "items"])
    return run


def hit_words(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
              width: int = 10, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, `hits` (the numbers of its words inside any occurrence of a benchmark window), `items`
    (the items with such windows, sorted as strings).

    A-Z are lowered; words are runs of digits, letters and characters beyond ASCII. An item of fewer than `width` words, but not none, is one window.
    Hash hits are verified word by word. Null or empty texts have no words; items with a null id or without words take no part; repeated items
    and documents count as they stand. The hash set holds `max_windows` windows at most: a larger benchmark is read in so many sets, each of which scans all texts, one after the other in the same pass.
    """
    small = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).filter("item is not null and text is not null")
    found = A.texts_only(docs, id_col, text_col)
    pending: list[tuple[str, str]] = []
    windows, scanned = 0, False

    def scan(df: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
        sets: dict[int, list] = {}
        for w in benchmark_windows(items, width):
            sets.setdefault(w[1], []).append(w)
        return df.mapInArrow(_scan({w: HashSet(x) for w, x in sets.items()}), FOUND)

    for row in small.toLocalIterator():  # one partition of the benchmark at a time, never more than one set of it
        pending.append((row["item"], row["text"]))
        windows += len(row["text"]) // 2 + 1
        if windows >= max_windows:
            found, pending, windows, scanned = scan(found, pending), [], 0, True
    return (scan(found, pending) if pending or not scanned else found).drop("text")


def _clean(sets: dict[int, HashSet], at: int):
    scan = _scan(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            two = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at)], names=["doc_id", "text"])
            dirty = [bool(hits) for found in scan(iter([two])) for hits in found.column(3).to_pylist()]
            yield batch.filter(pa.array([not x for x in dirty], pa.bool_()))
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The documents, with all their columns, without those whose text holds a benchmark window (see `hit_words`). Rows are dropped where they are scanned, none is shuffled.

    Null and empty texts stay, whatever the id; of repeated rows all stay or none. An empty benchmark drops nothing.
    """
    small = benchmark.select(A.quoted(item_col).cast("string").alias("item"), A.quoted(item_text_col).cast("string").alias("text")).filter("item is not null and text is not null")
    out, at = docs.withColumn(text_col, A.quoted(text_col).cast("string")), docs.columns.index(text_col)
    pending: list[tuple[str, str]] = []

    def cleaned(df: DataFrame) -> DataFrame:
        sets: dict[int, list] = {}
        for w in benchmark_windows(pending, width):
            sets.setdefault(w[1], []).append(w)
        return df.mapInArrow(_clean({w: HashSet(x) for w, x in sets.items()}, at), df.schema)
    windows = 0
    for row in small.toLocalIterator():  # one set of the benchmark at a time
        pending.append((row["item"], row["text"]))
        windows += len(row["text"]) // 2 + 1
        if windows >= max_windows:
            out, windows = cleaned(out), 0
            pending.clear()
    return cleaned(out) if pending else out


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query."""
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))

