"""Substring deduplication by level-wise doubling: windows of words that repeat at one length alone are tried at twice that length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A
from attesta.llm import exchange as X

#: The length at which doubling starts: long enough that few windows of unrelated texts repeat, and half of the usual window.
START = 7


def lengths(width: int, start: int = START) -> list[int]:
    """The lengths that are tried: start, twice that, and so on, at last `width`, whose two halves may overlap."""
    out = [min(start, width)]
    while out[-1] < width:
        out.append(min(2 * out[-1], width))
    return out


def _first_level(length: int, groups: int, last: bool):
    """Names every window of `length` words and asks for those that stand in two documents (or, at the last level, in a smaller one).

    Before the last level a name travels as 31 bits and its group; bit 0 says that this block alone has it in two documents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.filter(batch.column(0).is_valid())
            ids = named.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, _, data, offsets in A.text_blocks(A.as_texts(named.column(1))):
                starts, ends, first = A.words_of(data, offsets, A.PLAIN)
                at = A.window_starts(first, length)
                names = A.window_hashes(A.word_hashes(data, starts, ends), length)[at]
                row = np.searchsorted(first, at, "right") - 1
                docs, places = ids[a + row], at - first[row]
                sorted_items = bool((np.diff(ids[a:a + len(first) - 1]) > 0).all())
                yield from (X.ask_first(names, docs, places, groups, True, sorted_items) if last else ask_repeated(short_names(names, groups), docs, places, groups, sorted_items))
    return run


def short_names(names: np.ndarray, groups: int) -> np.ndarray:
    """group and 31 bits, with bit 0 free."""
    return ((names >> A.U(32)) % A.U(groups)) << A.U(32) | (names & A.U(0xFFFFFFFE))


def ask_repeated(names: np.ndarray, docs: np.ndarray, places: np.ndarray, groups: int, sorted_items: bool) -> Iterator[pa.RecordBatch]:
    """Items of one name behind its first document are FOUND to repeat; the first document asks, and says so if it knows already."""
    order, run = X.by_name(names, docs, places, sorted_items)
    lead = docs[order] == docs[order][A.runs(names[order])][run] if len(order) else np.zeros(0, bool)
    repeated = np.zeros(run[-1] + 1 if len(run) else 0, bool)
    repeated[run[~lead]] = True
    mine, late = order[lead], np.sort(order[~lead])
    flags = repeated[run[lead]]
    back = np.argsort(mine, kind="stable")
    mine, flags = mine[back], flags[back]
    yield from X.pack(X.ASK, (names[mine] >> A.U(32)).astype(np.int64), docs[mine], places[mine], (names[mine] & A.U(0xFFFFFFFE)).astype(np.uint32) | flags.astype(np.uint32))
    yield from X.pack(X.FOUND, A.doc_group(docs[late], groups), docs[late], places[late], names[late])


def answer_repeated(groups: int):
    """FOUND rows, with their names, for the asking items whose name stands in two documents."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        docs, places, short = X.unpack(table, X.ASK, np.uint32)
        if len(docs):
            names = short & np.uint32(0xFFFFFFFE)
            order, run = X.by_name(names, docs, places, False)
            starts = A.runs(names[order])
            # bit 0: its block has it twice. Otherwise the smallest and the largest document differ.
            twice = np.logical_or.reduceat((short[order] & 1).astype(bool), starts) | (docs[order][starts] != docs[order][np.append(starts[1:], len(order)) - 1])
            hit = order[twice[run]]
            hit = hit[np.lexsort((places[hit], docs[hit]))]
            group = int(table.column("grp")[0].as_py())
            yield from X.pack(X.FOUND, A.doc_group(docs[hit], groups), docs[hit], places[hit], A.U(group) << A.U(32) | names[hit].astype(A.U))
        yield from X.others(table, (X.FOUND,))
    return work


def _next_level(length: int, longer: int, groups: int, last: bool):
    """Names windows of `longer` words by those of `length` at both their ends, for the places where both repeat, and asks again."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        docs, places, names = X.unpack(table, X.FOUND, A.U)
        if not len(docs):
            return
        order = np.lexsort((places, docs))
        docs, places, names = docs[order], places[order], names[order]
        number = np.cumsum(np.diff(docs, prepend=docs[0]) != 0)
        key = (number << 40) + places
        fresh = np.append(True, key[1:] != key[:-1])  # rows that repeat give each place twice
        docs, places, names, key = docs[fresh], places[fresh], names[fresh], key[fresh]
        other = np.minimum(np.searchsorted(key, key + (longer - length)), len(key) - 1)
        both = key[other] == key + (longer - length)
        names = A.mix(names[both] * A.STEP + names[other[both]])
        docs, places = docs[both], places[both]
        yield from X.ask_first(names, docs, places, groups, True, True) if last else ask_repeated(short_names(names, groups), docs, places, groups, True)
    return work


def _kept(width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zs, found = batch.column("z").to_pylist(), batch.column("cut_at").to_pylist()
            counts, removed, texts = [], [], []
            for z, at in zip(zs, found, strict=True):
                raw = X.unpressed(z)
                data = np.frombuffer(raw, np.uint8)
                starts, ends, _ = A.words_of(data, np.array([0, len(data)]), A.PLAIN)
                counts.append(len(starts))
                places = np.frombuffer(at or b"", np.int64)
                keep = ~A.covered(len(starts), places[places < len(starts)], width)
                removed.append(len(starts) - int(keep.sum()))
                texts.append(b" ".join([raw[s:e] for s, e in zip(starts[keep], ends[keep], strict=True)]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept"])
    return run


def repeated_windows(docs: DataFrame, width: int = 13, start: int = START, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and `cut_at` (binary, int64): the numbers of the words at which a window of `width` words starts that a smaller document also has.

    Each level names its windows by two names of the level before and keeps, of each document, the places whose name stands in another document too; the
    next level looks at those alone, so a level of a corpus without repeats leaves nothing for the next. Texts are read once; only
    names and places are shuffled.
    """
    texts = A.texts_only(docs, id_col, text_col)
    groups, levels = A.groups_for(docs), lengths(width, start)
    rows = texts.mapInArrow(_first_level(levels[0], groups, len(levels) == 1), X.ROWS)
    for k, length in enumerate(levels[:-1]):
        rows = X.dealt(rows, groups, answer_repeated(groups))
        rows = X.dealt(rows, groups, _next_level(length, levels[k + 1], groups, k == len(levels) - 2))
    rows = X.dealt(rows, groups, X.answer_first(groups, True))
    return X.per_document(rows, groups, {X.FOUND: ("cut", np.uint8)}).drop("cut_load")


def remove_repeats(docs: DataFrame, width: int = 13, start: int = START, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, `kept` (the words that stay, joined by one space).

    A word goes if a window of `width` consecutive words covers it whose words also stand, in that order, in a document with a smaller id; windows are judged on
    the input. Words are runs of anything but white space. Null and empty texts have no words. Rows with a null id lose nothing and take nothing from others. Rows of
    one id are one document: equal ones give equal rows. Windows are the same when their 64-bit names are (the halves' names have about 40 bits each).
    """
    found = repeated_windows(docs, width, start, id_col, text_col)
    joined = X.pressed(docs, id_col, text_col).join(found, "doc_id", "left")
    return joined.mapInArrow(_kept(width, True), "doc_id long, n_words long, n_removed long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    """The columns of the query."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
