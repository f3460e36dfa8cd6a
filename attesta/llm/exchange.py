"""Which of many items with equal names comes first: packed rows, dealt by name, then back to the documents.

An item is (name, document, place). Whoever holds a block of items settles among them what it can and asks with the first of each name only, so a name that
stands in a third of all documents sends one item per block, not one per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A

#: A row holds the items of one kind and group as a few binary columns; groups of the kind ASK go by name, all others by document.
ROWS = "kind int, grp int, n int, docs binary, places binary, payload binary"
_FIELDS = [("kind", pa.int32()), ("grp", pa.int32()), ("n", pa.int32()), ("docs", pa.binary()), ("places", pa.binary()), ("payload", pa.binary())]
ASK, FOUND, OPEN = 0, 1, 2
_press, _unpress = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def press(data: bytes | None) -> bytes | None:
    return None if data is None else _press.compress(data)


def unpressed(z: bytes | None) -> bytes:
    return b"" if z is None else _unpress.decompress(z)


def squeeze(values: np.ndarray) -> bytes:
    """The planes of equal bytes of small numbers compress well."""
    return _press.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unsqueeze(data: bytes, n: int | None, kind) -> np.ndarray:
    planes = np.frombuffer(_unpress.decompress(data), np.uint8)
    planes = planes.reshape(np.dtype(kind).itemsize, -1) if n is None else planes.reshape(-1, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _unsigned(values: np.ndarray) -> np.ndarray:
    """Small differences, of either sign, as small numbers."""
    return ((values << 1) ^ (values >> 63)).view(np.uint64)


def _signed(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(1)).view(np.int64) ^ -(values & np.uint64(1)).view(np.int64)


def pack(kind: int, group: np.ndarray, docs: np.ndarray, places: np.ndarray, payload: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each group that occurs. Items keep their order in it; sorted by document and place they take least space."""
    if not len(group):
        return
    order = np.argsort(group.astype(np.uint16) if group.max() < 1 << 16 else group, kind="stable")
    group, docs, places, payload = group[order], docs[order], places[order], payload[order]
    cuts = np.append(A.runs(group), len(group))
    rows: list[list] = [[] for _ in _FIELDS]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        d, p = np.diff(docs[a:b], prepend=np.int64(0)), np.diff(places[a:b], prepend=np.int64(0))
        for column, value in zip(rows, (kind, int(group[a]), int(b - a), squeeze(_unsigned(d)), squeeze(_unsigned(p)), squeeze(payload[a:b])), strict=True):
            column.append(value)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(rows, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])


def unpack(table: pa.Table, kind: int, payload) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(docs, places, payload) of all rows of one kind."""
    docs, places, load = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, payload)]
    for k, n, d, p, x in zip(*(table.column(c).to_pylist() for c in ("kind", "n", "docs", "places", "payload")), strict=True):
        if k == kind:
            docs.append(np.cumsum(_signed(unsqueeze(d, n, np.uint64))))
            places.append(np.cumsum(_signed(unsqueeze(p, n, np.uint64))))
            load.append(unsqueeze(x, n, payload))
    return np.concatenate(docs), np.concatenate(places), np.concatenate(load)


def others(table: pa.Table, kinds: tuple[int, ...]) -> list[pa.RecordBatch]:
    """The rows of these kinds as they are."""
    return table.filter(pa.array([k in kinds for k in table.column("kind").to_pylist()], pa.bool_())).to_batches()


def by_name(names: np.ndarray, docs: np.ndarray, places: np.ndarray, sorted_items: bool) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): items sorted by name, document, place, and the number of the name each belongs to."""
    order = np.argsort(names, kind="stable") if sorted_items else np.lexsort((places, docs, names))
    starts = A.runs(names[order])
    return order, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(names))))


def dealt(rows: DataFrame, groups: int, work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str = ROWS) -> DataFrame:
    """`work` on the rows of each group: a partition for each, by its number, so that hashing puts no two groups into one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if own := [b for b in batches if b.num_rows]:
            yield from work(pa.Table.from_batches(own))
    return rows.repartitionById(groups, F.col("grp")).mapInArrow(run, schema)


def ask_first(names: np.ndarray, docs: np.ndarray, places: np.ndarray, groups: int, whole_docs: bool, sorted_items: bool) -> Iterator[pa.RecordBatch]:
    """Rows that ask which items have an earlier one of their name: in a smaller document (`whole_docs`), or there or before in the same one.

    Items that a smaller one of this block precedes are FOUND at once.
    """
    order, run = by_name(names, docs, places, sorted_items)
    firsts = np.flatnonzero(np.diff(run, prepend=-1))
    lead = docs[order] == docs[order][firsts][run]
    if not whole_docs:
        lead &= places[order] == places[order][firsts][run]
    mine = np.sort(order[lead])
    late = np.sort(order[~lead])
    yield from pack(ASK, (names[mine] % A.U(groups)).astype(np.int64), docs[mine], places[mine], names[mine])
    yield from pack(FOUND, A.doc_group(docs[late], groups), docs[late], places[late], np.zeros(len(late), np.uint8))


def answer_first(groups: int, whole_docs: bool) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    """Turns ASK rows of one group into FOUND rows for the items that another of their name precedes."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        docs, places, names = unpack(table, ASK, A.U)
        if len(docs):
            order, run = by_name(names, docs, places, False)
            firsts = np.flatnonzero(np.diff(run, prepend=-1))
            lead = docs[order] == docs[order][firsts][run]
            if not whole_docs:
                lead &= places[order] == places[order][firsts][run]
            late = order[~lead]
            late = late[np.lexsort((places[late], docs[late]))]
            yield from pack(FOUND, A.doc_group(docs[late], groups), docs[late], places[late], np.zeros(len(late), np.uint8))
        yield from others(table, (FOUND,))
    return work


def per_document(rows: DataFrame, groups: int, kinds: dict[int, tuple[str, type]]) -> DataFrame:
    """One row per document: doc_id and, for each kind, the sorted places and their payload as two binary columns (int64 and bytes)."""
    columns = [(f"{name}_{x}", kind) for kind, (name, _) in kinds.items() for x in ("at", "load")]

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        parts = {}
        for kind, (_, load) in kinds.items():
            docs, places, payload = unpack(table, kind, load)
            order = np.lexsort((places, docs))
            parts[kind] = docs[order], places[order], payload[order]
        ids = np.unique(np.concatenate([d for d, _, _ in parts.values()]))
        out: list[list] = []
        for docs, places, payload in parts.values():
            a, b = np.searchsorted(docs, ids), np.searchsorted(docs, ids, "right")
            out += [[places[x:y].tobytes() for x, y in zip(a, b, strict=True)], [payload[x:y].tobytes() for x, y in zip(a, b, strict=True)]]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.binary()) for c in out)], names=["doc_id", *(c for c, _ in columns)])
    return dealt(rows.filter(F.col("kind").isin(list(kinds))), groups, run, "doc_id long, " + ", ".join(f"{c} binary" for c, _ in columns))


def pressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and the text in `z`, compressed (null: null): for texts that a join has to move."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(press, texts), pa.binary())], names=["doc_id", "z"])
    return A.texts_only(docs, id_col, text_col).mapInArrow(run, "doc_id long, z binary")
