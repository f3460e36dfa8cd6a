"""Exact deduplication of byte strings by prefix-free parsing: rolling-hash triggers cut texts into phrases, equal phrases are looked at once, and only the
strings of phrases that stand in several contexts are looked up one by one, by hash. No suffix array is built."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A
from attesta.llm import exchange as X
from attesta.llm.session import stored

#: Bytes of the rolling hash, and the number of neighbouring hashes of which the least is a trigger. Every string of SPAN + GRAM - 1 bytes has one.
GRAM, SPAN = 16, 64
#: Bytes that are parsed at a time.
PIECE = 1 << 21
#: What is sent of a phrase: 32 bits of the dictionary key beside its group, the bytes before its trigger at its first and last suffix, its identity, and a mark for keys that stand for themselves.
PHRASE = np.dtype([("key", "<u4"), ("far", "u1"), ("near", "u1"), ("mark", "u1"), ("own", "<u8")])


def phrases(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first, last, key, own) of every phrase of a block, as byte places, places and hashes.

    The suffix at i belongs to the trigger t(i), the leftmost least rolling hash among those at i to i + SPAN - 1, which `width` bytes from i on decide alone. A phrase is the
    run of suffixes of one trigger; `key` is the hash of the bytes that all of them share from the trigger on, `own` that of all bytes from the first suffix to the end of the last one's `width` bytes.
    """
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, A.U),) * 2
    ends = np.repeat(offsets[1:], np.diff(offsets))
    n = len(data) - GRAM + 1
    if n < SPAN or len(data) < width:
        return none
    sums, inverse = A.prefix_hashes(data)
    best = A.mix((sums[GRAM:] - sums[:n]) * inverse[:n])
    at = np.arange(n, dtype=np.int32)
    step = 1
    while step < SPAN:  # the least of 2, 4, ... hashes from each place on, the left one on ties
        right = best[step:] < best[:-step]
        at = np.where(right, at[step:], at[:-step])
        best = np.where(right, best[step:], best[:-step])
        step *= 2
    starts = np.flatnonzero(np.arange(len(at)) + width <= ends[:len(at)])
    if not len(starts):
        return none
    trigger = at[starts].astype(np.int64)
    cut = np.flatnonzero((np.diff(trigger) != 0) | (np.diff(starts) != 1)) + 1
    first, last = starts[np.append(0, cut)], starts[np.append(cut, len(starts)) - 1]
    trigger = trigger[np.append(0, cut)]
    shared = width - SPAN + 1
    key = A.mix((sums[trigger + shared] - sums[trigger]) * inverse[trigger])
    own = A.mix((sums[last + width] - sums[first]) * inverse[first] + (last - first).astype(A.U))
    return trigger, first, last, key, own


def _classes(phrase: np.ndarray, key: np.ndarray, docs: np.ndarray, places: np.ndarray, sorted_items: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, run of the key, number of the class): items by key, class, document, place; a class is a key with one context."""
    by = (phrase["own"], phrase["near"], phrase["far"], key)
    order = np.lexsort(by if sorted_items else (places, docs, *by))
    k, p = key[order], phrase[order]
    new_key = np.append(True, k[1:] != k[:-1]) if len(k) else np.zeros(0, bool)
    new = new_key | np.append(True, (p["own"][1:] != p["own"][:-1]) | (p["far"][1:] != p["far"][:-1]) | (p["near"][1:] != p["near"][:-1])) if len(k) else new_key
    return order, np.cumsum(new_key) - 1, np.cumsum(new) - 1


def _later(lead: np.ndarray, docs: np.ndarray, places: np.ndarray, of_class: np.ndarray) -> np.ndarray:
    """Items, in order, that stand behind the first of their class: not that one again from a repeated row."""
    first = np.flatnonzero(lead)[of_class - of_class[0]] if len(of_class) else np.zeros(0, np.int64)
    return (docs != docs[first]) | (places != places[first])


def _ranges(kind: int, items: np.ndarray, phrase: np.ndarray, docs: np.ndarray, places: np.ndarray, groups: int) -> Iterator[pa.RecordBatch]:
    """Rows for the documents: the place of the first suffix, and how many follow it."""
    first = places[items] - phrase["far"][items]
    order = np.lexsort((first, docs[items]))
    items, first = items[order], first[order]
    yield from X.pack(kind, A.doc_group(docs[items], groups), docs[items], first, phrase["far"][items] - phrase["near"][items])


def _pieces(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, place of the first byte in its text): blocks of texts, a long text in pieces that share width - 1 bytes."""
    for a, b, data, offsets in A.text_blocks(A.as_texts(texts), PIECE):
        if b - a > 1 or len(data) <= PIECE:
            yield a, data, offsets, 0
        else:
            for lo in range(0, max(len(data) - width + 1, 1), PIECE):
                piece = data[lo:lo + PIECE + width - 1]
                yield a, piece, np.array([0, len(piece)]), lo


def _parse(width: int, groups: int):
    """Settles phrases that a block has again in the same context, opens those it has in several, and asks for the others.

    Of a key with several contexts one item travels, marked, so that a key which stands everywhere sends one item per block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.filter(batch.column(0).is_valid())
            ids = named.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, data, offsets, shift in _pieces(named.column(1), width):
                trigger, first, last, key, own = phrases(data, offsets, width)
                if not len(trigger):
                    continue
                row = np.searchsorted(offsets, first, "right") - 1
                docs, places = ids[a + row], trigger - offsets[row] + shift
                phrase = np.zeros(len(trigger), PHRASE)
                group = ((key >> A.U(32)) % A.U(groups)).astype(np.int64)
                phrase["key"], phrase["far"], phrase["near"], phrase["own"] = key & A.U(0xFFFFFFFF), trigger - first, trigger - last, own
                order, of_key, of_class = _classes(phrase, key, docs, places, bool((np.diff(ids[a:a + len(offsets) - 1]) > 0).all()))
                lead = np.diff(of_class, prepend=-1) > 0
                several = np.bincount(of_key[lead]) > 1
                yield from _ranges(X.FOUND, order[_later(lead, docs[order], places[order], of_class)], phrase, docs, places, groups)
                yield from _ranges(X.OPEN, order[lead & several[of_key]], phrase, docs, places, groups)
                sent = order[lead & (~several[of_key] | (np.diff(of_key, prepend=-1) > 0))]
                phrase["mark"][order] = several[of_key]
                sent = np.sort(sent)
                yield from X.pack(X.ASK, group[sent], docs[sent], places[sent], phrase[sent])
    return run


def _dictionary(groups: int):
    """The phrases of one part of the dictionary: FOUND where an earlier document or place has the same context, OPEN where the key has others."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        docs, places, phrase = X.unpack(table, X.ASK, PHRASE)
        if len(docs):
            marked = phrase["mark"].astype(bool)
            order, of_key, of_class = _classes(phrase, phrase["key"], docs, places)
            several = np.zeros(of_key[-1] + 1, bool)
            several[of_key[marked[order]]] = True
            plain = ~marked[order]  # a marked item's own phrase is open already
            order, of_key, of_class = order[plain], of_key[plain], of_class[plain]
            of_class = np.cumsum(np.diff(of_class, prepend=-1) != 0) - 1
            lead = np.diff(of_class, prepend=-1) > 0
            several |= np.bincount(of_key[lead], minlength=len(several)) > 1
            yield from _ranges(X.FOUND, order[_later(lead, docs[order], places[order], of_class)], phrase, docs, places, groups)
            yield from _ranges(X.OPEN, order[lead & several[of_key]], phrase, docs, places, groups)
        yield from X.others(table, (X.FOUND, X.OPEN))
    return work


def _spread(first: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Every place from first to first + more."""
    n = more.astype(np.int64) + 1
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _string_names(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the `width` bytes from each of the sorted starts."""
    out, k = np.empty(len(starts), A.U), 0
    while k < len(starts):
        to = int(np.searchsorted(starts, starts[k] + A.PIECE))
        lo = starts[k]
        sums, inverse = A.prefix_hashes(data[lo:starts[to - 1] + width])
        s = starts[k:to] - lo
        out[k:to] = (sums[s + width] - sums[s]) * inverse[s]
        k = to
    return A.mix(out)


def _corpus_order(width: int, groups: int):
    """Asks for every string of `width` bytes that starts in an open phrase which of the equal ones, by their 64-bit hashes, comes first. Documents of a batch settle what they can."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, docs, places = [np.zeros(0, A.U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            size = 0

            def settle() -> Iterator[pa.RecordBatch]:
                yield from X.ask_first(np.concatenate(names), np.concatenate(docs), np.concatenate(places), groups, False, False)  # noqa: B023
            for doc, z, at, load in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "z", "open_at", "open_load")), strict=True):
                if z is None or not at:
                    continue
                data = np.frombuffer(X.unpressed(z), np.uint8)
                places_here = np.unique(_spread(np.frombuffer(at, np.int64), np.frombuffer(load, np.uint8)))
                places_here = places_here[places_here + width <= len(data)]
                names.append(_string_names(data, places_here, width))
                places.append(places_here)
                docs.append(np.full(len(places_here), doc, np.int64))
                size += len(places_here)
                if size > 1_000_000:
                    yield from settle()
                    names, docs, places, size = names[:1], docs[:1], places[:1], 0
            yield from settle()
    return run


def _kept(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, texts = [], [], [], []
            for z, ranges, more, single in zip(*(batch.column(c).to_pylist() for c in ("z", "found_at", "found_load", "late_at")), strict=True):
                raw = X.unpressed(z)
                n, steps = len(raw), np.zeros(len(raw) + 1, np.int32)
                if ranges:
                    first = np.minimum(np.frombuffer(ranges, np.int64), n)
                    np.add.at(steps, first, 1)
                    np.add.at(steps, np.minimum(first + np.frombuffer(more, np.uint8) + width, n), -1)
                if single:
                    first = np.minimum(np.frombuffer(single, np.int64), n)
                    np.add.at(steps, first, 1)
                    np.add.at(steps, np.minimum(first + width, n), -1)
                gone = np.cumsum(steps[:-1]) > 0
                sizes.append(n)
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                texts.append(np.frombuffer(raw, np.uint8)[~gone].tobytes() if removed[-1] else raw)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(texts, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and `kept`, the bytes that stay.

    A byte goes if a string of `width` bytes of its document covers it that also starts earlier: in a document with a smaller id, or before in the same one, overlaps
    included. Strings are judged on the input and never cross documents. Null and empty texts have no bytes. Rows with a null id lose nothing and take nothing from others. Rows of one id
    are one document: equal ones give equal rows. Strings are the same when their 64-bit hashes are.

    Trigger hashes cut every text into phrases alike wherever the same bytes stand. The dictionary, dealt by key, has each phrase with its context once: later occurrences are repeats as a whole.
    Only phrases whose key has several contexts (the ends of repeated passages) have their strings looked up one by one, by the hashes of their `width` bytes.
    """
    if width < SPAN + GRAM:
        raise ValueError(f"strings of fewer than {SPAN + GRAM} bytes may have no trigger")
    groups = A.groups_for(docs)
    texts = A.texts_only(docs, id_col, text_col)
    rows = X.dealt(texts.mapInArrow(_parse(width, groups), X.ROWS), groups, _dictionary(groups))
    found = X.per_document(rows, groups, {X.FOUND: ("found", np.uint8), X.OPEN: ("open", np.uint8)})
    found = stored(found)
    z = X.pressed(docs, id_col, text_col)
    asked = z.join(found.filter(F.length("open_at") > 0).select("doc_id", "open_at", "open_load"), "doc_id").mapInArrow(_corpus_order(width, groups), X.ROWS)
    late = X.per_document(X.dealt(asked, groups, X.answer_first(groups, False)), groups, {X.FOUND: ("late", np.uint8)}).select("doc_id", "late_at")
    joined = z.join(found.select("doc_id", "found_at", "found_load").join(late, "doc_id", "full"), "doc_id", "left")
    return joined.mapInArrow(_kept(width), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(kept: DataFrame) -> DataFrame:
    """The columns of the query."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
