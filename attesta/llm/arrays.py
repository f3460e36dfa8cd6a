"""Numpy on whole Arrow batches of texts: words, 64-bit hashes, windows, and packed rows that Spark shuffles by group."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U = np.uint64
#: Texts are worked on in blocks of about so many bytes, a longer text alone; and bytes are hashed in pieces of so many.
BLOCK, PIECE = 1 << 23, 1 << 19
#: Rows in an Arrow batch: with texts of a few kB a batch stays at some MB on both sides.
BATCH_ROWS = 1000


def as_texts(column: pa.Array) -> pa.Array:
    """The UTF-8 bytes of each row, a null as an empty text."""
    return pc.fill_null(column, "").cast(pa.large_binary())


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a `large_binary` array and the offset of each row, and of the end, without a copy."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of blocks of rows with at most `limit` bytes, one row at least."""
    data, offsets = buffers(texts)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, to, data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        row = to


def byte_class(keep) -> np.ndarray:
    """Which of the 256 bytes belong to words."""
    return np.array([bool(keep(b)) for b in range(256)])


#: Words of anything but white space: [^\x20\x09-\x0D]+.
PLAIN = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words of letters, digits and anything beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in texts with A-Z lowered.
ALNUM = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the byte range of every word, and for each text the number of its first word, then that of the end."""
    on = table[data]
    first_bytes, last_bytes = offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begins, ends = on.copy(), on.copy()
    begins[1:] &= ~on[:-1]
    begins[first_bytes] = on[first_bytes]
    ends[:-1] &= ~on[1:]
    ends[last_bytes] = on[last_bytes]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over the others."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = 0x9E3779B97F4A7C15 | 1
STEP = U(0xD6E8FEB86659FD93)


@lru_cache(4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.cumprod(out)


@lru_cache(1)
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the hash of data[s:e] is (sums[e] - sums[s]) * inverse[s], mod 2^64, wherever it stands."""
    size = max(PIECE, 1 << int(max(1, len(data)) - 1).bit_length())
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(byte_values()[data] * _powers(size, BASE)[:len(data)], out=sums[1:])
    return sums, _powers(size, pow(BASE, -1, 1 << 64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, which depends on its bytes only."""
    out, k = np.empty(len(starts), U), 0
    while k < len(starts):
        to = max(k + 1, int(np.searchsorted(ends, starts[k] + PIECE, "right")))
        lo = starts[k]
        sums, inverse = prefix_hashes(data[lo:ends[to - 1]])
        s, e = starts[k:to] - lo, ends[k:to] - lo
        out[k:to] = (sums[e] - sums[s]) * inverse[s]
        k = to
    return mix(out)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every `width` consecutive values, those that cross texts included (see `window_starts`)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out = words[:n].copy()
    for k in range(1, width):
        out *= STEP
        out += words[k:n + k]
    return mix(out)


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """The numbers of the words at which a window of one text starts."""
    ends = np.repeat(first[1:], np.diff(first))
    return np.flatnonzero(np.arange(len(ends)) + width <= ends)


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of n places lie in [s, s + width) for one of the starts."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps[:-1]) > 0


def runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts in a sorted array."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1]) if len(values) else np.zeros(0, np.int64)


def groups_for(df: DataFrame) -> int:
    """How many groups packed items are dealt into: one for each shuffle partition the session asks for, so that they grow with the cluster's setting
    and a task that deals its items again writes as many rows as there are partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def doc_group(ids: np.ndarray, groups: int) -> np.ndarray:
    """The group that gathers what is known of a document."""
    return (mix(ids.astype(np.int64).view(U) + U(0x51ED270B)) % U(groups)).astype(np.int64)


def texts_only(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under names of its own, whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that the table doesn't have."""
    while name in df.columns:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")
