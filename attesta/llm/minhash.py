"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A
from attesta.llm import exchange as X
from attesta.llm.components import components
from attesta.llm.session import counted, observed, stored
from attesta.llm.substrings import answer_repeated, ask_repeated, short_names

WIDTH, THRESHOLD = 5, 0.8
#: A shingle in a share of the documents of 1 / COMMON or less (or in one alone) weighs 1 + IDF times its count, one in all documents its count, others by the logarithm in between. So a weight
#: follows from shares, not from the size of the corpus, and there are fewer than COMMON times the mean length of a document whose frequency has to be known.
COMMON, IDF = 500, 0.5
#: Samples of a document, in squares of 16. The bands are the 20 lines of each square (every two samples of a square share one), so two documents that agree
#: in 80 % of the samples share a band in all but 1 of 28,000 cases.
SQUARES, SIDE = 2, 4
SAMPLES = SQUARES * SIDE * SIDE
#: Rounds in which all documents of a bucket are compared with one of them, and the pivots that a document keeps what it shares with.
PIVOTS, NEAREST = 2, 4


@lru_cache(1)
def bands() -> tuple[tuple[int, ...], ...]:
    """The lines of affine planes over the field of four elements: 4 samples each."""
    times = ((0, 0, 0, 0), (0, 1, 2, 3), (0, 2, 3, 1), (0, 3, 1, 2))
    field = range(SIDE)
    lines = [[x * SIDE + (times[m][x] ^ b) for x in field] for m in field for b in field] + [[x * SIDE + y for y in field] for x in field]
    return tuple(tuple(s * SIDE * SIDE + p for p in line) for s in range(SQUARES) for line in lines)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, rows, copies): the distinct shingles of each text of a block, by row, then name, and how often each stands there.

    A text of fewer words than `width`, but not none, is one shingle.
    """
    starts, ends, first = A.words_of(data, offsets, A.PLAIN)
    words = A.word_hashes(data, starts, ends)
    at = A.window_starts(first, width)
    names, rows = [A.window_hashes(words, width)[at] if len(at) else np.zeros(0, A.U)], [np.searchsorted(first, at, "right") - 1]
    counts = np.diff(first)
    for k in np.flatnonzero((counts > 0) & (counts < width)):
        names.append(A.window_hashes(words[first[k]:first[k + 1]], int(counts[k])))
        rows.append(np.array([k]))
    name, row = np.concatenate(names), np.concatenate(rows)
    order = np.lexsort((name, row))
    name, row = name[order], row[order]
    new = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (row[1:] != row[:-1]))) if len(name) else np.zeros(0, np.int64)
    return name[new], row[new], np.diff(np.append(new, len(name)))


# --- Document frequencies ---

_COUNTS = "grp int, n long, names binary, counts binary"
SHORT = A.U(0xFFFFFFFF)


def _count_block(width: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in A.text_blocks(A.as_texts(batch.column(1))):
                names, _, _ = shingles(data, offsets, width)
                names, counts = np.unique(names, return_counts=True)
                group = (names >> A.U(32)) % A.U(groups)
                order = np.argsort(group.astype(np.uint16) if groups < 1 << 16 else group, kind="stable")
                group, counts = group[order], counts[order].astype(np.uint32)
                short = (names[order] & SHORT).astype(np.int64)
                cuts = np.append(A.runs(group), len(group))
                rows: list[list] = [[], [], [], []]
                for a, b in itertools.pairwise(cuts) if len(group) else ():
                    by = np.argsort(short[a:b], kind="stable")
                    for column, value in zip(rows, (int(group[a]), int(counts[a:b].sum()), X.squeeze(np.diff(short[a:b][by], prepend=np.int64(0)).astype(np.uint32)), X.squeeze(counts[a:b][by])), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.binary())], names=["grp", "n", "names", "counts"])
    return run


def _sum_counts(floor: float):
    """The names of a group that more documents than `floor` have."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for x, y in zip(table.column("names").to_pylist(), table.column("counts").to_pylist(), strict=True):
            names.append(np.cumsum(X.unsqueeze(x, None, np.uint32), dtype=np.int64))
            counts.append(X.unsqueeze(y, None, np.uint32))
        name, count = np.concatenate(names), np.concatenate(counts)
        order = np.argsort(name, kind="stable")
        name, starts = name[order], A.runs(name[order])
        total = np.add.reduceat(count[order].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
        kept = np.flatnonzero(total > floor)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), table.column("grp")[0].as_py()), pa.int32()), pa.array(name[starts][kept], pa.int64()), pa.array(total[kept], pa.int64())], names=["grp", "short", "df"])
    return work


class Weights:
    """The weight of a shingle: its count in the text times 1 + idf, the idf scaled to 0 for shingles in all documents and to IDF for those in `floor` documents or fewer."""

    def __init__(self, groups: int, documents: int, floor: float, group: np.ndarray, short: np.ndarray, df: np.ndarray):
        self.groups, self.documents, self.floor = groups, documents, floor
        keys = (group.astype(np.int64) << 32) | short.astype(np.int64)
        order = np.argsort(keys)
        self.keys, self.df = keys[order], df.astype(np.float64)[order]

    def __call__(self, names: np.ndarray, copies: np.ndarray) -> np.ndarray:
        df = np.full(len(names), self.floor)
        if len(self.keys):
            own = ((((names >> A.U(32)) % A.U(self.groups)) << A.U(32)) | (names & SHORT)).astype(np.int64)
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            df = np.where(self.keys[at] == own, self.df[at], df)
        if self.documents <= self.floor:
            return copies.astype(np.float64)
        return copies * (1 + IDF * np.log(self.documents / np.minimum(df, self.documents)) / np.log(self.documents / self.floor))


def weigh(docs: DataFrame, width: int, id_col: str, text_col: str) -> Weights:
    """Counts, over all documents, in how many each shingle stands, and keeps the counts of those in more than one and a share of 1 / COMMON.

    A block of texts sends its distinct shingles with their counts, 32 bits of a name beside its group, as sorted differences. The counts that are kept sum to no more than all (document, shingle)
    pairs, so they are fewer than COMMON times the shingles that a document has in the mean: it is these that reach the driver and the tasks.
    """
    groups, documents = A.groups_for(docs), docs.count()
    floor = max(1.0, documents / COMMON)
    blocks = A.texts_only(docs, id_col, text_col).mapInArrow(_count_block(width, groups), _COUNTS)
    told = X.dealt(blocks, groups, _sum_counts(floor), "grp int, short long, df long").toPandas()
    return Weights(groups, documents, floor, *(told[c].to_numpy() for c in ("grp", "short", "df")))


# --- Signatures ---

@lru_cache(1)
def _gamma() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """65,536 quantiles of the Gamma(2, 1) distribution, their inverses and their logarithms."""
    x = np.concatenate([np.geomspace(1e-5, 1, 50_000), np.linspace(1, 40, 150_000)[1:]])
    q = np.interp((np.arange(65536) + 0.5) / 65536, 1 - (1 + x) * np.exp(-x), x)
    return q.astype(np.float32), (1 / q).astype(np.float32), np.log(q).astype(np.float32)


def signatures(names: np.ndarray, rows: np.ndarray, weights: np.ndarray, n_rows: int, samples: int | None = None, first: int = 0) -> np.ndarray:
    """SAMPLES 64-bit values for each row, or so many from the sample `first` on: sample k is the shingle and step of the least a_k, which two rows share with the probability of their
    weighted Jaccard similarity. Rows without shingles stay 0.

    For a shingle of weight w, with r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its hash under seed k: t = floor(ln w / r + b), ln a = ln c - r (t - b + 1).
    """
    samples = SAMPLES if samples is None else samples
    out = np.zeros((n_rows, samples), A.U)
    if not len(names):
        return out
    gamma, inverse, log_gamma = _gamma()
    logs, starts = np.log(weights).astype(np.float32), A.runs(rows)
    which, sizes = rows[starts], np.diff(np.append(starts, len(rows)))
    seeds = A.mix(np.arange(first + 1, first + samples + 1, dtype=A.U) * A.U(0x2545F4914F6CDD1D)) | A.U(1)
    for k in range(samples):
        h = names * seeds[k]
        h ^= h >> A.U(29)
        h *= A.U(0xBF58476D1CE4E5B9)
        h ^= h >> A.U(32)
        quarters, halves = h.view(np.uint16).reshape(-1, 4), h.view(np.uint32).reshape(-1, 2)  # lowest bits first
        low = quarters[:, 0].astype(np.intp)
        b = halves[:, 1].astype(np.float32)
        b *= np.float32(2.0 ** -32)
        t = logs * inverse[low]
        t += b
        np.floor(t, out=t)
        a = t - b
        a += np.float32(1)
        a *= gamma[low]
        np.subtract(log_gamma[quarters[:, 1]], a, out=a)
        least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), sizes))
        _, one = np.unique(rows[least], return_index=True)
        at = least[one]
        out[which, k] = A.mix(names[at] + t[at].astype(np.int64).view(A.U) * A.STEP)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each row and band."""
    out = np.empty((len(signature), len(bands())), A.U)
    for k, line in enumerate(bands()):
        h = np.full(len(signature), k + 1, A.U)
        for p in line:
            h = A.mix(h * A.STEP + signature[:, p])
        out[:, k] = h
    return out


def _sign(width: int, weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.filter(batch.column(0).is_valid())
            done: dict[bytes, list[int]] = {}
            for a, b, data, offsets in A.text_blocks(A.as_texts(named.column(1)), A.PIECE):
                starts, ends, first = A.words_of(data, offsets, A.PLAIN)
                words = A.word_hashes(data, starts, ends)
                same = [hashlib.blake2b(words[x:y].tobytes(), digest_size=16).digest() if y > x else None for x, y in itertools.pairwise(first)]
                fresh = [k for k, s in enumerate(same) if s and s not in done and not done.update({s: []})]  # a copy in the batch is not signed again
                if fresh:
                    if len(fresh) < b - a:
                        part = [data[offsets[k]:offsets[k + 1]] for k in fresh]
                        data, offsets = np.concatenate(part), np.cumsum([0, *map(len, part)])
                    names, rows, copies = shingles(data, offsets, width)
                    samples = signatures(names, rows, weights(names, copies), len(offsets) - 1)
                    keys = band_keys(samples).view(np.int64)
                    row_of = range(b - a) if len(fresh) == b - a else range(len(fresh))
                    for k, r in zip(fresh, (r for r in row_of if len(fresh) < b - a or same[r]), strict=True):
                        done[same[k]] = keys[r].tolist()
                yield pa.RecordBatch.from_arrays([named.column(0).slice(a, b - a), pa.array(same, pa.binary()), pa.array([done[s] if s else [] for s in same], pa.list_(pa.int64()))], names=["doc_id", "same", "keys"])
    return run


# --- What a document can share at all ---

def _ask_shared(width: int, groups: int):
    """Asks which shingles of the documents of the buckets stand in another of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            texts = pa.array([X.unpressed(z) for z in batch.column("z").to_pylist()], pa.large_binary())
            for a, _, data, offsets in A.text_blocks(texts):
                names, rows, _ = shingles(data, offsets, width)
                docs, first = ids[a + rows], np.searchsorted(rows, np.arange(len(offsets)))
                yield from ask_repeated(short_names(names, groups), docs, np.arange(len(rows)) - first[rows], groups, bool((np.diff(ids[a:a + len(offsets) - 1]) > 0).all()))
    return run


_MEASURED = "doc_id long, z binary, total double, shared double"


def _weigh_shared(width: int, weights: Weights, threshold: float):
    """total and shared: the weight of all shingles of a document, and of those that another document has. Documents go whose shared part is below the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([X.unpressed(z) for z in batch.column("z").to_pylist()], pa.large_binary())
            found = batch.column("found_at").to_pylist()
            for a, b, data, offsets in A.text_blocks(texts, A.PIECE):
                names, rows, copies = shingles(data, offsets, width)
                own, first = weights(names, copies), np.searchsorted(rows, np.arange(b - a))
                known = np.zeros(len(names), bool)
                for k in range(a, b):
                    known[first[k - a] + np.frombuffer(found[k] or b"", np.int64)] = True
                total, shared = np.bincount(rows, own, b - a), np.bincount(rows, own * known, b - a)
                able = np.flatnonzero((shared >= (threshold - 1e-9) * total) & (total > 0))
                if not len(able):
                    continue
                part = batch.take(pa.array(a + able))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("z"), pa.array(total[able]), pa.array(shared[able])], names=["doc_id", "z", "total", "shared"])
    return run


def measured(bodies: DataFrame, width: int, weights: Weights, groups: int, threshold: float) -> DataFrame:
    """bodies (doc_id, z) that may have a partner, with `total` and `shared`. A similarity can't exceed what is shared: m / (total_a + total_b - m), with m the smaller `shared` of two, so a
    document that shares a passage, or was edited much, has no partner whoever it meets."""
    asked = X.dealt(bodies.mapInArrow(_ask_shared(width, groups), X.ROWS), groups, answer_repeated(groups))
    found = X.per_document(asked, groups, {X.FOUND: ("found", A.U)}).select("doc_id", "found_at")
    return bodies.join(found, "doc_id", "left").select("doc_id", "z", "found_at").mapInArrow(_weigh_shared(width, weights, threshold), _MEASURED)


# --- Verification ---

def weighted(raw: bytes, width: int, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(raw, np.uint8)
    names, _, copies = shingles(data, np.array([0, len(data)]), width)
    return names, weights(names, copies)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: the sum of the smaller weights over that of the larger ones."""
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][x], b[1][y]).sum()
    most = a[1].sum() + b[1].sum() - least
    return float(least / most) if most else 0.0


def _verify(width: int, weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def of(doc: int, z: bytes) -> tuple[np.ndarray, np.ndarray]:
            if doc not in known:
                if len(known) >= 500:
                    known.pop(next(iter(known)))
                known[doc] = weighted(X.unpressed(z), width, weights)
            return known[doc]
        for batch in batches:
            a, b, za, zb = (batch.column(c).to_pylist() for c in ("a", "b", "za", "zb"))
            found = [similarity(of(x, p), of(y, q)) for x, y, p, q in zip(a, b, za, zb, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "sim"])
    return run


class Buckets:
    """What is left to compare: a row for each document of a bucket that holds documents of several classes.

    band, key, doc, label, total, shared; for each round so far `i<k>`, the exact weight of what the document shares with the pivot of its bucket in that round (null if they were not compared), and `hit`, whether one of them was like it.
    """

    def __init__(self, rows: DataFrame, threshold: float):
        self.rows, self.threshold, self.rounds = rows, threshold, 0

    def possible(self, a: str, b: str) -> Column:
        """Whether two rows of a bucket may be alike, by bounds that lose no pair.

        With m the smaller `shared` of two, what they share weighs m at most. With a pivot c of which x has the weight i_x and y has i_y, what x and y share inside c weighs min(i_x, i_y) at most, and what they share beyond c the smaller of
        shared_x - i_x and shared_y - i_y. The similarity is at most that weight over total_x + total_y less that weight.
        """
        x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
        most = F.least(x("shared"), y("shared"))
        for k in range(self.rounds):
            by = F.least(x(f"i{k}"), y(f"i{k}")) + F.least(x("shared") - x(f"i{k}"), y("shared") - y(f"i{k}"))
            most = F.least(most, F.when(x(f"i{k}").isNotNull() & y(f"i{k}").isNotNull(), by))  # least skips a null
        return most >= F.lit(self.threshold - 1e-9) * (x("total") + y("total") - most)

    def pivots(self) -> DataFrame:
        """For each bucket the least edited document of the largest class in it among those that no pivot was like. Sums and maxima by class, so a bucket of whatever size is no task of its own."""
        edited = F.struct((F.col("shared") / F.col("total")).alias("s"), (-F.col("doc")).alias("d"), "total", "shared")
        classes = self.rows.filter("not hit").groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n"), F.max(edited).alias("one"))
        best = classes.groupBy("band", "key").agg(F.max(F.struct("n", "one")).alias("b")).select("band", "key", "b.one.*")
        return best.select("band", "key", (-F.col("d")).alias("pivot"), F.col("total").alias("p_total"), F.col("shared").alias("p_shared"))

    def met(self) -> DataFrame:
        """Each row with the pivot of its bucket, and whether the two are to be compared."""
        most = F.least("shared", "p_shared")
        able = (F.col("doc") != F.col("pivot")) & (most >= F.lit(self.threshold - 1e-9) * (F.col("total") + F.col("p_total") - most))
        return self.rows.join(self.pivots(), ["band", "key"], "left").withColumn("able", F.coalesce(able, F.lit(False)))

    def told(self, met: DataFrame, sims: DataFrame, labels: DataFrame) -> Buckets:
        """The rows after a round: what the comparisons said, new labels, and only the buckets that still hold several classes."""
        one = sims.select(F.col("a").alias("doc"), F.col("b").alias("pivot"), "sim").unionByName(sims.select(F.col("b").alias("doc"), F.col("a").alias("pivot"), "sim"))
        own = F.when(F.col("doc") == F.col("pivot"), F.col("total")).otherwise(F.col("sim") / (1 + F.col("sim")) * (F.col("total") + F.col("p_total")))
        like = F.col("hit") | F.coalesce((F.col("doc") == F.col("pivot")) | (F.col("sim") >= self.threshold), F.lit(False))
        rows = met.join(one, ["doc", "pivot"], "left").select("band", "key", "doc", "label", "total", "shared", *(f"i{k}" for k in range(self.rounds)), own.alias(f"i{self.rounds}"), like.alias("hit"))
        out = Buckets(relabelled(rows, labels), self.threshold)
        out.rounds = self.rounds + 1
        return out

    def open(self) -> tuple[Buckets, int]:
        """The rows of buckets with several classes, and their number."""
        mixed = self.rows.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("band", "key")
        rows, n = counted(self.rows.join(mixed, ["band", "key"], "left_semi"))
        out = Buckets(rows, self.threshold)
        out.rounds = self.rounds
        return out, n

    def rest(self, keys: DataFrame, known: DataFrame) -> DataFrame:
        """All pairs (a, b) of documents of a bucket, of different classes, that the bounds leave: those outside the largest class of a bucket against all, each pair in the first of its common bands.

        keys: doc, keys (of all its bands). known: doc, pivot, i (what they share, exactly): the nearest pivots of a document bound it in every bucket, whatever the pivots there.
        """
        sizes = self.rows.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("band", "key").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
        near = known.groupBy("doc").agg(F.slice(F.sort_array(F.collect_list(F.struct("i", "pivot")), False), 1, NEAREST).alias("near"))  # a pivot for each band and round at most
        rows = self.rows.join(largest, ["band", "key"]).withColumn("few", F.col("label") != F.col("largest")).drop("largest", "hit").join(keys, "doc").join(near, "doc", "left")
        rows = stored(rows)  # both sides of the join
        x, y = rows.filter("few").alias("x"), rows.alias("y")

        def by(a: Column, b: Column) -> Column:
            return F.least(a["i"], b["i"]) + F.least(F.col("x.shared") - a["i"], F.col("y.shared") - b["i"])
        both = F.least("x.shared", "y.shared")
        most = F.aggregate(F.coalesce("x.near", F.array().cast(near.schema["near"].dataType)), both, lambda m, a: F.aggregate(
            F.coalesce("y.near", F.array().cast(near.schema["near"].dataType)), m, lambda n, b: F.when(a["pivot"] == b["pivot"], F.least(n, by(a, b))).otherwise(n)))
        able = most >= F.lit(self.threshold - 1e-9) * (F.col("x.total") + F.col("y.total") - most)
        before = F.exists(F.sequence(F.lit(1), F.greatest(F.col("x.band"), F.lit(1))), lambda k: (k <= F.col("x.band")) & (F.element_at("x.keys", k) == F.element_at("y.keys", k)))
        once = ~F.col("y.few") | (F.col("x.doc") < F.col("y.doc"))
        on = (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & once & self.possible("x", "y") & able & ~before
        return x.join(y, on).select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b"))


def relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the labels that their documents have now."""
    return rows.drop("label").join(labels.toDF("doc", "label"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after new links between documents; classes are tied once each, however many of their documents are."""
    known = labels.toDF("doc", "label")
    ends = links.join(known.toDF("a", "la"), "a", "left").join(known.toDF("b", "lb"), "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    ties = components(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    fresh = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    every = labels.unionByName(fresh).join(ties.toDF("label", "new"), "label", "left")
    return stored(every.select("node", F.coalesce("new", "label").alias("label")))


def near_duplicates(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", pivots: int = PIVOTS) -> DataFrame:
    """One row per document: doc_id, class_id, the smallest id of its near-duplicate class (documents alone have their own), like_id and similarity: of the documents it was compared with and linked to, the most similar one (null without).

    Two documents are linked if the weighted Jaccard similarity of their shingles of `width` words is `threshold` or more; classes are what links connect. Texts with the same words are one
    text to begin with. Documents that share a band meet in its bucket. Those go that have too much of their own to be like any other (`measured`). In each of a few rounds all documents of a bucket are compared with
    one of them, which ties a group of copies by a comparison each; buckets of one class are done. What documents share with such a pivot also bounds what they can share with each other (`Buckets.possible`), so of
    those of different classes that are left few pairs have to be compared; all of these are, in one join. No bucket is cut, and only bounds that lose no pair are applied.
    Null, empty and blank texts are alone; rows with a null id get a null class; rows of one id are one document.
    """
    weights = weigh(docs, width, id_col, text_col)
    signed = stored(A.texts_only(docs, id_col, text_col).mapInArrow(_sign(width, weights), "doc_id long, same binary, keys array<long>"))
    distinct = stored(signed.filter("same is not null").groupBy("same").agg(F.min("doc_id").alias("rep"), F.min_by("keys", "doc_id").alias("keys")))
    entries = distinct.select(F.posexplode("keys").alias("band", "key"), F.col("rep").alias("doc"))
    shared = entries.groupBy("band", "key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low != high").select("band", "key")
    buckets = stored(entries.join(shared, ["band", "key"], "left_semi"))
    members = buckets.select(F.col("doc").alias("doc_id")).distinct()
    found = stored(X.pressed(docs, id_col, text_col).join(members, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("z").alias("z")))
    bodies = stored(measured(found, width, weights, A.groups_for(docs), threshold))

    def compared(pairs: DataFrame) -> tuple[DataFrame, int]:
        a, b = (bodies.select(F.col("doc_id").alias(x), F.col("z").alias(f"z{x}")) for x in "ab")
        both = pairs.join(b, "b").join(a, "a").select("a", "b", "za", "zb").mapInArrow(_verify(width, weights), "a long, b long, sim double")
        sims, seen = observed(both, hits=F.count_if(F.col("sim") >= threshold))
        return sims, seen["hits"]

    links = docs.sparkSession.createDataFrame([], "a long, b long, sim double")
    labels = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    sizes = bodies.select(F.col("doc_id").alias("doc"), "total", "shared")
    known = bodies.limit(0).select(F.col("doc_id").alias("doc"), F.col("doc_id").alias("pivot"), F.col("total").alias("i"))
    left, n = Buckets(buckets.join(sizes, "doc").select("band", "key", "doc", F.col("doc").alias("label"), "total", "shared", F.lit(False).alias("hit")), threshold).open()
    for round_ in range(pivots + 1):
        if not n:
            break
        if round_ < pivots:
            met = stored(left.met())
            pairs = met.filter("able").select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b")).distinct()
            known = known.unionByName(met.filter("doc = pivot").select("doc", "pivot", F.col("total").alias("i")).distinct())
        else:
            pairs = left.rest(distinct.select(F.col("rep").alias("doc"), "keys"), known.distinct())
        sims, hits = compared(pairs)
        if round_ < pivots:
            with_pivot = met.filter("able").select("doc", "pivot", "total", "p_total").distinct().withColumns({"a": F.least("doc", "pivot"), "b": F.greatest("doc", "pivot")}).join(sims, ["a", "b"])
            known = known.unionByName(with_pivot.select("doc", "pivot", (F.col("sim") / (1 + F.col("sim")) * (F.col("total") + F.col("p_total"))).alias("i")))
        if hits:
            new = sims.filter(F.col("sim") >= threshold)
            links, labels = links.unionByName(new), merged(labels, new.select("a", "b"))
        if round_ < pivots:
            left, n = left.told(met, sims, labels).open()
    reps = distinct.select("same", "rep").join(labels.toDF("rep", "label"), "rep", "left").select("same", "rep", F.coalesce("label", "rep").alias("class_id"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    best = both.groupBy(F.col("a").alias("rep")).agg(F.max(F.struct("sim", (-F.col("b")).alias("other"))).alias("best"))
    classed = signed.select("doc_id", "same").join(reps.join(best, "rep", "left"), "same", "left")
    copy = F.col("doc_id") != F.col("rep")  # its words are those of another document
    classed = classed.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.when(copy, F.col("rep")).otherwise(-F.col("best.other")).alias("like_id"), F.when(copy, 1.0).otherwise(F.col("best.sim")).alias("similarity"))
    null = lambda kind: F.lit(None).cast(kind)
    nameless = docs.filter(A.quoted(id_col).cast("long").isNull()).select(null("long").alias("doc_id"), null("long").alias("class_id"), null("long").alias("like_id"), null("double").alias("similarity"))
    return classed.unionByName(nameless)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, without those of a class that has a smaller id. Rows with a null id stay."""
    name = A.unused(docs, "copy")
    copies = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).filter("doc_id != class_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(copies, A.quoted(id_col).cast("long") == F.col(name), "left_anti")
