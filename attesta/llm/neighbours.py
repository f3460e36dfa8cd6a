"""Approximate nearest neighbours: low-dimensional stable projections indexed by kd-trees, verified in order until a chi-square test says enough."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm import arrays as A
from attesta.llm.session import stored

#: Dimensions of the projection (Gaussian, so 2-stable), and the chance with which each true neighbour is met before the search stops. With more dimensions projected distances tell near from far more sharply.
PROJECTED, CHANCE = 32, 0.93
#: Vectors in a part of the index and in a leaf of its kd-tree; and the sample that the first cuts of the space are taken from.
PART, LEAF, SAMPLE = 16_384, 256, 20_000
#: Queries that one task answers against a part at a time, and that it works on together.
QUERIES, TOGETHER = 20_000, 512


def chi_square_quantile(p: float, k: int) -> float:
    """The p-quantile of the chi-square distribution with an even number k of degrees of freedom, by bisection of its closed form."""
    def below(x: float) -> float:
        term = total = math.exp(-x / 2)
        for i in range(1, k // 2):
            term *= x / 2 / i
            total += term
        return 1 - total
    low, high = 0.0, 10.0 * k + 100
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def projection(dim: int, projected: int = PROJECTED) -> np.ndarray:
    """The same matrix on every machine."""
    return np.random.default_rng(20_141).standard_normal((dim, projected))


def kd_cells(points: np.ndarray, size: int) -> list[np.ndarray]:
    """The numbers of the points of each leaf: cut at the median of the widest dimension until `size` are left, or all are equal there."""
    todo, out = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= size:
            out.append(own)
            continue
        p = points[own]
        axis = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
        order = np.argsort(p[:, axis], kind="stable")
        half = len(own) // 2
        todo += [own[order[:half]], own[order[half:]]]
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1. They are scaled by their largest component first, so squares of very large or small ones neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


class Best:
    """The k best (cosine, id) of each query so far, best first, ties to the smaller id; and its k-th squared distance."""

    def __init__(self, queries: int, k: int, worst: np.ndarray):
        self.cosines, self.ids, self.worst, self.k = np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max), worst.astype(np.float64).copy(), k

    def add(self, query: np.ndarray, ids: np.ndarray, cosines: np.ndarray) -> None:
        """Verified candidates, a query for each."""
        near = cosines >= self.cosines[query, -1]
        query, ids, cosines = query[near], ids[near], cosines[near]
        if not len(query):
            return
        order = np.lexsort((ids, -cosines, query))
        query, ids, cosines = query[order], ids[order], cosines[order]
        starts = A.runs(query)
        place = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
        kept, own = place < self.k, query[starts]
        row = np.searchsorted(own, query[kept])
        more_cosines, more_ids = np.full((len(own), self.k), -np.inf), np.full((len(own), self.k), np.iinfo(np.int64).max)
        more_cosines[row, place[kept]], more_ids[row, place[kept]] = cosines[kept], ids[kept]
        both, names = np.hstack([self.cosines[own], more_cosines]), np.hstack([self.ids[own], more_ids])
        order = np.lexsort((names, -both), axis=1)[:, :self.k]
        self.cosines[own], self.ids[own] = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)
        last = self.cosines[own, -1]
        self.worst[own] = np.where(np.isfinite(last), np.minimum(self.worst[own], np.maximum(0.0, 2 - 2 * last)), self.worst[own])


class Tree:
    """A kd-tree of projected unit vectors: its leaves hold vectors together, and the box around each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, planes: np.ndarray, leaf: int = LEAF):
        vectors = unit(vectors)
        points = vectors @ planes
        cells = kd_cells(points, leaf)
        order = np.concatenate(cells) if cells else np.zeros(0, np.int64)
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.squares = np.einsum("ij,ij->i", self.points, self.points)
        self.cuts = np.cumsum([0, *map(len, cells)])
        self.low, self.high = (np.array([f(points[c], axis=0) for c in cells]).reshape(-1, planes.shape[1]) for f in (np.min, np.max))
        self.verified = 0

    def search(self, queries: np.ndarray, at: np.ndarray, k: int, limit: float, worst: np.ndarray) -> Best:
        """The k best of each query (unit vectors, and their projections).

        Leaves are visited by rising distance of their box, the nearest of every query in one go, then the next. A candidate is verified, its cosine taken, while its projected squared distance is at most the chi-square quantile
        `limit` times the k-th squared distance so far: the first that is farther ends the search of a leaf, the first box that is farther that of the query. `worst`: the k-th squared distance that is known already.
        """
        best = Best(len(queries), k, worst)
        away = np.zeros((len(queries), len(self.low)))
        for d in range(at.shape[1]):
            gap = np.maximum(np.maximum(self.low[:, d] - at[:, d, None], at[:, d, None] - self.high[:, d]), 0.0)
            away += gap * gap
        order = np.argsort(away, axis=1, kind="stable")
        away = np.take_along_axis(away, order, 1)
        squares = np.einsum("ij,ij->i", at, at)
        active = np.arange(len(queries))
        for step in range(order.shape[1]):
            active = active[away[active, step] <= limit * best.worst[active]]
            if not len(active):
                break
            leaves = order[active, step]
            turn = np.argsort(leaves, kind="stable")
            for group in np.split(turn, A.runs(leaves[turn])[1:]):
                own, leaf = active[group], leaves[group[0]]
                rows = slice(self.cuts[leaf], self.cuts[leaf + 1])
                far = squares[own, None] + self.squares[rows] - 2 * at[own] @ self.points[rows].T
                if not np.isfinite(best.cosines[own, -1]).all() and step == 0:  # nothing is known yet: the nearest in projection, k of them, come first
                    first = np.argsort(far, axis=1)[:, :k]
                    q = np.repeat(own, first.shape[1])
                    c = self.cuts[leaf] + first.ravel()
                    best.add(q, self.ids[c], np.einsum("ij,ij->i", queries[q], self.vectors[c]))
                    self.verified += len(q)
                    np.put_along_axis(far, first, np.inf, 1)
                q, c = np.nonzero(far <= limit * best.worst[own, None])
                if len(q):
                    self.verified += len(q)
                    some = self.vectors[rows]
                    cosines = (queries[own] @ some.T)[q, c] if 4 * len(q) > far.size else np.einsum("ij,ij->i", queries[own[q]], some[c])
                    best.add(own[q], self.ids[rows][c], cosines)
        return best


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part: with an id, no null or non-finite component, not all 0."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    out = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return out.filter(fine & F.exists("v", lambda x: x != 0.0))


def _located(dim: int, planes: np.ndarray, cuts: list[tuple[int, float, int, int]]):
    """Adds to each row its cell: the leaf of the binary cuts (axis, value, child below, child above or on it; a child < 0 is a cell) where its projection lies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = unit(_matrix(batch.column(1), dim)) @ planes
            node = np.zeros(len(points), np.int64) if cuts else np.full(len(points), -1)
            while (inside := np.flatnonzero(node >= 0)).size:
                for n in np.unique(node[inside]):
                    here = np.flatnonzero(node == n)
                    axis, value, below, above = cuts[n]
                    node[here] = np.where(points[here, axis] < value, below, above)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((-1 - node).astype(np.int32)), pa.array(list(points), pa.list_(pa.float64()))], names=["id", "v", "cell", "p"])
    return run


def top_cuts(points: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """Binary cuts of the space that deal the sample into about so many equal cells."""
    cuts: list[tuple[int, float, int, int]] = []
    count = 0

    def grow(own: np.ndarray, wanted: int) -> int:
        nonlocal count
        p = points[own]
        axis = int(np.argmax(p.max(axis=0) - p.min(axis=0))) if len(own) else 0
        value = float(np.median(p[:, axis])) if len(own) else 0.0
        below = p[:, axis] < value if len(own) else np.zeros(0, bool)
        if wanted <= 1 or not below.any():
            count += 1
            return -count
        at = len(cuts)
        cuts.append((axis, value, 0, 0))
        left = grow(own[below], wanted // 2)
        right = grow(own[~below], wanted - wanted // 2)
        cuts[at] = (axis, value, left, right)
        return at
    root = grow(np.arange(len(points)), cells)
    return cuts if root == 0 and cuts else []


_HITS = "query_id long, vec_id long, score double"


def _answer(dim: int, planes: np.ndarray, k: int, limit: float):
    """The best k of one part for each of its queries."""
    def run(key: tuple, parts: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if parts.num_rows and queries.num_rows:
            tree = Tree(parts.column("id").to_numpy(), _matrix(parts.column("v"), dim), planes)
            names, worst = queries.column("id").to_numpy(), queries.column("worst").to_numpy()
            q = unit(_matrix(queries.column("v"), dim))
            at = q @ planes
            for a in range(0, len(q), TOGETHER):
                some = slice(a, a + TOGETHER)
                best = tree.search(q[some], at[some], k, limit, worst[some])
                row, place = np.nonzero(np.isfinite(best.cosines))
                for column, value in zip(out, (names[some][row], best.ids[row, place], best.cosines[row, place]), strict=True):
                    column.append(value)
        return pa.table([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])
    return run


def _reach(projected: int, limit: float, low: np.ndarray, high: np.ndarray, cells: np.ndarray):
    """The cells, but for its own, that may hold a neighbour of each query: those whose box is not too far for its k-th distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, own, worst = _matrix(batch.column("p"), projected), batch.column("cell").to_numpy(), batch.column("worst").to_numpy()
            rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for cell, lo, hi in zip(cells.tolist(), low, high, strict=True):
                away = np.maximum(np.maximum(lo - points, points - hi), 0.0)
                hit = np.flatnonzero((np.einsum("ij,ij->i", away, away) <= limit * worst) & (own != cell))
                found.append(np.full(len(hit), cell))
                rows.append(hit)
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int32()), *(batch.column(c).take(take) for c in ("id", "v", "worst"))], names=["cell", "id", "v", "worst"])
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", projected: int = PROJECTED, chance: float = CHANCE, part: int = PART) -> DataFrame:
    """The k nearest vectors found of each query row by cosine: query_id, rank, vec_id, score; ties go to the smaller id. `is_query` is over the column `id`.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null id or with another dimension than the most frequent one. Rows of one id are
    one vector: the least by value. Fewer candidates than k give all of them.

    Equal vectors are one point of the index, which stands for its k + 1 smallest ids: no more of them can be an answer. Unit vectors are projected by a Gaussian matrix, so a projected squared
    distance is the true one times a chi-square variable. Cuts from a sample of about SAMPLE projections deal every point to a cell, and a cell of more than `part` points to several parts by hash.
    A query first searches its own cell; then every other cell whose box is not farther than the chi-square quantile allows for its k-th distance so far. Inside a part the
    leaves of a kd-tree are visited by rising distance until the same test holds, and of a leaf those points are verified that are not farther in projection. Scores are the cosines of the original vectors.
    """
    rows = usable(vectors, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = sizes["n"], sizes["count"]
    rows = rows.filter(F.size("v") == dim)
    points = stored(rows.groupBy("v").agg(F.min("id").alias("id")))
    members = stored(rows.join(points.withColumnRenamed("id", "point"), "v").select("id", "point"))
    planes, limit, wanted = projection(dim, projected), chi_square_quantile(chance, projected), k + 1
    sample = points.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE / total)))).select("v").toArrow()
    s = _matrix(sample.column("v"), dim)
    cuts = top_cuts((unit(s) if len(s) else s) @ planes, max(1, -(-total // (part // 2))))
    located = stored(points.select("id", "v").mapInArrow(_located(dim, planes, cuts), "id long, v array<double>, cell int, p array<double>"))
    # a row for each cell, of which there are about 2 * total / part: its box and the number of its parts
    box = located.groupBy("cell").agg(F.count("*").alias("n"), F.array(*(F.min(F.col("p")[i]) for i in range(projected))).alias("low"), F.array(*(F.max(F.col("p")[i]) for i in range(projected))).alias("high"))
    boxes = box.orderBy("cell").toArrow()
    low, high, cells = _matrix(boxes.column("low"), projected), _matrix(boxes.column("high"), projected), boxes.column("cell").to_numpy()
    parts = F.ceil(F.element_at(F.create_map(*(F.lit(int(x)) for c, n in zip(cells, boxes.column("n").to_numpy(), strict=True) if n > part for x in (c, n))), F.col("cell")) / part) if (boxes.column("n").to_numpy() > part).any() else F.lit(1)
    parts = F.coalesce(parts, F.lit(1)).cast("int")
    queries = stored(located.join(members.filter(is_query).select(F.col("point").alias("id")).distinct(), "id", "left_semi"))

    def search(asked: DataFrame) -> DataFrame:
        """asked: cell, id, v, worst. Every part of the cell looks for it, for some queries at a time."""
        asked = stored(asked)
        blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
        each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        spread = asked.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("part", each(parts)).select("cell", "part", "block", "id", "v", "worst")
        held = located.join(blocks, "cell").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).withColumn("block", each(F.col("blocks"))).select("cell", "part", "block", "id", "v")
        by = ("cell", "part", "block")
        return held.groupBy(*by).cogroup(spread.groupBy(*by)).applyInArrow(_answer(dim, planes, wanted, limit), _HITS)

    first = stored(search(queries.select("cell", "id", "v", F.lit(4.0).alias("worst"))))
    kth = first.groupBy(F.col("query_id").alias("id")).agg(F.sort_array(F.collect_list("score"), False).alias("s"))  # k + 1 scores from each part of a cell
    kth = kth.select("id", F.when(F.size("s") >= wanted, F.greatest(F.lit(0.0), 2 - 2 * F.col("s")[wanted - 1])).otherwise(F.lit(4.0)).alias("worst"))
    known = queries.join(kth, "id", "left").fillna(4.0, ["worst"]).select("cell", "id", "v", "p", "worst")
    found = first.unionByName(search(known.mapInArrow(_reach(projected, limit, low, high, cells), "cell int, id long, v array<double>, worst double")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= wanted).select(F.col("query_id").alias("from"), F.col("vec_id").alias("point"), "score")
    named = members.withColumn("k", F.row_number().over(Window.partitionBy("point").orderBy("id"))).filter(F.col("k") <= wanted).select("point", F.col("id").alias("vec_id"))
    asked = members.filter(is_query).select(F.col("id").alias("query_id"), F.col("point").alias("from"))
    answers = asked.join(found, "from").join(named, "point").filter("query_id != vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
