"""One story told by several outlets counts once."""

from __future__ import annotations

import itertools
import uuid
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta import config as cfg
from attesta.functions.text import word_set
from attesta.operators.skew import rank_within, top_per_group
from attesta.session import land, scratch

#: Pairs that a round may form for each posting. Where whole buckets keep to that, all are compared at once; else so many of the newest of each bucket as keep to it, FEWEST at least.
PAIRS_PER_POSTING, FEWEST = 32, 16
#: Bits of the sketch of a word set.
BITS = 1024
#: Blocks of at most so many pairs for each of their words are compared in tiles of at most TILE items, about TILE_WORDS words; larger ones meet by their rarest words.
PAIRS_PER_WORD, TILE, TILE_WORDS = 4000, 8192, 2_000_000
#: Items of a tile that are decided at once, items that they are compared with at once, and pairs that are compared a second time at once.
BATCH, STRIP, AGAIN = 256, 512, 16_384
#: So many pairs or ids at most go to every task.
NEAR = 100_000


@F.pandas_udf(T.ArrayType(T.LongType()))
def _sketch(hashes: pd.Series) -> pd.Series:
    """BITS bits of each word set, in longs: whether an odd number of its words falls on the bit. Two sets differ in as many words as bits, or more."""
    odd = lambda h: np.bincount(np.asarray(h, np.int64) & (BITS - 1), minlength=BITS) & 1
    return pd.Series([np.packbits(odd([] if h is None else h).astype(np.uint8)).view(np.int64) for h in hashes], dtype=object)


def _far(a: str, b: str) -> Column:
    """In how many bits two sketches differ."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(BITS // 64)), F.lit(0))


def _wanted(part: float, n: Column) -> Column:
    """The least whole number of words that is `part` of n or more; the small term keeps products on their own side of a whole number."""
    return F.ceil(F.lit(part) * n - 1e-9)


def postings(bags: DataFrame, id: str, newest: str, thr: float) -> DataFrame:
    """Slim rows (word of a block as one hash, id, newest, size, place): the places of an item's rarest words, for the words that another item of the block has.

    Words are ordered by their frequency in the block. Two items with a Jaccard of `thr` share a word among the first n - ceil(t n) + 1 of either, and among the first n - ceil(2 t n / (1 + t)) + 1
    of the smaller one (`_lead`). Words that one item alone has come first, so they are places that need no row.
    """
    words = bags.select("_g", id, newest, "_n", F.explode("_h").alias("_word")).withColumn("_word", F.xxhash64("_g", "_word")).drop("_g")
    shared = words.groupBy("_word").agg(F.count(F.lit(1)).alias("_f")).filter("_f > 1")
    own = Window.partitionBy(id)
    place = F.col("_n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("_f", "_word"))
    rows = words.join(shared, "_word").withColumn("_at", place.cast("int"))
    rows = rows.filter(F.col("_at") <= F.col("_n") - _wanted(thr, F.col("_n")) + 1)
    return rows.withColumn("_lead", F.col("_at") <= F.col("_n") - _wanted(2 * thr / (1 + thr), F.col("_n")) + 1).drop("_f")


def _pivots(open_: DataFrame) -> int | None:
    """How many items of each bucket the others are compared with in this round: None for all."""
    steps = [FEWEST * 4 ** k for k in range(12)]
    sizes = open_.groupBy("_word").agg(F.count(F.lit(1)).alias("f"))
    row = sizes.agg(F.sum("f").alias("rows"), F.sum(F.col("f") * F.col("f")).alias("all"), *(F.sum(F.col("f") * F.least("f", F.lit(s))).alias(f"s{s}") for s in steps)).first()
    bound = PAIRS_PER_POSTING * (row["rows"] or 0)
    if (row["all"] or 0) <= bound:
        return None
    return max(s for s in steps if s == FEWEST or row[f"s{s}"] <= bound)


def _alike(thr: float) -> Column:
    """Whether the word sets _a and _b have a Jaccard of `thr`."""
    same = F.size(F.array_intersect("_a", "_b"))
    return same >= F.lit(thr) * (F.size("_a") + F.size("_b") - same) - 1e-12


def _links(open_: DataFrame, top: DataFrame, bags: DataFrame, whole_buckets: bool, block: list[str], id: str, newest: str, thr: float) -> DataFrame:
    """(id, _p): items and newer ones like them, each pair once: candidates share a bucket, may be alike by their sizes and by what is left behind the word they share, and are compared by their words then, if their sketches do not tell them apart."""
    right = top.select("_word", *(F.col(c).alias(f"_p{c}") for c in (id, newest, "_n", "_at", "_lead")))
    n, pn, at, pat = (F.col(c) for c in ("_n", "_p_n", "_at", "_p_at"))
    needed = _wanted(thr / (1 + thr), n + pn)
    newer = (F.col(f"_p{newest}") > F.col(newest)) | ((F.col(f"_p{newest}") == F.col(newest)) & (F.col(f"_p{id}") < F.col(id)))
    leads = ((n >= pn) & F.col("_p_lead")) | ((pn >= n) & F.col("_lead"))
    fits = (F.least(n, pn) >= F.lit(thr) * F.greatest(n, pn) - 1e-9) & (F.least(at, pat) + F.least(n - at, pn - pat) >= needed)
    met = open_.join(right, "_word").filter(newer & leads & fits)
    pairs = met.groupBy(id, F.col(f"_p{id}").alias("_p")).agg(F.count(F.lit(1)).alias("_c"), F.max(at).alias("_at"), F.max(pat).alias("_p_at"), F.first("_n").alias("_n"), F.first("_p_n").alias("_p_n"))
    if whole_buckets:  # all words that both lead with were counted, so no more is shared than those and what stands behind the last of them
        pairs = pairs.filter(F.col("_c") + F.least(n - at, pn - pat) >= needed)
    sketches, near = bags.select(id, "_s"), _far("_s", "_ps") <= n + pn - 2 * needed
    pairs = pairs.select(id, "_p", "_n", "_p_n").join(sketches.select(F.col(id).alias("_p"), F.col("_s").alias("_ps")), "_p").join(sketches, id).filter(near).select(id, "_p").distinct()
    own, other = bags.select(id, *block, F.col("_h").alias("_a")), bags.select(F.col(id).alias("_p"), *(F.col(c).alias(f"_b_{c}") for c in block), F.col("_h").alias("_b"))
    alike = _alike(thr)
    for c in block:
        alike = alike & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return pairs.select(id, "_p").join(other, "_p").join(own, id).filter(alike).select(id, "_p")


def _decided(links: DataFrame, whole: DataFrame, id: str) -> tuple[DataFrame, DataFrame]:
    """(stays, gone) among the items of links, as far as they can be decided: an item goes with a newer one that stays; it stays if it was compared with all it meets (`whole`) and all newer ones like it are gone."""
    nodes = links.select(id).unionByName(links.select(F.col("_p").alias(id))).distinct().join(whole.withColumn("_whole", F.lit(True)), id, "left")
    first = nodes.join(links.select(id).distinct().withColumn("_linked", F.lit(True)), id, "left")
    state = land(first.select(id, "_whole", F.when(F.col("_linked").isNull() & F.col("_whole"), "stays").alias("_is")))
    open_before = None
    while True:
        known = state.select(F.col(id).alias("_p"), F.col("_is").alias("_p_is"))
        said = links.join(known, "_p").groupBy(id).agg(F.bool_or(F.coalesce(F.col("_p_is") == "stays", F.lit(False))).alias("_hit"), F.bool_and(F.coalesce(F.col("_p_is") == "gone", F.lit(False))).alias("_free"))
        told = F.when(F.col("_is").isNotNull(), F.col("_is")).when(F.col("_hit"), "gone").when(F.col("_free") & F.col("_whole"), "stays")
        state = land(state.join(said, id, "left").select(id, "_whole", told.alias("_is")))
        open_ = state.filter("_is is null").count()
        if open_ in (0, open_before):
            return state.filter("_is = 'stays'").select(id), state.filter("_is = 'gone'").select(id)
        open_before = open_


def _level(n: np.ndarray, thr: float) -> np.ndarray:
    """The logarithm of the bits of a tile's sketch for sets of `n` words: 8 to 16 bits a word, twice as many below a Jaccard of 0.4."""
    return np.maximum(np.ceil(np.log2(np.maximum(n, 1))).astype(int) + (3 if thr >= 0.4 else 4), 6)


def _parity(h: np.ndarray, at: np.ndarray, rows: np.ndarray, level: int) -> np.ndarray:
    """Like `_sketch`, of 2 ** level bits, for some rows of a list column given as values and offsets."""
    n = at[rows + 1] - at[rows]
    out = np.zeros((len(rows), 1 << level - 6), np.uint64)
    for i in range(0, len(rows), step := max(1, (1 << 22) >> level)):
        some, m = rows[i:i + step], n[i:i + step]
        place = np.arange(m.sum()) + np.repeat(at[some] - (np.cumsum(m) - m), m)
        bit = (np.repeat(np.arange(len(some)), m) << level) + (h[place] & ((1 << level) - 1))
        odd = np.bincount(bit, minlength=len(some) << level) & 1
        out[i:i + step] = np.packbits(odd.astype(np.uint8)).view(np.uint64).reshape(len(some), -1)
    return out


def _narrow(z: np.ndarray, level: int) -> np.ndarray:
    """Sketches as those of 2 ** level bits, which is no more than they have."""
    while z.shape[1] > 1 << level - 6:
        half = z.shape[1] // 2
        z = z[:, :half] ^ z[:, half:]
    return z


class _Sketches:
    """Items by the level of their sketches: {level: (places of items, sketches)}, and the sizes of all."""

    def __init__(self, n: np.ndarray, thr: float, made):
        self.n, self.thr, level, by_size = n.astype(np.int64), thr, _level(n, thr), np.argsort(n, kind="stable")
        self.by = {int(x): (i := by_size[level[by_size] == x], made(i, int(x))) for x in np.unique(level)}

    def near(self, other: "_Sketches", mine: np.ndarray, theirs: np.ndarray):
        """(place of mine, place of theirs) of the pairs of chosen items that sizes and sketches do not tell apart: sketches folded to a part first, whole ones for the pairs that are left."""
        thr, found = self.thr, []
        most = lambda n, m: n + m - 2 * np.ceil(thr / (1 + thr) * (n + m) - 1e-9)
        for x, (i, z) in self.by.items():
            on = mine[i]
            i, z = i[on], z[on]
            for y, (j, w) in other.by.items():
                on = theirs[j]
                if not len(i) or not on.any():
                    continue
                j, level = j[on], min(x, y)
                part = max(level - (2 if thr >= 0.4 else 1), 6)
                z_, w_ = _narrow(z, level), _narrow(w[on], level)
                a, b = np.ascontiguousarray(_narrow(z_, part).T), np.ascontiguousarray(_narrow(w_, part).T)
                for s in range(0, len(j), STRIP):
                    n, m = self.n[i][:, None], other.n[j[s:s + STRIP]][None, :]
                    fits = np.minimum(n, m) >= thr * np.maximum(n, m) - 1e-9
                    if not fits.any():
                        continue
                    far = np.zeros(fits.shape, np.int32)
                    for k in range(len(a)):
                        far += np.bitwise_count(a[k][:, None] ^ b[k][None, s:s + STRIP])
                    p, q = np.nonzero(fits & (far <= most(n, m)))
                    for t in range(0, len(p), step := max(1, AGAIN * 16 // z_.shape[1])):
                        u, v = p[t:t + step], q[t:t + step] + s
                        near = np.bitwise_count(z_[u] ^ w_[v]).sum(1, dtype=np.int64) <= most(self.n[i[u]], other.n[j[v]])
                        found.append((i[u[near]], j[v[near]]))
        return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, int)] * 2


def _kept(table: pa.Table, thr: float) -> tuple[np.ndarray, _Sketches]:
    """Which items of a tile, newest first, stay: each is compared with those before it that stay."""
    lists = table["_h"].combine_chunks()
    h, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().astype(np.int64)
    n = np.diff(at)
    all_ = _Sketches(n, thr, lambda rows, level: _parity(h, at, rows, level))
    stays, sets = np.zeros(len(n), bool), {}

    def words(i):
        if i not in sets:
            sets[i] = np.sort(h[at[i]:at[i + 1]])
        return sets[i]

    def alike(i, j):
        same = np.intersect1d(words(i), words(j), assume_unique=True).size
        return same >= thr * (n[i] + n[j] - same) - 1e-12

    for s in range(0, len(n), BATCH):
        now = np.zeros(len(n), bool)
        now[s:s + BATCH] = True
        older, newer = all_.near(all_, now, stays | now)
        meets: dict[int, list[int]] = {}
        for i, j in zip(older.tolist(), newer.tolist()):
            if j < i:
                meets.setdefault(i, []).append(j)
        for i in range(s, min(s + BATCH, len(n))):
            stays[i] = not any(stays[j] and alike(i, j) for j in meets.get(i, ()))
        for i in [i for i in sets if not stays[i]]:
            del sets[i]
    return stays, all_


def _tiled(bags: DataFrame, block: list[str], id: str, newest: str, thr: float, sizes: DataFrame, rounds: list[int] | None) -> DataFrame:
    """(id) of the items that stay, of blocks that are compared whole: they are cut, newest first, into tiles. In a round one tile of each block is decided by itself, and those of it that stay are compared with all later tiles.

    Only sketches of a size in proportion to the word sets meet other tiles; word sets are fetched for the pairs that those leave. A group of near copies costs a comparison each, as all but its newest go.
    """
    spark = bags.sparkSession
    out = T.StructType([*(bags.schema[c] for c in (*block, id)), T.StructField("_n", T.IntegerType()), T.StructField("_z", T.BinaryType())])
    ranked = rank_within(bags.withColumn("_tie", F.xxhash64("_h")), block, [(newest, "desc"), id, "_tie"], "_place")
    same = [ranked[c].eqNullSafe(sizes[c]) for c in block]
    items = ranked.join(sizes, same).select(*(ranked[c] for c in block), id, "_n", "_h", "_place", "_tiles", F.floor((F.col("_place") - 1) * F.col("_tiles") / F.col("_items")).cast("int").alias("_tile"))
    tasks = 4 * spark.sparkContext.defaultParallelism
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    items.write.partitionBy("_tile").parquet(path)
    items = spark.read.schema(items.schema).parquet(path)
    last = sizes.agg(F.max("_tiles")).first()[0]

    def packed(table: pa.Table, sketches: _Sketches, some: np.ndarray) -> pa.Table:
        z = [b""] * len(some)
        for i, rows in sketches.by.values():
            for p, r in zip(i, rows):
                z[p] = r.tobytes()
        cols = [table[c] for c in (*block, id, "_n")] + [pa.array(z, pa.binary())]
        return pa.table(cols, names=out.names).filter(pa.array(some))

    def decided(table: pa.Table) -> pa.Table:
        table = table.sort_by("_place")
        stays, sketches = _kept(table, thr)
        return packed(table, sketches, stays)

    def sketched(batches):
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                lists = table["_h"].combine_chunks()
                h, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().astype(np.int64)
                made = _Sketches(np.diff(at), thr, lambda rows, level: _parity(h, at, rows, level))
                slim = packed(table, made, np.ones(len(table), bool))
                yield from slim.append_column("_tile", table["_tile"]).to_batches()

    def met(table: pa.Table) -> pa.Table:
        halves = [table.filter(pa.array(table["_kept"].to_numpy() == side)) for side in (False, True)]
        made = []
        for half in halves:
            z = half["_z"].to_pylist()
            made.append(_Sketches(half["_n"].to_numpy(), thr, lambda rows, level: np.frombuffer(b"".join(z[i] for i in rows), np.uint64).reshape(len(rows), -1)))
        every = [np.ones(len(half), bool) for half in halves]
        parts = [(np.zeros(0, int), np.zeros(0, int))]
        for s in range(0, len(halves[0]), BATCH):
            now = np.zeros(len(halves[0]), bool)
            now[s:s + BATCH] = True
            parts.append(made[0].near(made[1], now, every[1]))
        i, j = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
        return pa.table([halves[0][id].take(pa.array(i)), halves[1][id].take(pa.array(j))], names=[id, "_p"])

    later = None
    if last > 1:
        later = land(items.filter("_tile > 0").mapInArrow(sketched, T.StructType([*out, T.StructField("_tile", T.IntegerType())])))
    near = lambda d: F.broadcast(d) if d.count() <= NEAR else d
    stay, gone = [], None
    for k in range(last):
        without = lambda d: d if gone is None else d.join(gone, id, "left_anti")
        now = without(items.filter(F.col("_tile") == k))
        if rounds is not None:
            rounds.append(now.count())
        kept = land(now.select(*block, id, "_n", "_h", "_place").repartition(tasks, *block).groupBy(*block).applyInArrow(decided, out))
        stay.append(kept.select(id))
        if k + 1 == last:
            break
        to = kept.join(sizes, [kept[c].eqNullSafe(sizes[c]) for c in block]).filter(F.col("_tiles") > k + 1)
        to = to.select(*(kept[c] for c in block), id, "_n", "_z", F.explode(F.sequence(F.lit(k + 1), (F.col("_tiles") - 1).cast("int"))).alias("_tile"), F.lit(True).alias("_kept"))
        rest = without(later.filter(F.col("_tile") > k)).withColumn("_kept", F.lit(False))
        both = to.unionByName(rest).repartition(tasks, *block, "_tile")
        pairs = land(both.groupBy(*block, "_tile").applyInArrow(met, T.StructType([bags.schema[id], T.StructField("_p", bags.schema[id].dataType)])))
        older, newer = items.filter(F.col("_tile") > k).select(id, F.col("_h").alias("_a")), items.filter(F.col("_tile") == k).select(F.col(id).alias("_p"), F.col("_h").alias("_b"))
        found = near(pairs).join(older, id).join(newer, "_p").filter(_alike(thr)).select(id).distinct()
        gone = near(land(found if gone is None else gone.unionByName(found)))
    return reduce(DataFrame.unionByName, stay)


def suppress_near_dups(df: DataFrame, block, words: str | None = None, thr: float = cfg.STORY_JACCARD, id: str = "item_id",
                       newest: str = "published", title: str = "title", pivots: int | None = None, rounds: list[int] | None = None, tile: int | None = None) -> DataFrame:
    """Within a block (account, trigger, calendar month) the newest copy stays: an item is dropped when its word set has a
    Jaccard of at least `thr` with an item that stays and is newer. Items without words always stay.

    The rule is greedy in time order. Items with equal word sets collapse to their newest first. Blocks of a usual size are compared whole, in tiles of their items (`_tiled`). The items of larger ones, or of all if `pivots` is given,
    meet by their rarest words (`_bucketed`). Words are compared by 64-bit hashes. pivots: the newest of a
    bucket that a round takes, in place of its own choice. rounds: gets the number of open items of each round. tile: items of a tile, in place of TILE.
    Order: `newest` descending, then the unique id.
    """
    block = [block] if isinstance(block, str) else list(block)
    order = [F.col(newest).desc(), F.col(id).asc()]
    bag = F.sort_array(F.array_distinct(F.col(words) if words else word_set(title)))
    bags = df.select(*block, id, newest, bag.alias("_w")).withColumn("_sig", F.sha2(F.array_join("_w", " "), 256))
    # the newest row of each word set; rows without words stand for themselves
    alone = F.when(F.size("_w") == 0, F.col(id).cast("string")).otherwise(F.col("_sig"))
    bags = bags.select(*block, id, newest, alone.alias("_sig"), F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"), F.size("_w").alias("_n"))
    bags = land(top_per_group(bags, [*block, "_sig"], order, 1).drop("_sig"))
    # ids that are null match nothing; an item without a time is neither newer nor older than another
    dated = bags.filter((F.col("_n") > 0) & F.col(id).isNotNull() & F.col(newest).isNotNull())
    sizes = dated.groupBy(*block).agg(F.count(F.lit(1)).alias("_items"), F.sum("_n").alias("_words"))
    sizes = land(sizes.withColumn("_tiles", F.greatest(F.ceil(F.col("_items") / (tile or TILE)), F.ceil(F.col("_words") / TILE_WORDS))).withColumn(
        "_whole", F.lit(pivots is None) & (F.col("_items") * F.col("_items") <= 2 * PAIRS_PER_WORD * F.col("_words"))))
    within = lambda d, some: d.join(some, [d[c].eqNullSafe(some[c]) for c in block], "left_semi")
    told = {r["_whole"] for r in sizes.select("_whole").distinct().collect()}
    ids = bags.filter(~F.coalesce((F.col("_n") > 0) & F.col(newest).isNotNull(), F.lit(False))).select(id)
    if True in told:
        whole = sizes.filter("_whole")
        ids = ids.unionByName(_tiled(within(dated, whole) if False in told else dated, block, id, newest, thr, whole, rounds))
    if False in told:
        ids = ids.unionByName(_bucketed(within(dated, sizes.filter("not _whole")) if True in told else dated, block, id, newest, thr, pivots, rounds))
    return df.join(ids, id, "left_semi")


def _bucketed(bags: DataFrame, block: list[str], id: str, newest: str, thr: float, pivots: int | None, rounds: list[int] | None) -> DataFrame:
    """(id) of the items that stay, of blocks of any size.

    What is shuffled is slim: a row of numbers for each of an item's rarest words that another item has. Items meet in the buckets of such words; pairs that size or place rule out are not formed, and
    sketches of a fixed size tell most of the others apart, and word sets are fetched once for each pair that is left. Where a bucket is so large that its pairs would be more than a few for each row, only its newest items are compared with
    the others in a round: one that is among them in all its buckets and has no open newer match stays, one that matches an item that stays is dropped, then the next links are decided.
    So no bucket is cut, a group of near copies costs a few comparisons each, and rounds follow chains of matches, not the size of a block.
    """
    order = [F.col(newest).desc(), F.col(id).asc()]
    bags = land(bags.withColumn("_g", F.xxhash64(*block)).withColumn("_s", _sketch("_h")))
    open_ = land(postings(bags, id, newest, thr))
    stay = [bags.select(id).join(open_.select(id).distinct(), id, "left_anti")]
    if rounds is not None:
        rounds.append(bags.count())
    for round_ in itertools.count():
        if not open_.count():
            break
        if rounds is not None and round_:
            rounds.append(open_.select(id).distinct().count())
        most = pivots or _pivots(open_)
        everyone = open_.select(id).distinct()
        if most is None:
            top, whole = open_, everyone
        else:
            top = land(top_per_group(open_, ["_word"], order, most))
            seen = open_.groupBy(id).agg(F.count(F.lit(1)).alias("_all")).join(top.groupBy(id).agg(F.count(F.lit(1)).alias("_in")), id)
            whole = seen.filter("_all = _in").select(id)  # all newer items of its buckets are pivots, and so is it
        links, whole = land(_links(open_, top, bags, most is None, block, id, newest, thr)), land(whole)
        met, gone = _decided(links, whole, id)
        kept = land(whole.join(links.select(id).unionByName(links.select(F.col("_p").alias(id))).distinct(), id, "left_anti").unionByName(met))
        stay.append(kept)
        if most is None:
            break
        open_ = land(open_.join(kept, id, "left_anti").join(gone, id, "left_anti"))
    return reduce(DataFrame.unionByName, stay)
