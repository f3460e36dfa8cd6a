"""Conversation prefix trie: range shards of turn-id matrices, sorted by numpy, whose column changes mark nodes; the nodes at the edges of shards recombine."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm import arrays as A
from attesta.llm import exchange as X
from attesta.llm.session import counted, observed, stored

#: Every conversation starts with up to MOST - 1 turns of the first of its group of GROUP conversations.
GROUP, MOST = 5, 9
#: Turns in a shard, columns of a matrix, shards that recombine in one task, and bytes in a piece of a list of ends.
SHARD_TURNS, COLUMNS, FAN, PIECE = 250_000, 16, 64, 1 << 20
#: The id of a turn is a hash that is never PAD, which fills the rows of a matrix behind their end and sorts first.
PAD = np.iinfo(np.int64).min
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- Conversations as rows of turn ids ---

def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text with the defaults filled in; rows without a conversation take no part."""
    q = A.quoted
    return conversations.select(q(conv_col).cast("long").alias("conv_id"), q(turn_col).cast("long").alias("turn"), F.coalesce(q(role_col).cast("string"), F.lit("")).alias("role"),
                                F.coalesce(q(text_col).cast("string"), F.lit("")).alias("text")).filter("conv_id is not null")


def _gathered(turns: DataFrame) -> DataFrame:
    """base, conv_id, t: the turns of a conversation in order, as structs of turn, tie, id and size."""
    number = F.xxhash64("role", "text")
    slim = turns.select((F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), "conv_id",
                        F.struct("turn", "tie", F.when(number == F.lit(int(PAD)), F.lit(0)).otherwise(number).alias("id"), F.octet_length("text").cast("int").alias("size")).alias("t"))
    return slim.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))


def sequences(turns: DataFrame) -> DataFrame:
    """base, conv_id, seq: the turns of each conversation in order, as structs of `id` and `size` (UTF-8 bytes of the text); base is the first conversation of its group.

    Turns of one number come by role, then text. Only ids, sizes and turn numbers travel; the texts of conversations in which different turns tie are read again and compared.
    """
    plain = stored(_gathered(turns.withColumn("tie", F.lit(0))))
    distinct = [F.size(F.array_distinct(F.transform("t", f))) for f in (lambda x: x["turn"], lambda x: F.struct(x["turn"], x["id"]))]
    tied, n = counted(plain.filter(distinct[0] < distinct[1]).select("conv_id"))
    if n:
        ranked = turns.join(tied, "conv_id", "left_semi").withColumn("tie", F.rank().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")))
        plain = stored(plain.join(tied, "conv_id", "left_anti").unionByName(_gathered(ranked).select(plain.columns)))
    return plain.select("base", "conv_id", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["size"].alias("size"))).alias("seq"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """conv_id, ids, sizes: the first h turns of the group's first conversation, if it is there, then the own turns behind the first h; h is the crc32 of the id mod MOST."""
    heads = seqs.filter("conv_id = base").select("base", F.slice("seq", 1, MOST - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST).cast("int")
    none = F.slice("seq", 1, 0)
    both = seqs.join(heads, "base", "left").select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), h), none), F.slice("seq", h + 1, F.greatest(F.size("seq") - h, F.lit(0)))).alias("seq"))
    return both.select("conv_id", F.col("seq.id").alias("ids"), F.col("seq.size").alias("sizes"))


# --- Nodes of a shard ---

#: A row is a node that is complete (DONE), one that a neighbouring shard may also hold (OPEN), or a part of the list of ends of such a node (ENDS).
DONE, OPEN, ENDS = 0, 1, 2
_NODES = ("kind int, shard int, piece int, path long, parent long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, "
          "at_first boolean, at_last boolean, ends_sha256 string, ends binary")
_TYPES = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _NODES.split(", ")])
_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
ROOT = np.int64(0)


def _rows(kind: int, n: int, **columns) -> pa.RecordBatch:
    """n rows of one kind; columns that are not given are null, numbers are repeated."""
    columns["kind"] = kind
    out = []
    for field in _SCHEMA:
        value = columns.get(field.name)
        if value is None:
            out.append(pa.nulls(n, field.type))
        elif isinstance(value, pa.Array):
            out.append(value)
        else:
            out.append(pa.array(np.full(n, value) if isinstance(value, int) else value, field.type))
    return pa.RecordBatch.from_arrays(out, schema=_SCHEMA)


def _fewer(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """The rows of many small batches in larger ones."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or batch.nbytes > PIECE // 2:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches(rows)
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(rows)


def _step(path: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The name of a node from that of its parent and the id of its turn."""
    return A.mix(path.view(A.U) * A.STEP + A.mix(ids.view(A.U) + A.U(0x632BE59BD9B4E019))).view(np.int64)


@dataclass
class Level:
    """The nodes of one depth: name, place of the parent in the level above, UTF-8 bytes of the last text, smallest member and members; then, for the conversations that reach this depth (`rows`), the
    node of each and whether it ends there."""

    path: np.ndarray
    parent: np.ndarray
    size: np.ndarray
    conv: np.ndarray
    n: np.ndarray
    rows: np.ndarray
    row_node: np.ndarray
    ends: np.ndarray


def matrix_levels(convs: np.ndarray, lengths: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> list[Level]:
    """The trie of some conversations, a level for each depth; ids and sizes are flat, a conversation after the other.

    Some columns at a time, the rows that reach them form a matrix of turn ids, padded behind their ends, which is sorted by the node that they come from, then column by column, then conversation. A change of a
    column or of one before it (an accumulated OR) marks the first row of a node; what a node holds is summed between the marks.
    """
    starts = np.cumsum(lengths) - lengths
    rows = np.arange(len(convs))
    node = np.zeros(len(rows), np.int64)
    levels = [Level(np.array([ROOT]), np.array([-1]), np.zeros(1, np.int64), np.array([convs.min()]), np.array([len(convs)]), rows, node, lengths == 0)]
    depth = 0
    while (go := lengths[rows] > depth).any():
        rows, node = rows[go], node[go]
        width = int(min(COLUMNS, (lengths[rows] - depth).max()))
        column = np.arange(width)
        inside = depth + column < lengths[rows][:, None]
        at = np.where(inside, (starts[rows] + depth)[:, None] + column, 0)
        matrix = np.where(inside, ids[at], PAD)
        order = np.lexsort((convs[rows], *matrix.T[::-1], node))
        rows, node, matrix, inside, at = rows[order], node[order], matrix[order], inside[order], at[order]
        change = np.empty(matrix.shape, bool)
        change[:1], change[1:] = True, matrix[1:] != matrix[:-1]
        change[1:, 0] |= node[1:] != node[:-1]
        change = np.logical_or.accumulate(change, axis=1)
        above = node
        for j in range(width):
            on = np.flatnonzero(inside[:, j])
            if not len(on):
                break
            marks = np.flatnonzero(change[on, j])
            first = on[marks]
            own = np.cumsum(change[on, j]) - 1
            parent = above[first]
            levels.append(Level(_step(levels[-1].path[parent], matrix[first, j]), parent, sizes[at[first, j]].astype(np.int64), np.minimum.reduceat(convs[rows[on]], marks),
                                np.diff(np.append(marks, len(on))), rows[on], own, lengths[rows[on]] == depth + j + 1))
            above = np.full(len(rows), -1)
            above[on] = own
        node = above
        depth += width
    return levels


def _end_lists(convs: np.ndarray, level: Level) -> dict[int, np.ndarray]:
    """The conversations that end at each node of a level which has such; ascending."""
    which, own = level.row_node[level.ends], convs[level.rows[level.ends]]
    order = np.lexsort((own, which))
    which, own = which[order], own[order]
    cuts = np.append(A.runs(which), len(which))
    return {int(which[a]): own[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)}


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _edge(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: bool) -> list[int]:
    """The first or the last sequence in the order of the ranges, found column by column; a sequence comes before those that it starts."""
    rows, out = np.arange(len(starts)), []
    while True:
        over = lengths[rows] > len(out)
        if not (over.all() if first else over.any()):
            return out
        rows = rows[over]
        turns = ids[starts[rows] + len(out)]
        out.append(int(turns.min() if first else turns.max()))
        rows = rows[turns == out[-1]]


def _on_path(levels: list[Level], sequence: list[int]) -> list[int]:
    """The node of each depth on the path of a sequence."""
    out = [0]
    for d, turn in enumerate(sequence):
        name = _step(levels[d].path[out[-1]:out[-1] + 1], np.array([turn]))
        out.append(int(np.flatnonzero(levels[d + 1].path == name[0])[0]))
    return out


def shard_nodes(shard: int, convs: np.ndarray, lengths: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard, from the deepest to the root. Those on the path of its first or last conversation are OPEN, with sums over what is complete below them."""
    levels, starts = matrix_levels(convs, lengths, ids, sizes), np.cumsum(lengths) - lengths
    paths = [_on_path(levels, _edge(ids, starts, lengths, first)) for first in (True, False)]
    edge = [[np.isin(np.arange(len(x.n)), path[d:d + 1]) for path in paths] for d, x in enumerate(levels)]
    children, leaves, saved = (np.zeros(0, np.int64) for _ in range(3))
    for d in range(len(levels) - 1, -1, -1):
        x, (at_first, at_last) = levels[d], edge[d]
        if not len(children):  # nothing lies deeper
            children, leaves, saved = (np.zeros(len(x.n), np.int64) for _ in range(3))
        open_ = at_first | at_last
        done, left = np.flatnonzero(~open_), np.flatnonzero(open_)
        leaves[done] += children[done] == 0
        saved[done] += (x.n[done] - 1) * x.size[done]
        ends = _end_lists(convs, x)
        shown = {"shard": shard, "path": x.path, "depth": np.full(len(x.n), d), "conv_id": x.conv, "n_convs": x.n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "size": x.size}
        if d:
            above, hidden = levels[d - 1], edge[d - 1][0] | edge[d - 1][1]
            shown["parent"] = above.path[x.parent]
        else:
            shown["parent"] = np.zeros(1, np.int64)
        pick = lambda at, columns=shown: {c: v if isinstance(v, int) else v[at] for c, v in columns.items()}
        if len(done):
            hashes = [hashlib.sha256(_joined(ends[k])).hexdigest() if k in ends else NO_ENDS for k in done.tolist()]
            yield _rows(DONE, len(done), **pick(done), ends_sha256=hashes, parent_conv_id=pa.array(above.conv[x.parent[done]], pa.int64(), mask=hidden[x.parent[done]]))
        if len(left):
            yield _rows(OPEN, len(left), **pick(left), at_first=at_first[left], at_last=at_last[left])
        for k in left.tolist():
            text = _joined(ends[k]) if k in ends else b""
            for piece, a in enumerate(range(0, len(text), PIECE)):
                yield _rows(ENDS, 1, shard=shard, piece=piece, path=x.path[k:k + 1], ends=[text[a:a + PIECE]])
        if d:
            up = [np.zeros(len(above.n), np.int64) for _ in range(3)]
            for total, part in zip(up, (np.ones(len(x.n), np.int64), leaves, saved), strict=True):
                np.add.at(total, x.parent[done], part[done])
            children, leaves, saved = up


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if own := [b for b in batches if b.num_rows]:
        table = pa.Table.from_batches(own).combine_chunks()
        lists, sizes = (table.column(c).chunk(0) for c in ("ids", "sizes"))
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ids, sizes = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (lists, sizes))
        yield from _fewer(shard_nodes(TaskContext.get().partitionId(), table.column("conv_id").to_numpy(), lengths, ids, sizes))


# --- Nodes of several shards ---

def _recombine(everything: bool):
    """Adds up the open nodes of neighbouring shards. What lies on no outer edge of them is complete then; what does stays open, unless these are all shards."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = {f.name: table.column(f.name).to_numpy() for f in _SCHEMA if f.name not in ("piece", "parent_conv_id", "ends_sha256", "ends", "kind")}
        order = np.lexsort((column["path"], column["depth"]))
        column = {c: v[order] for c, v in column.items()}
        marks = np.flatnonzero(np.append(True, (column["path"][1:] != column["path"][:-1]) | (column["depth"][1:] != column["depth"][:-1])))
        n, children, leaves, saved = (np.add.reduceat(column[c], marks) for c in _SUMS)
        path, parent, depth, size = (column[c][marks] for c in ("path", "parent", "depth", "size"))
        conv, shard = np.minimum.reduceat(column["conv_id"], marks), column["shard"]
        at_first, at_last = (np.logical_or.reduceat(column[c].astype(bool) & (shard == s), marks) for c, s in (("at_first", shard.min()), ("at_last", shard.max())))
        open_ = np.zeros(len(marks), bool) if everything else at_first | at_last
        cuts = np.append(A.runs(depth), len(depth)).tolist()
        above = np.full(len(marks), -1)
        for x, a, b in zip(cuts, cuts[1:], cuts[2:]):  # sorted by depth, then path: parents are found in the span before
            above[a:b] = x + np.searchsorted(path[x:a], parent[a:b])
        for a, b in zip(cuts[-2::-1], cuts[:0:-1], strict=True):
            done = a + np.flatnonzero(~open_[a:b])
            leaves[done] += children[done] == 0
            saved[done] += (n[done] - 1) * size[done]
            if a:
                np.add.at(children, above[done], 1)
                np.add.at(leaves, above[done], leaves[done])
                np.add.at(saved, above[done], saved[done])
        shown = {"path": path, "parent": parent, "depth": depth, "conv_id": conv, "n_convs": n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "size": size}
        done, left = np.flatnonzero(~open_), np.flatnonzero(open_)
        yield _rows(DONE, len(done), **{c: v[done] for c, v in shown.items()}, parent_conv_id=pa.array(conv[above[done]], pa.int64(), mask=(above[done] < 0) | open_[above[done]]))
        yield _rows(OPEN, len(left), **{c: v[left] for c, v in shown.items()}, shard=int(shard.min()), at_first=at_first[left], at_last=at_last[left])
    return work


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, ends from the sorted pieces of each list, as they come: nothing is held but the state of the hash."""
    def told(path: int, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path], pa.int64()), pa.array([state.hexdigest()])], names=["path", "ends"])
    path = shard = state = None
    for batch in batches:
        for own, of, piece in zip(*(batch.column(c).to_pylist() for c in ("path", "shard", "ends")), strict=True):
            if own != path:
                if state:
                    yield told(path, state)
                path, shard, state = own, of, hashlib.sha256()
            elif of != shard:
                state.update(b",")
                shard = of
            state.update(piece)
    if state:
        yield told(path, state)


_RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Names of nodes that shards share are broadcast if they are no more than this.
BROADCAST = 1_000_000


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS, fan: int = FAN) -> DataFrame:
    """A row for each node of the trie of conv_id, ids, sizes (`rebuilt`): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are dealt into ranges by (ids, conv_id), so a group of copies is cut like anything else, and the ends of a node come in order over its shards. A shard completes all nodes but
    those on the paths of its first and its last conversation. These are added up, `fan` neighbouring shards at a time, then as many of those, until one task has what is still open.
    A list of ends that shards share travels in pieces; a SHA-256 can't be cut, so the pieces of one list are hashed one after the other, by a task that holds one of them at a time.

    Without conversations there is no node, not even the root; conversations without turns are members of the root alone. A conversation is one row, of 12 bytes a turn. Turns and nodes are the same
    when their 64-bit hashes are, those of a node within its depth.
    """
    spark = convs.sparkSession
    convs, seen = observed(convs, turns=F.sum(F.size("ids")), convs=F.count(F.lit(1)))
    if not seen["convs"]:
        return spark.createDataFrame([], _RESULT)
    shards = max(1, -(-(seen["turns"] + seen["convs"]) // shard_turns))
    nodes = stored(convs.repartitionByRange(shards, "ids", "conv_id").mapInArrow(_shards, _NODES))
    shared, open_ = None, nodes.filter(F.col("kind") == OPEN)
    while True:
        groups = open_.agg(F.max("shard")).first()[0] // fan + 1
        merged = stored(X.dealt(open_.withColumn("grp", F.floor(F.col("shard") / fan).cast("int")), groups, _recombine(groups == 1), _NODES))
        complete = merged.filter(F.col("kind") == DONE)
        shared = complete if shared is None else shared.unionByName(complete)
        if groups == 1:
            break
        open_ = merged.filter(F.col("kind") == OPEN).withColumn("shard", F.floor(F.col("shard") / fan).cast("int"))
    pieces = nodes.filter(F.col("kind") == ENDS).select("path", "shard", "piece", "ends")
    hashed = pieces.repartition("path").sortWithinPartitions("path", "shard", "piece").mapInArrow(_hash_ends, "path long, ends string")
    shared, n = counted(shared.drop("ends_sha256", "ends").join(hashed, "path", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))))
    columns = ["conv_id", "depth", "parent", "parent_conv_id", *_SUMS, "ends_sha256"]
    every = nodes.filter(F.col("kind") == DONE).select(columns).unionByName(shared.select(columns))
    parents = shared.select(F.col("path").alias("parent"), F.col("conv_id").alias("shared_conv"))
    known = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "shared_conv"))
    return every.join(F.broadcast(parents) if n <= BROADCAST else parents, "parent", "left").select("conv_id", "depth", known.alias("parent_conv_id"), *_SUMS, "ends_sha256")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of the rebuilt conversations (see `rebuilt`, `trie`). A null role or text is empty, a null turn comes first, rows with a null conversation take no part; repeated rows are turns of their own."""
    return trie(rebuilt(sequences(turn_rows(conversations, conv_col, turn_col, role_col, text_col))), shard_turns)
