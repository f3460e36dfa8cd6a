"""A hidden Markov language model: Baum-Welch counts summed over partitions train latent states, a scaled forward recursion gives the exact likelihood of a text.

A state emits symbols. A word with a share of all words of 1 / OWN or more is a symbol of its own; the others share SHARED symbols by their endings, and a symbol that is shared gives each of its words a chance by the word's own count in the
training texts. So every word of the corpus is counted, and what a state learns is as large as OWN and SHARED allow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A
from attesta.llm import exchange as X
from attesta.llm.session import observed, stored
from attesta.llm.sums import summed, summed_parts

STATES, ROUNDS = 8, 5
#: Fewer than OWN words are symbols of their own; SHARED, a power of two, is the number of symbols of all others.
OWN, SHARED = 16_384, 2048
#: What a count gains before logarithms are taken, and how much a state's emissions are drawn to the symbols' shares.
ALPHA, PRIOR = 0.1, 100.0
#: Tokens that are scanned one after the other (a longer text is cut into stretches of at most so many), between scalings, and in a block; MB of pressed texts for each group of names.
STRETCH, EVERY, TOKENS, GROUP_MB = 4096, 8, 2_000_000, 24
END = 0
_FLAG = A.U(1)


def held_out(id_col: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, mod 10, is 0, or there is no id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 10 == 0, F.lit(True))


# --- Words ---

def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names, first): 64 bits for each word of texts with A-Z lowered, and the number of each text's first word. Bits 1 to 11 are the shared symbol, a hash of the last three bytes; bit 0 is free."""
    data = A.LOWER[data]
    starts, ends, first = A.words_of(data, offsets, A.PLAIN)
    names = A.word_hashes(data, starts, ends)
    ending = np.zeros(len(starts), np.uint32)
    for k in (1, 2, 3):
        inside = ends - k >= starts
        ending = ending * np.uint32(257) + np.where(inside, data[np.maximum(ends - k, 0)], 256).astype(np.uint32)
    ending = (ending * np.uint32(0x9E3779B1)) >> np.uint32(32 - (SHARED.bit_length() - 1))
    return (names & ~A.U(2 * SHARED - 1)) | (ending.astype(A.U) << _FLAG), first


def shared_symbol(names: np.ndarray) -> np.ndarray:
    return ((names >> _FLAG) & A.U(SHARED - 1)).astype(np.int64)


def _group(names: np.ndarray, groups: int) -> np.ndarray:
    return ((names >> A.U(24)) % A.U(groups)).astype(np.int64)


def _landed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A number for each row, and its text compressed."""
    part, row = TaskContext.get().partitionId() << 40, 0
    for batch in batches:
        n = batch.num_rows
        texts = A.as_texts(batch.column(2)).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(part + row, part + row + n), pa.int64()), batch.column(0), batch.column(1), pa.array(map(X.press, texts), pa.binary())], names=["row", "doc_id", "train", "z"])
        row += n


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, names, first) of blocks of landed texts."""
    for batch in batches:
        texts = pa.array([X.unpressed(z) for z in batch.column("z").to_pylist()], pa.large_binary())
        for a, b, data, offsets in A.text_blocks(texts):
            yield batch.slice(a, b - a), *words(data, offsets)


def _runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct, counts) of sorted values."""
    starts = A.runs(values)
    return values[starts], np.diff(np.append(starts, len(values)))


_COUNTS = "grp int, n long, v long, names binary, counts binary"


def _count_block(groups: int):
    """For each group the distinct words of a block, with bit 0 set for those of training texts, and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, names, first in _blocks(batches):
            train = np.repeat(rows.column("train").to_numpy(zero_copy_only=False).astype(A.U), np.diff(first))
            names, counts = _runs_of(np.sort(names | train))
            yield from _packed(names, counts, _group(names, groups))
    return run


def _packed(names: np.ndarray, counts: np.ndarray, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(group, kind="stable")
    names, counts, group = names[order], counts[order], group[order]
    cuts = np.append(A.runs(group), len(group)).tolist()
    parts = [(int(group[a]), int(counts[a:b].sum()), b - a, X.squeeze(np.diff(names[a:b], prepend=A.U(0))), X.squeeze(counts[a:b].astype(np.uint64))) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] if len(group) else []
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*parts, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["grp", "n", "v", "names", "counts"])


def _unpacked(names: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(X.unsqueeze(names, None, A.U), dtype=A.U), X.unsqueeze(counts, None, np.uint64).astype(np.int64)


def _add_counts(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """One row for a group: its words and their counts over all blocks."""
    parts = [_unpacked(x, y) for x, y in zip(table.column("names").to_pylist(), table.column("counts").to_pylist(), strict=True)]
    names, counts = np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts])
    order = np.argsort(names, kind="stable")
    starts = A.runs(names[order])
    yield from _packed(names[order][starts], np.add.reduceat(counts[order], starts), np.full(len(starts), table.column("grp")[0].as_py()))


def _words_of(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(names, counts, counts in training texts) of the words of each group."""
    for names, counts in map(_unpacked, rows.column("names").to_pylist(), rows.column("counts").to_pylist()):
        starts = A.runs(names >> _FLAG)
        learned = np.where((names & _FLAG).astype(bool), counts, 0)
        yield names[starts] & ~_FLAG, np.add.reduceat(counts, starts), np.add.reduceat(learned, starts)


def _frequent(least: float):
    """The words with a count of `least` or more, with that in training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, every, train in _words_of(batch):
                own = every >= least
                yield pa.RecordBatch.from_arrays([pa.array(names[own].view(np.int64)), pa.array(train[own])], names=["name", "tokens"])
    return run


def _totals(least: float):
    """Of all other words, the tokens and the distinct words of training texts by shared symbol; then both of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, every_word = np.zeros((2, SHARED)), np.zeros(2)
        for batch in batches:
            for names, every, train in _words_of(batch):
                rest, own = shared_symbol(names), every >= least
                total += [np.bincount(rest, np.where(own, 0, x), SHARED) for x in (train, train > 0)]
                every_word += [train.sum(), (train > 0).sum()]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int32()), pa.array([TaskContext.get().partitionId()] * 3, pa.int32()), pa.array([r.tobytes() for r in (*total, every_word)], pa.binary())], names=["place", "task", "sums"])
    return run


@dataclass(frozen=True)
class Vocabulary:
    """`own`: sorted names of the words that are symbols; `counts`: training counts of the symbols END, own, shared; `kinds`: distinct training words of the shared ones; N training tokens, V distinct ones."""

    own: np.ndarray
    counts: np.ndarray
    kinds: np.ndarray
    n: int
    v: int

    @property
    def first_shared(self) -> int:
        return 1 + len(self.own)

    def place(self, names: np.ndarray) -> np.ndarray:
        """The place of each word among `own`, or -1."""
        if not len(self.own):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.own, names), len(self.own) - 1)
        return np.where(self.own[at] == names, at, -1)

    def symbols(self, names: np.ndarray) -> np.ndarray:
        at = self.place(names)
        return np.where(at >= 0, 1 + at, self.first_shared + shared_symbol(names)).astype(np.uint16)

    def own_logs(self) -> np.ndarray:
        """By symbol: log10 of what the count of END or a word of its own gives to the base score; 0 for shared ones."""
        logs = np.log10(self.counts + ALPHA)
        logs[self.first_shared:] = 0
        return logs

    def shared_logs(self) -> np.ndarray:
        """By symbol: log10 of what the counts of the words of a shared symbol are divided by; 0 for the others, each its only word."""
        logs = np.zeros(len(self.counts))
        logs[self.first_shared:] = np.log10(self.counts[self.first_shared:] + ALPHA * (self.kinds + 1))
        return logs


def vocabulary(landed: DataFrame, groups: int, ends: int) -> Vocabulary:
    """Counts every word of all texts, in blocks first, then by name. The driver gets fewer than OWN words, and the totals of SHARED symbols."""
    counts, seen = observed(X.dealt(landed.mapInArrow(_count_block(groups), _COUNTS), groups, _add_counts, _COUNTS), n=F.coalesce(F.sum("n"), F.lit(0)))
    least = max(seen["n"], 1) / OWN
    own = counts.mapInArrow(_frequent(least), "name long, tokens long").toPandas()
    names = own["name"].to_numpy(np.int64).view(A.U)
    order = np.argsort(names)
    parts = summed_parts(counts.mapInArrow(_totals(least), "place int, task int, sums binary"))
    tokens, kinds, every = (parts.get(k, np.zeros(SHARED)).astype(np.int64) for k in range(3))
    return Vocabulary(names[order], np.concatenate([[ends], own["tokens"].to_numpy(np.int64)[order], tokens]), kinds, int(every[0]) + ends, int(every[1]) + (ends > 0))


def _spelled(vocab: Vocabulary):
    """The symbols of every text, END last, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, names, first in _blocks(batches):
            symbols = np.insert(vocab.symbols(names), first[1:], END)
            cuts = first + np.arange(len(first))
            packed = [X.squeeze(symbols[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("row", "doc_id", "train")), pa.array(np.diff(cuts), pa.int64()), pa.array(packed, pa.binary())], names=["row", "doc_id", "train", "n_tokens", "z"])
    return run


# --- The model ---

@dataclass(frozen=True)
class Model:
    """start: states; move: states by states; emit: states by symbols. Each state's chances sum to 1."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def relative(self) -> tuple[Model, np.ndarray]:
        """The same model with the chances of each symbol divided by their mean, so that products stay near 1, and the logarithms of those means."""
        mean = self.emit.mean(axis=0)
        return Model(self.start, self.move, self.emit / mean), np.log(mean)


def shares(vocab: Vocabulary) -> np.ndarray:
    """What the base score, a model of one state, gives each symbol: ALPHA more for each word known, and ALPHA in all, over the shared symbols, for words that are not."""
    gains = np.full(len(vocab.counts), ALPHA)
    gains[vocab.first_shared:] *= vocab.kinds + 1 / SHARED
    return (vocab.counts + gains) / (vocab.counts + gains).sum()


def first_model(vocab: Vocabulary, states: int = STATES) -> Model:
    """The same random departures from the symbols' shares on every run."""
    emit = shares(vocab) * (np.random.default_rng(1966).gamma(1.0, 1.0, (states, len(vocab.counts))) + 0.1)
    move = np.full((states, states), 0.5 / states) + 0.5 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))


class Stretches:
    """Texts cut into stretches, longest first: `active[t]` of them, the first ones, have a token t, and symbols[at[t]:at[t + 1]] are those tokens."""

    def __init__(self, texts: list[np.ndarray], longest: int = STRETCH):
        lengths = np.array([len(t) for t in texts])
        self.parts = -(-lengths // longest)
        of = np.repeat(np.arange(len(texts)), self.parts)
        number = np.arange(len(of)) - np.repeat(np.cumsum(self.parts) - self.parts, self.parts)
        begins, ends = lengths[of] * number // self.parts[of], lengths[of] * (number + 1) // self.parts[of]
        order = np.argsort(begins - ends, kind="stable")
        self.of, self.number, self.sizes = of[order], number[order], (ends - begins)[order]
        self.last = self.number + 1 == self.parts[self.of]
        self.active = np.searchsorted(-self.sizes, -np.arange(self.sizes[0]), "left")
        self.at = np.concatenate([[0], np.cumsum(self.active)])
        column = np.empty(len(order), np.int64)
        column[order] = np.arange(len(order))
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(ends - begins) - (ends - begins), ends - begins)
        self.symbols = np.empty(lengths.sum(), np.int64)
        self.symbols[self.at[step] + np.repeat(column, ends - begins)] = np.concatenate(texts)
        closing = np.flatnonzero(self.last)
        by = closing[np.argsort(self.sizes[closing], kind="stable")]
        cuts = np.searchsorted(self.sizes[by], np.arange(1, len(self.active) + 2))
        self.ends = [by[cuts[t]:cuts[t + 1]] for t in range(len(self.active))]  # the stretches in which a text ends with token t

    def some(self, columns: np.ndarray, times: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, active) of some stretches, each so many times."""
        active = np.searchsorted(columns, self.active)
        chosen = np.zeros(len(self.of), bool)
        chosen[columns] = True
        place = np.arange(len(self.symbols)) - np.repeat(self.at[:-1], self.active)
        return np.repeat(self.symbols[chosen[place]], times), active * times


def forward(model: Model, symbols: np.ndarray, active: np.ndarray, state: np.ndarray, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(state, logs): scaled forward recursion, states by stretches. `state` is what is expected before the first token of each stretch and, in the end, behind its last; logs: the sum of the natural logarithms of
    the scales, which are taken off every EVERY tokens. `kept` gets the state at each token, in the scale it has there."""
    state, logs = state.copy(), np.zeros(state.shape[1])
    turned, at = np.ascontiguousarray(model.move.T), 0
    for t, m in enumerate(active.tolist()):
        if not m:
            break
        now = np.take(model.emit, symbols[at:at + m], axis=1)
        now *= state[:, :m]
        if kept is not None:
            kept[:, at:at + m] = now
        at += m
        state[:, :m] = turned @ now
        if t % EVERY == EVERY - 1:
            total = state[:, :m].sum(axis=0)
            state[:, :m] /= total
            logs[:m] += np.log(total)
    total = state.sum(axis=0)
    return state / total, logs + np.log(total)


def _chained(model: Model, s: Stretches) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, behind, logs) for texts of several stretches: the state expected before each stretch, what the tokens behind it say of the state after it, and the log likelihood of each text as its chain gives it.

    A stretch is a linear map of the state before it, found by scanning it once from each state; maps are applied along a text in both directions. Texts of one stretch keep the start.
    """
    k = len(model.start)
    before, behind = np.tile(model.start[:, None], (1, len(s.of))), np.ones((k, len(s.of)))
    logs = np.zeros(len(s.parts))
    many = np.flatnonzero(s.parts[s.of] > 1)
    if len(many):
        maps, scales = forward(model, *s.some(many, k), np.tile(np.eye(k), (1, len(many))))
        maps, scales = maps.T.reshape(-1, k, k), scales.reshape(-1, k)  # by stretch, state before, state after
        most = scales.max(axis=1)
        maps = maps * np.exp(scales - most[:, None])[:, :, None]
        order = np.lexsort((s.number[many], s.of[many])).tolist()
        state = model.start
        for j in order:
            column = many[j]
            state = model.start if s.number[column] == 0 else state
            before[:, column] = state
            state = state @ maps[j]
            total = state.sum()
            logs[s.of[column]] += most[j] + np.log(total)
            state = state / total
        for j in reversed(order):
            column = many[j]
            state = np.ones(k) if s.last[column] else state
            behind[:, column] = state
            state = maps[j] @ state
            state = state / state.sum()
    return before, behind, logs


def log_likelihoods(model: Model, texts: list[np.ndarray], longest: int = STRETCH) -> np.ndarray:
    """The exact natural logarithm of the chance of each sequence of symbols."""
    model, common = model.relative()
    s = Stretches(texts, longest)
    _, _, out = _chained(model, s)
    one = np.flatnonzero(s.parts[s.of] == 1)
    if len(one):
        _, logs = forward(model, *s.some(one), np.tile(model.start[:, None], (1, len(one))))
        out[s.of[one]] = logs
    return out + np.array([common[t].sum() for t in texts])


def expected_counts(model: Model, texts: list[np.ndarray], longest: int = STRETCH) -> np.ndarray:
    """Baum-Welch counts of some texts, a row for each state: its emissions by symbol, its moves to each state, its starts. Stretches know what stands before and behind them, so counts are those of whole texts."""
    model, _ = model.relative()
    s, k = Stretches(texts, longest), len(model.start)
    before, behind, _ = _chained(model, s)
    a = np.empty((k, len(s.symbols)))
    forward(model, s.symbols, s.active, before, a)
    moves = np.zeros((k, k))
    weight = np.empty((k, 0))  # what a token and all behind it say of its state
    for t in range(len(s.active) - 1, -1, -1):
        m, here = int(s.active[t]), slice(s.at[t], s.at[t + 1])
        if m > weight.shape[1]:
            weight = np.hstack([weight, behind[:, weight.shape[1]:m]])
        now = a[:, here]
        beta = model.move @ weight
        share = now * beta
        total = share.sum(axis=0)
        counted = now / total
        end = s.ends[t]  # no move leaves the last token of a text
        if len(end):
            counted[:, end] = 0
        moves += counted @ weight.T
        np.divide(share, total, out=now)
        weight = np.take(model.emit, s.symbols[here], axis=1)
        weight *= beta
        if t % EVERY == 0:
            weight /= weight.sum(axis=0)
    moves *= model.move
    emitted = np.stack([np.bincount(s.symbols, row, model.emit.shape[1]) for row in a])
    starts = a[:, :s.at[1]][:, s.number == 0].sum(axis=1)
    return np.hstack([emitted, moves, starts[:, None]])


def _token_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows and their symbols, about TOKENS at a time, or a longer text."""
    held: list[pa.RecordBatch] = []
    size = 0

    def given() -> tuple[pa.RecordBatch, list[np.ndarray]]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return rows, [X.unsqueeze(z, None, np.uint16) for z in rows.column("z").to_pylist()]
    for batch in batches:
        counts = batch.column("n_tokens").to_numpy()
        a = 0
        while a < batch.num_rows:
            upto = size + np.cumsum(counts[a:])
            b = a + max(int(not held), int(np.searchsorted(upto, TOKENS, "right")))
            if b > a:
                held.append(batch.slice(a, b - a))
                size += int(counts[a:b].sum())
            if b < batch.num_rows:
                yield given()
                held, size = [], 0
            a = b
    if held:
        yield given()


def _expect(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, texts in _token_blocks(batches):
            part = expected_counts(model, texts)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(np.full(len(total), TaskContext.get().partitionId()), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                                             names=["place", "task", "sums"])
    return run


def improved(vocab: Vocabulary, counts: np.ndarray) -> Model:
    """The model that expected counts give, emissions drawn to the symbols' shares a little."""
    s, k = len(vocab.counts), len(counts)
    emit = counts[:, :s] + PRIOR * shares(vocab)
    move, start = counts[:, s:s + k] + 1.0, counts[:, -1] + 1.0
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def train(spelled: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all training texts: each round is one pass in which a task sends a row of sums for each state. Without training texts the first model stays."""
    model, rows = first_model(vocab, states), spelled.filter("train").select("n_tokens", "z")
    for _ in range(rounds):
        counts = summed(rows.mapInArrow(_expect(model), "place int, task int, sums binary"))
        if not len(counts):
            break
        model = improved(vocab, counts)
    return model


# --- Scores ---

def _scored(model: Model, vocab: Vocabulary):
    """The model's log10 chance of the symbols, and what words of their own and totals of shared symbols give."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shared, known = vocab.own_logs(), vocab.shared_logs(), np.append(vocab.counts[:vocab.first_shared] > 0, np.zeros(SHARED, bool))
        for rows, texts in _token_blocks(batches):
            logs = log_likelihoods(model, texts) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("row", "doc_id", "train", "n_tokens")), pa.array(logs), pa.array([float(own[t].sum()) for t in texts]),
                                              pa.array([float(shared[t].sum()) for t in texts]), pa.array([int(known[t].sum()) for t in texts], pa.int64())],
                                             names=["row", "doc_id", "train", "n_tokens", "chain", "own_log", "shared_log", "own_known"])
    return run


def _ask(vocab: Vocabulary, groups: int):
    """The distinct words of a document that share a symbol ask for their training counts, with how often they stand there and whether the document trains."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, names, first in _blocks(batches):
            of = np.repeat(np.arange(rows.num_rows), np.diff(first))
            rare = vocab.place(names) < 0
            of, names = of[rare], names[rare]
            order = np.argsort(names, kind="stable")
            order = order[np.argsort(of[order].astype(np.uint16 if rows.num_rows < 1 << 16 else np.int64), kind="stable")]
            of, names = of[order], names[order]
            starts = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (of[1:] != of[:-1]))) if len(names) else np.zeros(0, np.int64)
            times, of, names = np.diff(np.append(starts, len(names))), of[starts], names[starts]
            row, learn = rows.column("row").to_numpy(), rows.column("train").to_numpy(zero_copy_only=False).astype(A.U)
            yield from X.pack(X.ASK, _group(names, groups), row[of], times, names | learn[of])
    return run


def _answer(groups: int):
    """To every word of every document its training count."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows, times, names = X.unpack(table, X.ASK, A.U)
        order = np.argsort(names >> _FLAG, kind="stable")
        starts = A.runs((names >> _FLAG)[order])
        learned = np.where((names & _FLAG).astype(bool), times, 0)
        counts = np.empty(len(rows), A.U)
        counts[order] = np.repeat(np.add.reduceat(learned[order], starts), np.diff(np.append(starts, len(order)))).astype(A.U)
        yield from X.pack(X.FOUND, A.doc_group(rows, groups), rows, times, counts)
    return work


def _rare_sums(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """For each document: the sum of log10(c + ALPHA) over its words that share a symbol, and how many of them are known."""
    rows, times, counts = X.unpack(table, X.FOUND, A.U)
    order = np.argsort(rows, kind="stable")
    rows, times, counts = rows[order], times[order], counts[order].astype(np.float64)
    starts = A.runs(rows)
    if len(starts):
        yield pa.RecordBatch.from_arrays([pa.array(rows[starts], pa.int64()), pa.array(np.add.reduceat(times * np.log10(counts + ALPHA), starts)), pa.array(np.add.reduceat(np.where(counts > 0, times, 0), starts), pa.int64())],
                                         names=["row", "rare_log", "rare_known"])


def score_texts(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the model's chance of the whole text, its end among the tokens).

    Words are runs of anything but white space, A-Z lowered. A null or empty text is its end alone. Nothing is learned from rows that are `held_out`, those with a null id among them; repeated rows count, and are scored, as often as
    they stand there. Words are told apart by 64-bit hashes. A word that is not a symbol stands in a share of less than 1 / OWN of the words, so the group that
    answers for its name stays small, however frequent a word may be.
    """
    learn = ~held_out(A.quoted(id_col))
    rows = docs.select(A.quoted(id_col).cast("long").alias("doc_id"), learn.alias("train"), A.quoted(text_col).cast("string").alias("text"))
    landed, seen = observed(rows.mapInArrow(_landed, "row long, doc_id long, train boolean, z binary"), ends=F.count_if("train"), size=F.coalesce(F.sum(F.octet_length("z")), F.lit(0)))
    groups = max(A.groups_for(docs), seen["size"] // (GROUP_MB << 20))
    vocab = vocabulary(landed, groups, seen["ends"])
    spelled = stored(landed.mapInArrow(_spelled(vocab), "row long, doc_id long, train boolean, n_tokens long, z binary"))
    model = train(spelled, vocab, states, rounds)
    scored = spelled.mapInArrow(_scored(model, vocab), "row long, doc_id long, train boolean, n_tokens long, chain double, own_log double, shared_log double, own_known long")
    answers = X.dealt(landed.select("row", "train", "z").mapInArrow(_ask(vocab, groups), X.ROWS), groups, _answer(groups))
    rare = X.dealt(answers, groups, _rare_sums, "row long, rare_log double, rare_known long")
    both = scored.join(rare, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    of_all = F.lit(float(np.log10(vocab.n + ALPHA * (vocab.v + 1))))
    return both.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("own_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(vocab.n).cast("long").alias("train_tokens"),
                       (F.col("own_log") + rare_log - F.col("n_tokens") * of_all).alias("base_score"), (F.col("chain") + rare_log - F.col("shared_log")).alias("score"))
