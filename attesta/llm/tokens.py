"""Token counts of a piece tokenizer by dynamic programming over prefixes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from attesta.llm import arrays as A

SPACE = "▁"
#: Chunks and pairs that a worker keeps, and the longest chunk that it keeps.
KEPT, KEPT_PAIRS, KEPT_CHARS = 500_000, 500_000, 48


class PrefixCounter:
    """Exact token counts of every prefix under a byte-pair piece model with byte fallback.

    A sequence of pieces is the model's output if and only if every two neighbours are what the model makes of their joined text: merges that cross a
    boundary depend on the two pieces beside it only. So each prefix has exactly one last piece: the one that ends there, stands by itself, and
    follows the last piece of the prefix before it. Its count is that prefix's count and one (or the bytes of a character the model doesn't know).
    """

    def __init__(self, model_file: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.longest = max(map(len, self.score))
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("the model has pieces with a space after another character")
        # what the model does with a text before it looks for pieces has to be known: spaces marked, one put before, nothing else
        if model.encode("a  b", out_type=str) != model.encode("a  b ", out_type=str)[:len(model.encode("a  b", out_type=str))] or model.decode(model.encode(" a  b ")) != " a  b ":
            raise ValueError("the model normalises its texts")
        # only pieces that the model leaves whole can be an output
        self.stable = {p for p in self.score if self.merged(p) == [p]}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.chunk = re.compile(self._chunk_pattern())
        # the longest whole piece that ends in these two characters
        self.reach: dict[str, int] = {}
        for p in self.stable:
            if len(p) > 1:
                self.reach[p[-2:]] = max(self.reach.get(p[-2:], 0), len(p))
        self.chunks: dict[str, np.ndarray] = {}
        self.totals: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """The model's own rule on a short text: merge the best pair, the leftmost on ties, until none is a piece."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _chunk_pattern(self) -> str:
        """A text falls apart wherever no piece reaches over: before a space mark that follows another character, around line ends,
        and, if the pieces are such, before a character that isn't a letter and follows one."""
        other, letter = f"(?:[^\\w{SPACE}\\n]|[\\d_])", "[^\\W\\d_]"
        if any("\n" in p and len(p) > 1 or re.search(f"{letter}{other}", p) for p in self.score):
            return f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"
        return f"\n|{SPACE}+{other}*{letter}*|{other}+{letter}*|{letter}+"

    def learn(self, a: str, b: str) -> bool:
        """Whether piece b can follow piece a, kept for the next time."""
        if self.n_pairs >= KEPT_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        known = self.pairs.setdefault(a, {})[b] = self.merged(a + b) == [a, b]
        return known

    def prefixes(self, chunk: str) -> list[int]:
        """counts[i]: the tokens of chunk[:i]. Spaces are marked."""
        n, stable, score, pairs, reach = len(chunk), self.stable, self.score, self.pairs, self.reach
        counts, last = [0] * (n + 1), [""] * (n + 1)
        for j in range(1, n + 1):
            i = j - reach.get(chunk[j - 2:j], 1) if j > 1 else 0
            if i < 0:
                i = 0
            while i < j:
                piece = chunk[i:j]
                if piece in stable or i == j - 1:
                    if not i:
                        break
                    before = last[i]
                    known = pairs.get(before)
                    ok = known.get(piece) if known is not None else None
                    if ok is None:
                        ok = self.learn(before, piece)
                    if ok:
                        break
                i += 1
            else:
                raise AssertionError("a prefix without a last piece")
            last[j] = piece
            counts[j] = counts[i] + (1 if piece in score else len(piece.encode()))
        return counts

    def chunk_counts(self, chunk: str) -> np.ndarray:
        known = self.chunks.get(chunk)
        if known is None:
            known = np.array(self.prefixes(chunk), np.int32)
            if len(chunk) <= KEPT_CHARS:
                if len(self.chunks) >= KEPT:
                    self.chunks.clear()
                self.chunks[chunk] = known
        return known

    def total(self, chunk: str) -> int:
        known = self.totals.get(chunk)
        if known is None:
            known = self.prefixes(chunk)[-1]
            if len(chunk) <= KEPT_CHARS:
                if len(self.totals) >= KEPT:
                    self.totals.clear()
                self.totals[chunk] = known
        return known

    @staticmethod
    def marked(text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def count(self, text: str) -> int:
        """The tokens of a text."""
        return sum(self.total(c) * k for c, k in Counter(self.chunk.findall(self.marked(text))).items())

    def all_counts(self, text: str) -> np.ndarray:
        """counts[i]: the tokens of text[:i], for every i from 0 to the length."""
        if not text:
            return np.zeros(1, np.int64)
        out, base = [np.zeros(1, np.int64)], 0
        for k, chunk in enumerate(self.chunk.findall(self.marked(text))):
            own = self.chunk_counts(chunk)
            out.append(base + own[1 if k else 2:].astype(np.int64))  # the mark put before the text is no character of it
            base += int(own[-1])
        return np.concatenate(out)


@lru_cache(2)
def counter(model_file: str) -> PrefixCounter:
    """One counter for a worker process, with what it has learnt."""
    return PrefixCounter(model_file)


def public_model(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def _model(model: str) -> str:
    return model if "/" in model else public_model(model)


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8) and n_tokens, as the tokenizer library counts them without begin and end tokens.

    `model` names a public tokenizer file, looked up where the task runs, or is a path that every executor has. Null texts count as empty; empty texts have no tokens; repeated rows
    give repeated rows. No shuffle; a worker keeps the counts of a bounded number of chunks, a longer chunk is counted each time, in time linear in its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(_model(model))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(A.buffers(A.as_texts(batch.column(1)))[1]), pa.int64()), pa.array([own.count(t) if t else 0 for t in texts], pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])
    return A.texts_only(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def fit_budgets(docs: DataFrame, budgets: tuple[int, ...], model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens and `cuts`, for each budget the length in code points of the longest prefix that has no more tokens.

    All answers come from the one array of prefix counts; no prefix is encoded again. Null texts count as empty.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(_model(model))
        for batch in batches:
            totals, cuts = [], []
            for text in batch.column(1).to_pylist():
                counts = own.all_counts(text or "")
                totals.append(int(counts[-1]))
                cuts.append([int(np.flatnonzero(counts <= b)[-1]) if b >= 0 else None for b in budgets])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(cuts, pa.list_(pa.int64()))], names=["doc_id", "n_tokens", "cuts"])
    return A.texts_only(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, cuts array<long>")


def digest(counts: DataFrame, limit: int = 4096) -> DataFrame:
    """The columns of the query."""
    return counts.selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {limit} over_limit")
