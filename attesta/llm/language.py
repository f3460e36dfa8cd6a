"""Language ID by a string kernel: blended-spectrum n-gram presence, Nystroem landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A

#: Labelled rows of a language that the model is fitted to, and how many of them are landmarks. The bound is the sample's, not the corpus's.
SAMPLE, LANDMARKS = 150, 40
#: A labelled row in the sample counts in so many code points from a place that its hash gives: it is training material. Predictions read whole texts, in stretches
#: of so many at most: what share of the features occurs depends on the length, so stretches are compared with stretches.
SAMPLE_CHARS = 4000
#: n-grams of 1 to GRAMS bytes of the lowered text, hashed to this many features.
GRAMS, FEATURES = 3, 1 << 13
RIDGE = 1e-2
#: How steep the score rises with the margin between the two best classes.
STEEP = 4.0
#: Stretches of documents in one matrix product.
ROWS = 128
UNKNOWN = "und"


def _grams(data: np.ndarray) -> list[np.ndarray]:
    """The feature of the n-gram that starts at each byte, for each n."""
    x, out = data.astype(np.uint32), []
    code = np.zeros(len(x), np.uint32)
    for n in range(1, GRAMS + 1):
        if len(x) < n:
            break
        code = code[:len(x) - n + 1] * np.uint32(257) + x[n - 1:] + np.uint32(1)
        h = code * np.uint32(0x9E3779B1) + np.uint32(n)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        out.append((h >> np.uint32(32 - 13)).astype(np.int32))
    return out


def presence(texts: list[str]) -> np.ndarray:
    """A row for each text: 1 / sqrt(n) where one of its n features occurs, so that products are kernel values between 0 and 1."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for row, text in zip(out, texts, strict=True):
        for codes in _grams(np.frombuffer(text.lower().encode(), np.uint8)):
            row[codes] = 1
        if n := row.sum():
            row /= np.sqrt(n)
    return out


@dataclass(frozen=True)
class Model:
    """landmarks: features by landmarks; weights: landmarks by languages (Nystroem map and ridge solution in one)."""

    languages: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray

    def values(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.landmarks @ self.weights

    def predict(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = values.argmax(axis=1)
        e = np.exp(STEEP * (values - values.max(axis=1, keepdims=True)))
        return best, 1 / e.sum(axis=1)


def fit(texts: list[str], labels: list[str], n_landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression in the Nystroem space of the first `n_landmarks` texts of each label."""
    languages = tuple(sorted(set(labels)))
    rows = presence(texts)
    seen: dict[str, int] = {}
    chosen = []
    for i, label in enumerate(labels):
        seen[label] = seen.get(label, 0) + 1
        if seen[label] <= n_landmarks:
            chosen.append(i)
    landmarks = rows[chosen].astype(np.float64)
    values, vectors = np.linalg.eigh(landmarks @ landmarks.T)
    keep = values > 1e-6 * max(values.max(initial=0), 1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = rows.astype(np.float64) @ landmarks.T @ root
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # every language weighs the same, however many rows it has
    share = np.sqrt(1.0 / np.array([labels.count(x) for x in labels]))[:, None]
    features, target = features * share, target * share
    solved = np.linalg.solve(features.T @ features + ridge * np.eye(features.shape[1]) / max(len(languages), 1), features.T @ target)
    return Model(languages, np.ascontiguousarray(landmarks.T.astype(np.float32)), (root @ solved).astype(np.float32))


def held_out(id_col: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE) -> pd.DataFrame:
    """At most `per_language` labelled rows of each language, those of the smallest hash among its distinct texts with letters: text, label. Of the rows of a
    language with one text, that of the smallest doc_id stands for all.

    Held-out rows, null labels and null texts take no part. Rows are chosen by ids and 64-bit hashes of the texts; copies meet in partial aggregates first, and a row_number with a
    constant bound keeps so many rows of a partition before the shuffle, so neither many copies nor a frequent language is a large group. The texts of the chosen are read in a second
    pass, which they are broadcast to, and travel only as their sample stretch.
    """
    rows = (docs.select(A.quoted(id_col).cast("long").alias("doc_id"), A.quoted(text_col).cast("string").alias("text"), A.quoted(lang_col).cast("string").alias("label"))
            .filter("label is not null and text is not null and doc_id is not null").filter(~held_out(F.col("doc_id"))).filter(F.col("text").rlike(r"\p{L}")))
    from pyspark.sql import Window
    keyed = rows.withColumn("h", F.xxhash64("text"))
    one = keyed.groupBy("label", "h").agg(F.min("doc_id").alias("doc_id"))
    order = F.xxhash64("doc_id")
    top = one.withColumn("k", F.row_number().over(Window.partitionBy("label").orderBy(order, "doc_id", "h"))).filter(F.col("k") <= per_language)
    start = (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1).cast("int")
    # rows that are repeated whole, id and all, are one
    short = (keyed.join(F.broadcast(top), ["label", "h", "doc_id"]).select("label", "k", F.substr("text", start, F.lit(SAMPLE_CHARS)).alias("text"))
             .groupBy("label", "k").agg(F.min("text").alias("text")))
    return short.select("label", "k", "text").toPandas().sort_values(["label", "k"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE) -> Model:
    """The model of a table's labelled rows. Without any it has no language and predicts `und`."""
    sample = training_sample(docs, id_col, text_col, lang_col, per_language)
    if sample.empty:
        return Model((), np.zeros((FEATURES, 0), np.float32), np.zeros((0, 0), np.float32))
    return fit(sample["text"].tolist(), sample["label"].tolist())


def stretches(text: str) -> Iterator[tuple[str, int]]:
    """The whole text in stretches of about equal length, none longer than SAMPLE_CHARS but for the characters that n-grams over its end need, and the letters
    of each: tables and ids between the prose of a long text have no say. A single stretch counts as it is."""
    n = max(1, -(-len(text) // SAMPLE_CHARS))
    for k in range(n):
        part = text[len(text) * k // n:len(text) * (k + 1) // n + (GRAMS - 1 if n > 1 else 0)]
        if weight := sum(map(str.isalpha, part)) if n > 1 else 1:
            yield part, weight


def classify_texts(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Label and score of whole texts by what the model gives their stretches, a mean by letters; some stretches at a time in one matrix product."""
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model.languages else []
    if known:
        values, weights = np.zeros((len(known), len(model.languages))), np.zeros(len(known))
        parts = ((k, *x) for k, i in enumerate(known) for x in stretches(texts[i]))
        while some := list(itertools.islice(parts, ROWS)):
            of, part, weight = zip(*some, strict=True)
            np.add.at(values, np.array(of), model.values(presence(list(part))) * np.array(weight)[:, None])
            np.add.at(weights, np.array(of), weight)
        for i, b, s in zip(known, *model.predict(values / weights[:, None]), strict=True):
            labels[i], scores[i] = model.languages[b], float(min(max(s, 0.0), 1.0))
    return labels, scores


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1). Only the text is read: the whole of it.

    Null, empty and letterless texts are `und` with score 0; repeated rows give repeated rows. One pass without a shuffle; the model is of fixed size.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = classify_texts(batch.column(1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])
    return A.texts_only(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_languages(docs: DataFrame, model: Model, text_col: str = "text", languages: tuple[str, ...] | None = None, least_score: float = 0.0) -> DataFrame:
    """The rows, with all their columns, whose text is in one of the languages (all that the model knows by default) with that score at least."""
    at, wanted = docs.columns.index(text_col), set(model.languages if languages is None else languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = classify_texts(batch.column(at).to_pylist(), model)
            yield batch.filter(pa.array([x in wanted and s >= least_score for x, s in zip(labels, scores, strict=True)], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query."""
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
