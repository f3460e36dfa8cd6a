"""Matrices of sums that tasks send a row at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each place over all tasks: in the order of the tasks, so that reruns agree."""
    parts: dict[int, list] = {}
    for batch in batches:
        for place, task, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            parts.setdefault(place, []).append((task, sums))
    for place, rows in parts.items():
        total = np.sum([np.frombuffer(s) for _, s in sorted(rows)], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["place", "sums"])


def summed_parts(rows: DataFrame) -> dict[int, np.ndarray]:
    """rows: place int, task int, sums binary (doubles). The sums of each place; a place's parts, one for each task, meet in one task. Their size is that of a model, not of the data."""
    sums = rows.repartition("place").mapInArrow(_added, "place int, sums binary").toPandas()
    return {int(p): np.frombuffer(s) for p, s in zip(sums["place"], sums["sums"], strict=True)}


def summed(rows: DataFrame) -> np.ndarray:
    """The matrix whose rows are the sums of the places, in order."""
    parts = summed_parts(rows)
    return np.array([parts[p] for p in sorted(parts)])
