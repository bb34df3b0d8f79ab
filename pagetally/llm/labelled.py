"""A bounded sample of labelled documents for the classifiers, and sparse rows in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetally.llm.common import slices, whole_texts


@dataclass
class Rows:
    """Sparse rows: row i has columns index[start[i]:start[i + 1]] with the values there."""

    start: np.ndarray
    index: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, lists: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        sizes = [len(i) for i, _ in lists]
        joined = [np.concatenate(c) if lists else np.zeros(0) for c in zip(*lists, strict=True)] or [[], []]
        start = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        return cls(start, np.asarray(joined[0], np.int32), np.asarray(joined[1]))

    def __len__(self) -> int:
        return len(self.start) - 1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.start))

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.start[rows + 1] - self.start[rows]
        start = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.start[rows] - start[:-1], sizes) + np.arange(start[-1])
        return Rows(start, self.index[at], self.value[at])

    def columns(self, chosen: np.ndarray) -> Rows:
        """Only the chosen columns, which are sorted, numbered anew."""
        if not len(chosen):
            return Rows(np.zeros(len(self) + 1, np.int64), np.zeros(0, np.int32), np.zeros(0))
        place = np.minimum(np.searchsorted(chosen, self.index), len(chosen) - 1)
        kept = chosen[place] == self.index
        counts = np.bincount(self.row[kept], minlength=len(self))
        return Rows(np.concatenate(([0], np.cumsum(counts))), place[kept], self.value[kept])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.index], len(self))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    names: list[str],
    features: Callable[[str], tuple[np.ndarray, np.ndarray]],
    bound: int,
) -> tuple[Rows, np.ndarray]:
    """Sparse features and labels (a column per name) of `bound` labelled documents at most.

    Those of the smallest hashes of their ids are taken, so the choice is the same at every run.
    Labels that are null, or of documents that are not there, are left out; of several labels of a
    document the largest counts, and of several rows of a document one. The features are made in
    tasks; the driver gets the bounded sample only, in the order of the hashes.
    """
    rank = F.xxhash64("doc_id")
    known = labels.select(F.col("doc_id").cast("long"), *[F.col(n).cast("int") for n in names])
    known = known.dropna().groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names])
    chosen = known.orderBy(rank, "doc_id").limit(bound)
    rows = whole_texts(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.join(F.broadcast(chosen), "doc_id")  # `bound` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [features(t or "") for t in batch.column("text").to_pylist()]
            blobs = [
                pa.array([np.asarray(part, kind).tobytes() for part in parts], pa.binary())
                for parts, kind in zip(zip(*found, strict=True), ("<u4", "<f4"), strict=True)
            ]
            own = [batch.column(c) for c in ("doc_id", *names)]
            yield pa.RecordBatch.from_arrays([*own, *blobs], ["doc_id", *names, "index", "value"])

    ints = ", ".join(f"`{n}` int" for n in names)
    made = rows.mapInArrow(run, f"doc_id long, {ints}, index binary, value binary")
    got = made.dropDuplicates(["doc_id"]).orderBy(rank, "doc_id").collect()
    lists = [(np.frombuffer(r["index"], "<u4"), np.frombuffer(r["value"], "<f4")) for r in got]
    return Rows.of(lists), np.array([[r[n] for n in names] for r in got]).reshape(-1, len(names))
