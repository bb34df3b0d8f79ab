"""A quality classifier: a factorisation machine over hashed words and the structure of a text.

Besides a weight, every column has a short vector; the product of two vectors is the weight of
the two columns occurring together. The sum over all pairs needs no loop over pairs: it is half
of the squared sum of the vectors less the sum of their squares, which is linear in the columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pagetally.llm.common import Shared, slices, whole_texts, with_fields
from pagetally.llm.labelled import Rows, sample

BITS = 16
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the labelled rows to learn from, `rank` is the length of the vectors."""

    sample: int = 6_000
    rank: int = 8
    epochs: int = 8
    batch: int = 64
    rate: float = 0.1
    ridge: float = 1e-4
    seed: int = 7


def structure(text: str, tokens: list[str]) -> dict[str, float]:
    """Statistics of form, each from 0 to about 1, and the size of the text."""
    n, chars = max(len(tokens), 1), max(len(text), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    return {
        "symbols": sum(map(text.count, SYMBOLS)) / n,
        "exclaims": text.count("!") / n,
        "stops": text.count(".") / n,
        "digits": sum(map(text.count, "0123456789")) / chars,
        "capitals": sum(t.isupper() for t in tokens) / n,
        "distinct": len(set(tokens)) / n,
        "stutter": sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / n,
        "word_length": sum(map(len, tokens)) / n / 10,
        "dup_lines": 1 - len(set(lines)) / max(len(lines), 1),
        "size": np.log2(chars + 1) / 20,
        "line_size": np.log2(chars / max(len(lines), 1) + 1) / 20,
    }


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values: each distinct word, together of length 1, and each statistic as the
    step of ten that it falls in (the last one is open)."""
    mask, tokens = (1 << BITS) - 1, text.split()
    distinct = set(text.lower().split())
    hashed = [crc32(w.encode()) & mask for w in distinct]
    steps = [
        crc32(f"#{name}{min(int(x * 10), 10)}".encode()) & mask
        for name, x in structure(text, tokens).items()
    ]
    weight = 1 / np.sqrt(max(len(hashed), 1))
    values = np.concatenate((np.full(len(hashed), weight), np.ones(len(steps))))
    columns, place = np.unique(np.array(hashed + steps, np.int64), return_inverse=True)
    return columns, np.bincount(place, values, len(columns))


@dataclass
class Machine:
    constant: float
    weights: np.ndarray
    vectors: np.ndarray

    def sums(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Per row: what decides (log-odds), and the sums of the vectors."""
        of, n = rows.row, len(rows)
        v = self.vectors[rows.index] * rows.value[:, None]
        by_row = lambda a: np.stack([np.bincount(of, c, n) for c in a.T], axis=1)
        total = by_row(v)
        pairs = 0.5 * (total**2 - by_row(v**2)).sum(1)
        return self.constant + rows.dot(self.weights) + pairs, total

    def predict(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sums(rows)[0], -30, 30)))


def fit(rows: Rows, y: np.ndarray, settings: Settings = Settings()) -> Machine:
    """Adaptive gradient steps over small batches, in an order drawn from the seed. With labels
    of one kind only, or none, every text gets the share of that kind."""
    rng, size = np.random.default_rng(settings.seed), 1 << BITS
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    machine = Machine(prior, np.zeros(size), np.zeros((size, settings.rank)))
    if not len(y) or y.min() == y.max():
        return machine
    machine.vectors = rng.normal(0, 0.01, (size, settings.rank))
    seen_w, seen_v, seen_c = np.full(size, 1e-8), np.full((size, settings.rank), 1e-8), 1e-8
    for _ in range(settings.epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(y), settings.batch):
            batch = order[start : start + settings.batch]
            x = rows.take(batch)
            z, total = machine.sums(x)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
            used, place = np.unique(x.index, return_inverse=True)
            pull = x.value * error[x.row]
            own = machine.vectors[x.index]
            slope = pull[:, None] * (total[x.row] - own * x.value[:, None])
            w = np.bincount(place, pull, len(used)) + settings.ridge * machine.weights[used]
            v = np.stack([np.bincount(place, c, len(used)) for c in slope.T], axis=1)
            v += settings.ridge * machine.vectors[used]
            seen_w[used] += w**2
            seen_v[used] += v**2
            seen_c += error.sum() ** 2
            machine.weights[used] -= settings.rate * w / np.sqrt(seen_w[used])
            machine.vectors[used] -= settings.rate * v / np.sqrt(seen_v[used])
            machine.constant -= settings.rate * error.sum() / np.sqrt(seen_c)
    return machine


def fit_labels(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Machine:
    """The machine learnt from labels (doc_id, quality)."""
    rows, y = sample(docs, labels, ["quality"], features, settings.sample)
    return fit(rows, y[:, 0].astype(float), settings)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of docs with `score`, the probability that the quality is 1, and `predicted`.

    Only the text is looked at; a null one is empty. Columns of docs stay, but those named like a
    new one are replaced; rows are independent.
    """
    columns = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    shared = Shared(docs.sparkSession, machine)  # a few MB by BITS and rank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            p = machine.predict(Rows.of([features(t or "") for t in texts]))
            new = [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            own = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*own, *new], [*columns, "score", "predicted"])

    rows = whole_texts(docs).select(*columns)
    return rows.mapInArrow(run, with_fields(rows, "score double, predicted int"))
