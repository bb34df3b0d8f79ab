"""Toxicity categories by a chain of linear classifiers.

The categories have an order. Each has a logistic regression over hashed features of the text
and over the probabilities of the categories before it. What a later model learns from are
out-of-fold probabilities: those of models that have not seen the row, as will be the case when
it is applied. Words and word beginnings are presence features, so one abusive word in a very
long text weighs as much as in a short one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetally.llm.common import Shared, slices, whole_texts, with_fields
from pagetally.llm.labelled import Rows, sample

BITS = 18
PREFIX = 4
STRIP = ".,;:!?\"'()[]{}*#$%&|<>"


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the labelled rows to learn from, `features` the columns of a model."""

    sample: int = 6_000
    folds: int = 5
    features: int = 600
    least_rows: int = 4
    ridge: float = 1e-4
    steps: int = 300
    precision: float = 0.995


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed columns of a text, each once, with value 1: words, their beginnings, and steps of the
    shares of symbols, capitals and repeated words."""
    found = text.split()
    distinct = {w.strip(STRIP) for w in set(text.lower().split())}
    names = [b"w" + w.encode() for w in distinct]
    names += {b"p" + w[:PREFIX].encode() for w in distinct if len(w) >= PREFIX}
    n = max(len(found), 1)
    shares = {
        "symbols": sum(map(text.count, "#*$%&|<>")) / n,
        "capitals": sum(w.isupper() for w in found) / n,
        "repeats": 1 - len(set(found)) / n,
    }
    names += [f"s{name}{step}".encode() for name, x in shares.items() for step in range(int(x * 5) + 1)]
    columns = np.fromiter((crc32(x) & ((1 << BITS) - 1) for x in names), np.int64, len(names))
    columns = np.unique(columns)
    return columns, np.ones(len(columns))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    """Log-odds in tens, about -1 to 1."""
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 10


@dataclass
class Linear:
    """Weights of hashed columns, of the logits of earlier categories, and a constant."""

    weights: np.ndarray
    earlier: np.ndarray
    constant: float

    def predict(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        return _sigmoid(rows.dot(self.weights) + _logit(earlier) @ self.earlier + self.constant)


def _select(rows: Rows, y: np.ndarray, settings: Settings) -> np.ndarray:
    """Columns whose presence tells most about y, by the chi-square statistic."""
    size = 1 << BITS
    n, positive = len(y), y.sum()
    present = np.bincount(rows.index, minlength=size)
    hits = np.bincount(rows.index, y[rows.row], minlength=size)
    expected = present * (positive / max(n, 1))
    spread = expected * (1 - present / max(n, 1)) * (1 - positive / max(n, 1))
    usable = (present >= settings.least_rows) & (spread > 0)
    score = np.zeros(size)
    score[usable] = (hits[usable] - expected[usable]) ** 2 / spread[usable]
    best = np.argsort(-score, kind="stable")[: settings.features]
    return np.sort(best[score[best] > 0])


def fit_linear(rows: Rows, y: np.ndarray, earlier: np.ndarray, settings: Settings) -> Linear:
    """Ridge logistic regression by accelerated gradient steps over the selected columns."""
    weights = np.zeros(1 << BITS)
    constant = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    if not len(y) or y.min() == y.max():
        return Linear(weights, np.zeros(earlier.shape[1]), constant)
    chosen = _select(rows, y, settings)
    x, dense = rows.columns(chosen), _logit(earlier)
    of, n, k = x.row, len(y), len(chosen)
    # A bound of the curvature for each column by itself, so that rare ones move fast as well.
    length = np.bincount(of, np.abs(x.value), n) + np.abs(dense).sum(1) + 1
    bound = [np.bincount(x.index, np.abs(x.value) * length[of], k), length @ np.abs(dense), [length.sum()]]
    step = 1 / (np.concatenate(bound) / (4 * n) + settings.ridge)
    theta = np.concatenate((np.zeros(k + dense.shape[1]), [constant]))
    ahead, momentum = theta.copy(), 1.0
    for _ in range(settings.steps):
        z = x.dot(ahead[:k]) + dense @ ahead[k:-1] + ahead[-1]
        error = _sigmoid(z) - y
        slope = np.concatenate(
            (np.bincount(x.index, x.value * error[of], k), error @ dense, [error.sum()])
        ) / n
        slope[:-1] += settings.ridge * ahead[:-1]
        after = ahead - step * slope
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = after + (momentum - 1) / faster * (after - theta)
        theta, momentum = after, faster
    weights[chosen] = theta[:k]
    return Linear(weights, theta[k:-1], float(theta[-1]))


@dataclass
class Chain:
    """Models in the order of their categories, and the probability from which each one holds."""

    categories: list[str]
    models: list[Linear] = field(default_factory=list)
    limits: list[float] = field(default_factory=list)

    def predict(self, rows: Rows) -> np.ndarray:
        """A probability for every row and category, each fed to the later ones."""
        p = np.zeros((len(rows), 0))
        for model in self.models:
            p = np.column_stack((p, model.predict(rows, p)))
        return p


def limit(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The smallest probability of a positive row, at least twice the share of positive rows, from
    which on so great a share of the rows may be positive: not more of them are negative than two
    standard deviations above what such a share lets one expect, or than one at least, so that a
    few wrong labels among few positive ones do not decide. If there is none, the probability of
    the best F score that weighs precision twice. Without positive rows: never."""
    if not len(y) or not y.any():
        return 2.0
    order = np.argsort(-p, kind="stable")
    rank, hits = np.arange(1, len(p) + 1), np.cumsum(y[order])
    wrong = rank * (1 - precision)
    good = np.flatnonzero((rank - hits <= wrong + 2 * np.sqrt(wrong) + 1) & (p[order] >= 2 * y.mean()) & (y[order] > 0))
    best = good[-1] if good.size else np.argmax(1.25 * hits / (0.25 * y.sum() + rank))
    return float(p[order][best])


def fit(rows: Rows, labels: np.ndarray, categories: list[str], settings: Settings = Settings()) -> Chain:
    """A chain for the columns of labels. Folds go by the order of the rows."""
    chain = Chain(categories)
    fold = np.arange(len(rows)) % settings.folds
    held = np.zeros((len(rows), 0))  # out-of-fold probabilities of the categories so far
    for k in range(len(categories)):
        y, out = labels[:, k].astype(float), np.zeros(len(rows))
        for f in range(settings.folds):
            seen, unseen = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            model = fit_linear(rows.take(seen), y[seen], held[seen], settings)
            out[unseen] = model.predict(rows.take(unseen), held[unseen])
        chain.models.append(fit_linear(rows, y, held, settings))
        chain.limits.append(limit(out, y, settings.precision))
        held = np.column_stack((held, out))
    return chain


#: The order of the chain: formatting abuse, abusive language, and both at once.
CATEGORIES = ["junk", "toxic", "toxic_junk"]


def fit_labels(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Chain:
    """The chain learnt from labels (doc_id, quality, toxic): junk is quality 0. Without usable
    labels nothing is ever rejected."""
    marked = labels.select(
        "doc_id",
        (1 - F.col("quality")).alias("junk"),
        F.col("toxic").alias("toxic"),
        ((1 - F.col("quality")) * F.col("toxic")).alias("toxic_junk"),
    )
    rows, y = sample(docs, marked, CATEGORIES, features, settings.sample)
    return fit(rows, y, CATEGORIES, settings)


def score(docs: DataFrame, chain: Chain, category: str = "toxic") -> DataFrame:
    """The rows of docs with p_<category> for all categories and `rejected`, which follows the
    named category. A null text is empty. Columns of docs stay, but those named like a new one
    are replaced; rows are independent, so repeated rows and null ids are no matter."""
    made = [f"p_{c}" for c in chain.categories] + ["rejected"]
    columns = [c for c in docs.columns if c.lower() not in made]
    which = chain.categories.index(category)
    shared = Shared(docs.sparkSession, chain)  # a few MB by BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            p = chain.predict(Rows.of([features(t or "") for t in texts]))
            new = [pa.array(c) for c in p.T] + [pa.array(p[:, which] >= chain.limits[which])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *new], [*columns, *made])

    rows = whole_texts(docs).select(*columns)
    doubles = "".join(f"`{m}` double, " for m in made[:-1])
    return rows.mapInArrow(run, with_fields(rows, f"{doubles} rejected boolean"))


def accepted(docs: DataFrame, chain: Chain, category: str = "toxic") -> DataFrame:
    """The rows of docs that are not rejected, with exactly the columns they have."""
    which = chain.categories.index(category)
    shared = Shared(docs.sparkSession, chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            p = chain.predict(Rows.of([features(t or "") for t in texts]))
            yield batch.filter(pa.array(p[:, which] < chain.limits[which]))

    return whole_texts(docs).mapInArrow(run, docs.schema)
