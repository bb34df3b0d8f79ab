"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

Words of the training texts are counted. The most frequent ones are units of their own; all other
words belong to one of some units by the hash of their ending, within which they have their
smoothed relative frequency. The probability of a word given the words before it is

    P(class | one back, two back) * P(unit | class, one back) * P(word | unit)

The first two are softmaxes over few outcomes, with weights for features of the history: the unit
one back (n-gram), the unit two back (skip), both together in hashed buckets, and constants. All
tokens of the training texts are brought down to counts of outcomes per history, which is all
that training needs. Every round computes the expected counts of all histories in tasks; observed
less expected counts are the gradient of the log-likelihood, and the driver adds them up and moves
the bounded table of weights along it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetally.llm.common import Shared, lower_words, slices, stored, whole_texts

#: The end of a text is a token; no word is empty, so it is written as the empty word.
END = b""


@dataclass(frozen=True)
class Shape:
    """Sizes of the model. Units are `words` + `endings` + 1 (what stands before a text), and
    must be the square of `classes`. `known` words at most, of `longest` bytes at most, are sent
    to all tasks with their counts; the counts of all others are joined."""

    words: int = 767
    endings: int = 256
    classes: int = 32
    pairs: int = 16
    known: int = 1 << 17
    longest: int = 64
    rounds: int = 8
    smoothing: float = 2.0

    def __post_init__(self):
        if self.units != self.classes**2:
            raise ValueError("units must be the square of classes")

    @property
    def units(self) -> int:
        return self.words + self.endings + 1

    @property
    def slot_rows(self) -> int:
        """The first row of weights for units within classes."""
        return 1 + 2 * self.units + self.units * self.pairs

    @property
    def rows(self) -> int:
        return self.slot_rows + self.classes + self.units * self.classes

    def ending(self, word: bytes) -> int:
        return self.words + crc32(word[-3:]) % self.endings


class Vocabulary:
    """The known words: index 0 is the end, and the first `words` are units of their own."""

    def __init__(self, shape: Shape, words: list[bytes], counts: np.ndarray):
        self.shape, self.counts = shape, counts
        self.place = {w: i for i, w in enumerate(words)}
        own = min(shape.words, len(words))
        units = [*range(own), *map(shape.ending, words[own:])]
        self.unit = np.array([*units, 0], np.int32)  # the last is for words not known

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index (-1 if not known) and unit of every word, and of the end after them."""
        get = self.place.get
        index = np.array([get(w, -1) for w in words] + [0], np.int64)
        unit = self.unit[index]
        for i in np.flatnonzero(index < 0).tolist():
            unit[i] = self.shape.ending(words[i])
        return index, unit


def histories(shape: Shape, units: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the units of some texts, one after the other: the unit, the one before, the one before
    that. Before a text stands the last unit, which is never predicted."""
    start, found = shape.units - 1, []
    for back in (1, 2):
        ahead = [np.full(back, start, np.int32)] * len(units)
        found.append(
            np.concatenate([np.concatenate((a, u[: len(u) - back]))[: len(u)] for a, u in zip(ahead, units, strict=True)])
        )
    return np.concatenate(units), *found


def pair_row(shape: Shape, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    bucket = (two.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return 1 + 2 * shape.units + one * shape.pairs + bucket.astype(np.int64) % shape.pairs


# --- counts --------------------------------------------------------------------------------


def word_counts(texts: DataFrame, most: int = 400_000) -> DataFrame:
    """word and n over all texts, each ended by END. Tasks add up what they have first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                counts.update(lower_words(text))
                counts[END] += 1
            if len(counts) >= most:
                yield flush()
        yield flush()

    rows = texts.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, shape: Shape) -> Vocabulary:
    """The most frequent words: those from a count on that at most `known` words reach. The
    driver gets the numbers of words per step of the count, and then those words."""
    short = counts.where((F.length("word") <= shape.longest) & (F.col("word") != F.lit(END)))
    shift = "greatest(length(bin(n)) - 7, 0)"
    step = F.expr(f"shiftleft(shiftright(n, {shift}), {shift})").alias("step")
    total, least = 0, None
    for row in sorted(short.groupBy(step).count().collect(), key=lambda r: -r["step"]):
        total += row["count"]
        if total >= shape.known:
            break
        least = row["step"]
    rows = short.where(F.col("n") >= least).collect() if least is not None else []
    rows = sorted(rows, key=lambda r: (-r["n"], r["word"]))
    ends = counts.where(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0
    words = [END, *(bytes(r["word"]) for r in rows)]
    return Vocabulary(shape, words, np.array([ends, *(r["n"] for r in rows)], np.int64))


def unit_mass(counts: DataFrame, known: Vocabulary) -> np.ndarray:
    """For every unit of endings the sum of n + 0.5 over its words, and 0.5 for unknown ones."""
    shape = known.shape
    own = {w for w, i in known.place.items() if i < shape.words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(shape.units)
        for batch in slices(batches, 8192):
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if word not in own:
                    mass[shape.ending(word)] += n + 0.5
        units = pa.array(np.arange(shape.units))
        yield pa.RecordBatch.from_arrays([units, pa.array(mass)], ["unit", "mass"])

    rows = counts.mapInArrow(run, "unit long, mass double").groupBy("unit").agg(F.sum("mass").alias("mass"))
    mass = np.full(shape.units, 0.5)
    for row in rows.collect():
        mass[row["unit"]] += row["mass"]
    return mass


def outcome_counts(texts: DataFrame, known: Vocabulary, hold: int = 1_000_000) -> DataFrame:
    """A row per history, with how often each outcome followed: history, c0, c1, ...

    Histories of the class are one back * units + two back; those of the unit in its class come
    after them: units^2 + one back * classes + class. There is a bounded number of them, however
    large the corpus; those of a previous unit stand in one partition.
    """
    shape = known.shape
    u, c = shape.units, shape.classes
    shared = Shared(texts.sparkSession, known)  # `known` words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = shared.value, [], 0

        def flush() -> pa.RecordBatch:
            unit, one, two = (a.astype(np.int64) for a in histories(shape, held))
            classes = (one * u + two) * c + unit % c
            slots = (u * u + one * c + unit % c) * c + unit // c
            keys, n = np.unique(np.concatenate((classes, slots)), return_counts=True)
            columns = [pa.array(keys // c), pa.array((keys % c).astype(np.int32)), pa.array(n)]
            return pa.RecordBatch.from_arrays(columns, ["history", "outcome", "n"])

        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                held.append(known.encode(lower_words(text))[1])
                size += len(held[-1])
            if size >= hold:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    rows = texts.select(F.col("text").cast("string"))
    rows = rows.mapInArrow(run, "history long, outcome int, n long")
    each = [F.sum(F.when(F.col("outcome") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(c)]
    one_back = F.expr(f"if(history < {u * u}, history div {u}, (history - {u * u}) div {c})")
    return rows.groupBy("history").agg(*each).repartition(16, one_back)


# --- training ------------------------------------------------------------------------------


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _features(shape: Shape, history: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, list]:
    """Which histories are of the class and which of the unit, and the rows of their features."""
    u, c = shape.units, shape.classes
    of_class = history < u * u
    one, two = history[of_class] // u, history[of_class] % u
    slot = history[~of_class] - u * u
    first = [np.zeros_like(one), 1 + one, 1 + u + two, pair_row(shape, one, two)]
    second = [shape.slot_rows + slot % c, shape.slot_rows + c + slot]
    return of_class, ~of_class, first, second


def _add(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """total[rows] += values, with rows that repeat."""
    if len(rows):
        order = np.argsort(rows, kind="stable")
        edges = np.flatnonzero(np.diff(rows[order], prepend=-1))
        total[rows[order][edges]] += np.add.reduceat(values[order], edges, axis=0)


def feature_sums(outcomes: DataFrame, shape: Shape, weights: np.ndarray | None) -> np.ndarray:
    """For every row of weights and outcome the count in all histories that have the feature:
    expected under the weights, or observed without. Tasks send the rows they touch, no more than
    there are weights; a history is in one task, so most rows come once."""
    context = outcomes.sparkSession.sparkContext
    shared = context.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, total = shared.value, np.zeros((shape.rows, shape.classes))
        for batch in slices(batches, 16_384):
            history = batch.column(0).to_numpy()
            counts = np.column_stack([c.to_numpy() for c in batch.columns[1:]]).astype(float)
            for of, rows in zip(*np.split(np.array(_features(shape, history), object), 2), strict=True):
                own = counts[of]
                if weights is not None and len(own):
                    own = own.sum(1, keepdims=True) * _softmax(sum(weights[r] for r in rows))
                for r in rows:
                    _add(total, r, own)
        touched = np.flatnonzero(total.any(axis=1))
        blobs = [touched.astype("<i4").tobytes(), total[touched].astype("<f4").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], ["rows", "sums"])

    total = np.zeros((shape.rows, shape.classes))
    for row in outcomes.mapInArrow(run, "rows binary, sums binary").toLocalIterator():
        sums = np.frombuffer(row["sums"], "<f4").reshape(-1, shape.classes)
        total[np.frombuffer(row["rows"], "<i4")] += sums
    shared.destroy()
    return total


def train(outcomes: DataFrame, shape: Shape) -> np.ndarray:
    """The weights, by gradient steps with a rate for each weight. They start at the smoothed
    distribution after the unit one back. The curvature of the log-likelihood along a weight is
    its expected count at most, times the number of features that a history has; the rate is
    one by that, or by the observed count where it is greater, so no step is longer than one by
    the number of features."""
    observed, k = feature_sums(outcomes, shape, None), shape.smoothing
    u, c, slot = shape.units, shape.classes, shape.slot_rows
    weights = np.zeros((shape.rows, c), np.float32)

    def start(general: np.ndarray, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = (general + k) / (general + k).sum(-1, keepdims=True)
        q = (special + k * c * p) / (special.sum(-1, keepdims=True) + k * c)
        return np.log(p), np.log(q) - np.log(p)

    weights[0], weights[1 : 1 + u] = start(observed[0], observed[1 : 1 + u])
    constants, after = start(observed[slot : slot + c], observed[slot + c :].reshape(u, c, c))
    weights[slot : slot + c], weights[slot + c :] = constants, after.reshape(-1, c)
    features = np.where(np.arange(shape.rows) < slot, 4, 2)[:, None]
    for _ in range(shape.rounds):
        expected = feature_sums(outcomes, shape, weights)
        rate = 1 / (features * (np.maximum(observed, expected) + k))
        weights += (rate * (observed - expected)).astype(np.float32)
    return weights


# --- scoring -------------------------------------------------------------------------------


@dataclass
class Model:
    """All that scoring needs: known words, weights, mass of the units of endings, totals."""

    known: Vocabulary
    weights: np.ndarray
    mass: np.ndarray
    tokens: int
    types: int

    def prepare(self) -> None:
        """Tables by unit: class weights of the unit one back, and log10 of a unit in its class."""
        shape = self.known.shape
        u, c, slot = shape.units, shape.classes, shape.slot_rows
        self.one = self.weights[0] + self.weights[1 : 1 + u]
        z = self.weights[slot : slot + c] + self.weights[slot + c :].reshape(u, c, c)
        z = z - np.log(np.exp(z - z.max(-1, keepdims=True)).sum(-1, keepdims=True)) - z.max(-1, keepdims=True)
        # Of a unit the class is unit % c and the place in it unit // c.
        self.slot = (z.transpose(0, 2, 1).reshape(u, u) / np.log(10)).astype(np.float32)
        self.log_mass = np.where(np.arange(u) < shape.words, 0.0, np.log10(self.mass))
        self.log_count = np.append(np.log10(self.known.counts + 0.5), 0.0)
        self.own_word = np.append(np.arange(len(self.known.counts)) < shape.words, False)

    def units(self, unit: np.ndarray, one: np.ndarray, two: np.ndarray, chunk: int = 1 << 15) -> np.ndarray:
        """log10 of the probability of each unit after its history, and less log10 of its mass."""
        shape, found = self.known.shape, np.empty(len(unit))
        for i in range(0, len(unit), chunk):
            x, a, b = unit[i : i + chunk], one[i : i + chunk], two[i : i + chunk]
            z = self.one[a] + self.weights[1 + shape.units + b]
            z += self.weights[pair_row(shape, a.astype(np.int64), b)]
            z -= z.max(axis=1, keepdims=True)
            chosen = z[np.arange(len(x)), x % shape.classes]
            log_class = (chosen - np.log(np.exp(z).sum(axis=1))) / np.log(10)
            found[i : i + chunk] = log_class + self.slot[a, x] - self.log_mass[x]
        return found


def fit(texts: DataFrame, shape: Shape = Shape()) -> tuple[Model, DataFrame]:
    """The model of all texts, and the table of their word counts."""
    counts = stored(word_counts(texts), "counts")
    totals = counts.agg(F.sum("n"), F.count("*")).first()
    known = vocabulary(counts, shape)
    outcomes = stored(outcome_counts(texts, known), "outcomes")
    weights = train(outcomes, shape)
    return Model(known, weights, unit_mass(counts, known), totals[0] or 0, totals[1]), counts


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """Rows with what tasks can tell alone: n_tokens, n_known, base, score, and `rest`, the words
    whose counts are still missing."""
    shared, kept = Shared(docs.sparkSession, model), docs.drop("text").columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        model.prepare()
        known = model.known
        for batch in slices(batches):
            texts = [lower_words(t) for t in batch.column("text").to_pylist()]
            coded = [known.encode(t) for t in texts]
            rows = np.repeat(np.arange(len(texts)), [len(u) for _, u in coded])
            index = np.concatenate([i for i, _ in coded])
            by_units = model.units(*histories(known.shape, [u for _, u in coded]))
            # Words within units of endings: their own counts, where they are known here.
            within = np.where(model.own_word[index], 0.0, model.log_count[index])
            total = lambda a: pa.array(np.bincount(rows, a, len(texts)))  # noqa: E731,B023
            seen = np.append(known.counts > 0, False)[index]
            rest = [
                [t[k] for k in np.flatnonzero(i < 0).tolist()] for t, (i, _) in zip(texts, coded, strict=True)
            ]
            columns = [
                *(batch.column(c) for c in kept),
                pa.array([len(u) for _, u in coded], pa.int64()),
                pa.array(np.bincount(rows, seen, len(texts)).astype(np.int64)),
                total(model.log_count[index]),
                total(by_units + within),
                pa.array(rest, pa.list_(pa.binary())),
            ]
            names = [*kept, "n_tokens", "n_known", "base", "score", "rest"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.drop("text").schema)
    more = "n_tokens long, n_known long, base double, score double, rest array<binary>"
    return docs.mapInArrow(run, f"{kinds}, {more}")


def score(docs: DataFrame, training: Column, shape: Shape = Shape()) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows for which `training`, an expression over doc_id, is true, all
    of them and whole; every row is scored. base_score is the score by smoothed word frequencies
    alone. A null or empty text is its end, one token. Repeated rows count as often as they occur,
    null ids are rows like others, other columns are not read. Without any training row all words
    are unknown.
    """
    rows = whole_texts(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    model, counts = fit(rows.where(training).select("text"), shape)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    scored = stored(_scored(numbered, model), "scored")
    # Less frequent words: their counts are joined. The number of a row is fixed, as it is stored.
    rest = scored.select("row", F.explode("rest").alias("word")).join(counts, "word", "left")
    n = F.coalesce("n", F.lit(0))
    rest = rest.groupBy("row").agg(
        F.sum(F.log10(n + 0.5)).alias("more"), F.count("n").alias("more_known")
    )
    joined = scored.drop("rest").join(rest, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    log_total = float(np.log10(model.tokens + 0.5 * (model.types + 1)))
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * log_total).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
