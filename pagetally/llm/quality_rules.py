"""Quality rules whose thresholds follow the data.

Every text is measured once. The measures of each language and source go into mergeable quantile
sketches: counts per bucket of a log-linear scale (values below 128 exactly, above that seven
leading bits, so a quantile is off by less than 1/64 of its value). Sketches add up, so those of
a language or of all rows are sums of the others', and neither order nor retries change them.
A threshold is a fence beyond an outer quantile of the row's own group, by several times the
distance of that quantile from the opposite one; groups of few rows take the sketch of their
language, or of all rows. The thresholds are joined to the rows as a filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetally.llm.common import BLANKS, slices, stored, whole_texts, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SCALE = 10_000


@dataclass(frozen=True)
class Rule:
    """A measure `part` / `of`, in units of 1 / SCALE. Its fence lies above the quantile `outer` (per
    cent) by `spreads` times what that is above the quantile 100 - `outer`, and a `low` one below
    the latter likewise. `least` stands for a smaller distance: where a group has one value
    throughout, a few in a hundred words or lines still pass."""

    name: str
    part: str
    of: str
    outer: int
    spreads: int
    least: int
    low: bool = False


#: Junk may be a tenth of a group, so what marks it is judged by quartiles. Repeats are rare: most
#: texts have none, and their fence follows the last hundredth.
RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", 75, 6, 100),
    Rule("word_length", "word_chars", "n_words", 75, 12, 500, low=True),
    Rule("dup_lines", "n_dup_lines", "n_lines", 99, 2, 1000),
    Rule("repeat_words", "n_repeat_words", "n_words", 99, 2, 250),
)
QUANTILES = sorted({q for r in RULES for q in (r.outer, 100 - r.outer)})


@dataclass(frozen=True)
class Limits:
    """Groups of fewer rows than `least_rows` take the thresholds of a larger one."""

    least_rows: int = 500
    min_words: int = 10
    max_repeat_percent: int = 20


def repeated(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that are found twice or more in the text, the first included."""
    n = len(tokens) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(t, len(number)) for t in tokens], np.int64)
    # Number the windows by their words, one word at a time, exactly.
    keys, size = ids[:n], len(number)
    for k in range(1, window):
        top = int(keys.max()) + 1
        if top * size >= 1 << 62:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * size + ids[k : n + k]
    _, keys, counts = np.unique(keys, return_inverse=True, return_counts=True)
    covered = np.zeros(len(tokens) + 1, np.int64)
    twice = np.flatnonzero(counts[keys] > 1)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; a null text is empty."""
    text = text or ""
    tokens = words(text)
    chars = len(text) - sum(map(text.count, BLANKS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    symbols = sum(map(text.count, SYMBOLS))
    return len(tokens), chars, symbols, len(lines), len(lines) - len(set(lines)), repeated(tokens)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures of every row."""
    kept = ("doc_id", "lang", "source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [measure(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            both = [batch.column(c) for c in kept] + columns
            yield pa.RecordBatch.from_arrays(both, [*kept, *MEASURES])

    rows = whole_texts(docs).select(
        F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("lang", "source", "text")]
    )
    longs = ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInArrow(run, f"doc_id long, lang string, source string, {longs}")


def scaled(rule: Rule) -> Column:
    """The measure as an integer; 0 where there is nothing to divide by."""
    value = F.expr(f"{rule.part} * {SCALE} div {rule.of}")
    return F.when(F.col(rule.of) > 0, value).otherwise(F.lit(0).cast("long"))


def sketches(rows: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Counts per group, rule and bucket of rows with a column for each rule."""
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("value")) for r in RULES]
    long = rows.select(*groups, F.explode(F.array(*pairs)).alias("m")).select(*groups, "m.*")
    shift = "greatest(length(bin(value)) - 7, 0)"
    bucket = F.expr(f"shiftleft(shiftright(value, {shift}), {shift})")
    return long.groupBy(*groups, "rule", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """The sum of sketches over the groups that are left."""
    return sketch.groupBy(*groups, "rule", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """rows and the QUANTILES of each group and rule, as q75 and so on. A group has few buckets,
    however many rows."""
    key = [*groups, "rule"]
    below = Window.partitionBy(*key).orderBy("bucket")
    placed = sketch.select(
        *key,
        "bucket",
        F.sum("n").over(below).alias("upto"),
        F.sum("n").over(Window.partitionBy(*key)).alias("rows"),
    )
    at = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("rows"), F.col("bucket")))
    found = [at(q).alias(f"q{q}") for q in QUANTILES]
    return placed.groupBy(*key).agg(F.max("rows").alias("rows"), *found)


def thresholds(rows: DataFrame, limits: Limits) -> DataFrame:
    """lang, source and for every rule <rule>_low and <rule>_high."""
    own = stored(sketches(rows, ("lang", "source")), "sketches")
    levels = [
        quantiles(own, ("lang", "source")),
        quantiles(merged(own, ("lang",)), ("lang",)),
        quantiles(merged(own, ()), ()),
    ]
    found = levels[0].where(F.col("rows") >= limits.least_rows)
    lang = levels[1].where(F.col("rows") >= limits.least_rows)
    groups = own.select("lang", "source", "rule").distinct().alias("g")
    same = lambda a, b, *on: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in on]
    joined = (
        groups.join(found.alias("f"), same("g", "f", "lang", "source", "rule"), "left")
        .join(lang.alias("l"), same("g", "l", "lang", "rule"), "left")
        .join(levels[2].alias("a"), same("g", "a", "rule"), "left")
    )
    q = lambda c: F.coalesce(*[F.col(f"{x}.{c}") for x in "fla"])
    chosen = joined.select("g.lang", "g.source", "g.rule", *[q(f"q{n}").alias(f"q{n}") for n in QUANTILES])
    fences = []
    for r in RULES:
        one, upper, lower = F.col("rule") == r.name, F.col(f"q{r.outer}"), F.col(f"q{100 - r.outer}")
        beyond = r.spreads * F.greatest(upper - lower, F.lit(r.least))
        high, low = upper + beyond, lower - beyond
        fences.append(F.max(F.when(one, high)).alias(f"{r.name}_high"))
        fences.append(F.max(F.when(one, low if r.low else F.lit(None))).cast("long").alias(f"{r.name}_low"))
    return chosen.groupBy("lang", "source").agg(*fences)


def apply_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of docs: doc_id, the measures, base_failed, kept, failed_rules.

    Texts of fewer words than `min_words`, or with more than `max_repeat_percent` of their words
    in repeated windows, fail the base rules and do not count in the sketches; null and empty
    texts are among them. A null language or source is a group like any other. Repeated rows
    count as often as they occur. Other columns are not read; an empty table stays empty.
    """
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )
    rows = stored(measured(docs).withColumn("base_failed", failed), "measures")
    rows = rows.withColumns({r.name: scaled(r) for r in RULES})
    fences = stored(thresholds(rows.where("not base_failed"), limits), "thresholds")
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("lang", "source")]
    joined = rows.alias("d").join(fences.alias("t"), on, "left")
    outside = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.col(r.name) > F.col(f"{r.name}_high"))
                    | F.coalesce(F.col(r.name) < F.col(f"{r.name}_low"), F.lit(False)),
                    F.lit(r.name),
                )
                for r in RULES
            ]
        )
    )
    kept = ~F.col("base_failed") & (F.size("failed_rules") == 0)
    return joined.withColumn("failed_rules", outside).select(
        "d.doc_id", *MEASURES, "base_failed", kept.alias("kept"), "failed_rules"
    )
