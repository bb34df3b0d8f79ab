"""Mixing of sources to target weights by temperature.

The share p of each source's tokens becomes p^a, normalised. The exponent a is bisected on a
fixed grid: for a target entropy, the largest exponent that reaches it (the mixture closest to
the corpus); for a limit of repetition, the smallest within it (the flattest mixture allowed).
Each source then has a budget of tokens. It is filled with whole block permutations, each block
being all documents of the source in an order of its own, and with the head of one more block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetally.llm.common import stored

#: Exponents are multiples of 1 / GRID between 0 and 1.
GRID = 1024
#: Bits of a document's place in a block; the head of a block is found LEVEL bits at a time.
PLACE_BITS, LEVEL = 30, 10


@dataclass(frozen=True)
class Target:
    """Either an entropy in bits that the mixture has at least, or a limit to how often any
    source may come. The budget is a number of tokens, or None: as many as it takes for every
    source to come once in full."""

    entropy: float | None = None
    max_repeats: float | None = None
    budget: int | None = None

    def __post_init__(self):
        if (self.entropy is None) == (self.max_repeats is None):
            raise ValueError("give an entropy or a limit of repetition, and not both")


def n_tokens(text: str = "text") -> Column:
    """Number of words of a text; none in a null one."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.regexp_count(whole, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def totals(sized: DataFrame) -> DataFrame:
    """Tokens of each source that has any."""
    sums = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    return sums.where("tokens > 0")


def _mass(exponent: float, most: int) -> Column:
    """The power of a share, relative to the largest source: nothing runs over or to zero."""
    return F.pow(F.col("tokens") / F.lit(float(most)), F.lit(exponent))


def _repeats(exponent: float, most: int) -> Column:
    """How often a source comes, up to a factor that is the same for all."""
    return _mass(exponent, most) / F.col("tokens") * F.lit(float(most))


def _entropy(sources: DataFrame, exponent: float, most: int) -> float:
    mass = _mass(exponent, most)
    row = sources.agg(F.sum(mass).alias("z"), F.sum(mass * F.log2(mass)).alias("m")).first()
    return math.log2(row.z) - row.m / row.z


def _factor(sources: DataFrame, target: Target, exponent: float, most: int):
    """What _repeats() is multiplied with, and the most that any source then comes. The answer is
    one row, however many sources there are."""
    mass, repeats = _mass(exponent, most), _repeats(exponent, most)
    row = sources.agg(
        F.sum(mass).alias("z"), F.min(repeats).alias("least"), F.max(repeats).alias("greatest")
    ).first()
    factor = 1 / row.least if target.budget is None else target.budget / row.z / most
    return factor, row.greatest * factor


def exponent(sources: DataFrame, target: Target, most: int) -> float:
    """The exponent on the grid that meets the target: 1 is the corpus, 0 equal weights. Where
    none meets it, 0 for an entropy and 1 for a limit, the closest there is."""
    if target.entropy is not None:

        def flat_enough(k: int) -> bool:
            return _entropy(sources, k / GRID, most) >= target.entropy

        low, high = 0, GRID + 1  # flat enough at `low`, or nowhere; not at `high`
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if flat_enough(middle) else (low, middle)
        return low / GRID

    def within(k: int) -> bool:
        return _factor(sources, target, k / GRID, most)[1] <= target.max_repeats

    low, high = -1, GRID  # within at `high`, or nowhere; not at `low`
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if within(middle) else (middle, high)
    return high / GRID


def weights(sources: DataFrame, target: Target) -> DataFrame:
    """source, tokens, weight, budget (tokens), blocks (whole ones), rest (tokens)."""
    most = sources.agg(F.max("tokens")).first()[0] or 1
    a = exponent(sources, target, most) if most > 1 else 1.0
    z = sources.agg(F.sum(_mass(a, most))).first()[0] or 1.0
    factor = _factor(sources, target, a, most)[0] if not sources.isEmpty() else 1.0
    # Rounded to whole tokens, so that no whole block is missed by a hair.
    budget = F.round(F.col("tokens") * (_repeats(a, most) * F.lit(factor))).cast("long")
    weighed = sources.withColumns({"weight": _mass(a, most) / F.lit(z), "budget": budget})
    return weighed.withColumns(
        {"blocks": F.expr("budget div tokens"), "rest": F.col("budget") % F.col("tokens")}
    )


def place(seed: int, block: Column) -> Column:
    """Where a document stands in a block: a number of PLACE_BITS bits, drawn from its id."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"), doc))
    number = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("long")
    return F.shiftright(number, 32 - PLACE_BITS)


def _cuts(rows: DataFrame) -> DataFrame:
    """Source (at) and cut: the documents of (source, rest, place, n_tokens) below that place are the
    most that the rest can hold.

    Sums over the leading bits of the place find where the rest ends, then those over the next
    bits within; no task has to order the documents of a whole source.
    """
    for shift in range(PLACE_BITS - LEVEL, -1, -LEVEL):
        digit = F.shiftright("place", shift)
        sums = rows.groupBy("source", digit.alias("digit")).agg(
            F.sum("n_tokens").alias("sum"), F.max("rest").alias("rest")
        )
        upto = F.sum("sum").over(Window.partitionBy("source").orderBy("digit"))
        over = sums.withColumn("upto", upto).where("upto > rest and upto - sum <= rest")
        left = F.col("rest") - F.col("upto") + F.col("sum")
        cut = over.select(F.col("source").alias("at"), F.col("digit").alias("cut"), left.alias("left"))
        if shift:
            on = F.col("source").eqNullSafe(F.col("at")) & (F.shiftright("place", shift) == F.col("cut"))
            rows = rows.join(cut, on).select("source", "n_tokens", "place", F.col("left").alias("rest"))
    return cut.select("at", "cut")


def plan(docs: DataFrame, target: Target, seed: int = 0) -> DataFrame:
    """The weights of every source, with the cut of its last block (0 where there is none)."""
    sized = docs.select("doc_id", F.col("source").cast("string"), n_tokens().alias("n_tokens"))
    sized = stored(sized, "sized")
    every = stored(weights(stored(totals(sized), "sources"), target), "weights")
    parts = every.where("rest > 0")
    parts = parts.select(F.col("source").alias("of"), "rest", "blocks")
    rows = sized.join(parts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    cuts = _cuts(rows.withColumn("place", place(seed, F.col("blocks"))).drop("doc_id", "blocks"))
    cuts = stored(cuts, "cuts")
    with_cut = every.join(cuts, F.col("source").eqNullSafe(F.col("at")), "left").drop("at")
    return stored(with_cut.withColumn("cut", F.coalesce("cut", F.lit(0).cast("long"))), "plan")


def mixture(docs: DataFrame, target: Target, seed: int = 0) -> DataFrame:
    """The rows of docs as often as the mixture takes them, with n_tokens, block, place and at.

    A row comes in block 0, 1, ... of its source, at `place` there; `at` runs from 0 to 1 over
    the budget of the source, so that rows ordered by it keep the weights all along. Whole blocks
    hold every row of the source: repeated rows, null ids and texts that are null or empty too.
    The last block ends before the place where the budget would be exceeded. A null source is a
    source like any other; one without any token is taken once. An empty table stays empty.
    Columns of docs stay, but those named like a new one are replaced. Only sums per source and
    the small plan are shuffled; the rows themselves stay where they are.
    """
    mine = ("n_tokens", "block", "place", "at")
    columns = [c for c in docs.columns if c.lower() not in mine]
    chosen = plan(docs, target, seed).withColumnRenamed("source", "#source")
    names = {c: f"#{c}" for c in ("tokens", "weight", "budget", "blocks", "rest", "cut")}
    chosen = chosen.withColumnsRenamed(names)
    rows = docs.select(*columns, n_tokens().alias("n_tokens"))
    joined = rows.join(chosen, rows["source"].cast("string").eqNullSafe(chosen["#source"]), "left")
    more = F.when(place(seed, F.col("#blocks")) < F.col("#cut"), 1).otherwise(0)
    copies = F.coalesce(F.col("#blocks") + more, F.lit(1).cast("long"))
    taken = joined.withColumn("#copies", copies).where("`#copies` > 0")
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("#copies") - 1))
    placed = taken.withColumn("block", block).withColumn("place", place(seed, F.col("block")))
    share = (F.col("block") + F.col("place") / (1 << PLACE_BITS)) * F.col("#tokens") / F.col("#budget")
    at = F.least(F.coalesce(share, F.lit(0.0)), F.lit(1.0))
    return placed.select(*columns, "n_tokens", "block", "place", at.alias("at"))
