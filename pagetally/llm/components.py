"""Connected components of a link table, in Spark joins throughout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetally.llm.common import only_last, stored
from pagetally.session import delete


def _roots(pairs: DataFrame) -> DataFrame:
    """`id` and `to` of every id in the pairs: the end of the way from an id to its smallest
    neighbour, from there to that one's, and so on while they get smaller. Following doubles the
    step each time."""
    back = pairs.select(F.col("b").alias("id"), F.col("a").alias("other"))
    ends = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(back)
    first = ends.groupBy("id").agg(F.min("other").alias("low"))
    trail: list[str] = []
    to = stored(first.select("id", F.least("id", "low").alias("to")), "roots", trail)
    while True:
        ahead = to.select(F.col("id").alias("to"), F.col("to").alias("next"))
        rows = stored(to.join(ahead, "to").select("id", "to", "next"), "roots", trail)
        only_last(pairs.sparkSession, trail)
        to = rows.select("id", F.col("next").alias("to"))
        if rows.where("to <> next").isEmpty():
            return to


def components(links: DataFrame) -> DataFrame:
    """`id` and `component`, the smallest id reachable, of every id in the links (a, b).

    Each round brings every id to the root of its way to smaller neighbours and keeps only the
    links between different roots; after the first one dense groups have none left. All tables
    are in the shared folder. Minima combine before the shuffle, so an id with very many links is
    no hot group there. In the join that follows the ways, all ids of a large component have one
    `to`: that key is met by a single row, and is split by Spark's handling of skewed joins. Links of an id with itself, repeated ones and none at all are fine.
    """
    spark, trail, named = links.sparkSession, [], []
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    own = links.where("a = b").select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    pairs = stored(ordered.where("a <> b").distinct(), "links", trail)
    found = None
    while True:
        to = _roots(pairs)
        if found is None:
            found = to.withColumnRenamed("to", "component")
        else:
            further = to.select(F.col("id").alias("component"), "to")
            joined = found.join(further, "component", "left")
            found = joined.select("id", F.coalesce("to", "component").alias("component"))
        found = stored(found, "components", named)
        only_last(spark, named)
        roots = [to.select(F.col("id").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab"]
        moved = pairs.join(roots[0], "a").join(roots[1], "b").where("to_a <> to_b")
        least, greatest = F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")
        pairs = stored(moved.select(least, greatest).distinct(), "links", trail)
        only_last(spark, trail)
        if pairs.isEmpty():
            delete(spark, trail[0])
            alone = own.join(found, "id", "left_anti")
            return found.unionByName(alone)


#: Links that one task takes at most (16 bytes each).
SMALL = 1 << 17


def _joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of links, and the smallest id that each can reach."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    low = np.arange(len(ids))
    while True:
        least = np.minimum(low[x], low[y])
        after = low.copy()
        np.minimum.at(after, low[x], least)
        np.minimum.at(after, low[y], least)
        after = after[after]
        if (after == low).all():
            return ids, ids[low]
        low = after


def small_components(links: DataFrame) -> DataFrame:
    """The same as components. Links that are stored and few are joined by one task in one job."""
    if links.count() > SMALL:
        return components(links)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([c.to_numpy() for c in b.columns]) for b in batches]
        a, b = np.concatenate([*held, np.zeros((2, 0), np.int64)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _joined(a, b)], ["id", "component"])

    return links.select("a", "b").repartition(1).mapInArrow(run, "id long, component long")
