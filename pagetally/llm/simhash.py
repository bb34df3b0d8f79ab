"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A table of the covering looks at a fixed half of the fingerprint's bits. The halves are built
from vectors over two elements: bit i has a vector m(i) of radius + 1 elements, and the table of
a non-zero vector v takes the bits whose m(i) has an odd product with v. Any `radius` bits leave
a non-zero v that is orthogonal to all their vectors; in its table two fingerprints that differ
in those bits only are equal. So every pair within the radius meets in some table: nothing is
missed, and pairs are compared exactly where they meet.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetally.llm.common import lower_words, slices, stored, whole_texts
from pagetally.llm.components import components

#: Fingerprints of one bucket that a task compares; larger buckets are split by more tables.
BUCKET = 16_384
#: Tables upon tables: after so many levels a bucket is compared whatever its size. With radius
#: 3, three levels fix 56 of 64 bits, which leaves 256 fingerprints at most.
LEVELS = 3


def fingerprint(text: str | None, shingle: int = 3, chunk: int = 1 << 16) -> int:
    """64 bits; each is the majority, over all shingles, of that bit of the shingle's XXH64."""
    from xxhash import xxh64_intdigest

    tokens = lower_words(text)
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(tokens)) - 1 :].tolist(), strict=True)
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, n, chunk):
        octets = hashes[i : i + chunk].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fingerprint (its bits as a signed long) of every row; a text that is null or
    without words has zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bits = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            found = pa.array(np.array(bits, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "bits"])

    rows = whole_texts(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, bits long")


def covering(bits: list[int], radius: int, seed: int) -> list[int]:
    """Masks over the given bit positions: any `radius` of them are all outside of some mask."""
    size = 1 << (radius + 1)
    order = np.random.default_rng(seed).permutation(size)
    vector = {bit: int(order[i % size]) for i, bit in enumerate(bits)}
    odd = lambda v: sum(1 << b for b in bits if (vector[b] & v).bit_count() & 1)
    return sorted({odd(v) for v in range(1, size)})


def spanning(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Positions of links that connect what pairs within the radius connect, one link for each
    newly reached fingerprint, from the earliest one that reaches it: tables that bring the same
    fingerprints together then mostly find the same links."""
    links, left = [], np.arange(len(prints))
    while left.size > 1:
        reached, left = deque([int(left[0])]), left[1:]
        while reached and left.size:
            at = reached.popleft()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= radius
            found, left = left[near].tolist(), left[~near]
            links += [(at, other) for other in found]
            reached += found
    return links


def _meet(rows: DataFrame, radius: int, last: bool) -> DataFrame:
    """Links (a, b) within the buckets (mask, key) of (mask, key, bits, id). Rows of a bucket
    above BUCKET come back with b null, for the next level, unless this is the last."""

    def close(mask: int, bits: list[int], ids: list[int]) -> list[tuple]:
        if len(ids) == 1:
            return []
        prints = np.array(bits, np.int64).view(np.uint64)
        return [(mask, None, ids[i], ids[j]) for i, j in spanning(prints, radius)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, bits, ids, over, out = None, [], [], False, []
        names = ["mask", "bits", "a", "b"]

        def flush():
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in slices(batches, 8192):
            for mask, key, b, i in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (mask, key) != bucket:
                    if bucket and not over:
                        out += close(bucket[0], bits, ids)
                    bucket, bits, ids, over = (mask, key), [], [], False
                if over:
                    out.append((mask, b, i, None))
                    continue
                bits.append(b)
                ids.append(i)
                if len(ids) > BUCKET and not last:
                    out += [(mask, x, y, None) for x, y in zip(bits, ids, strict=True)]
                    bits, ids, over = [], [], True
            if len(out) >= 8192:
                yield flush()
        if bucket and not over:
            out += close(bucket[0], bits, ids)
        yield flush()

    ordered = rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "id")
    return ordered.mapInArrow(run, "mask long, bits long, a long, b long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links_within(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) between ids of the distinct fingerprints (bits, id) that connect exactly
    what all pairs within the radius connect."""
    everything = (1 << 64) - 1
    level, found = prints.withColumn("mask", F.lit(0).cast("long")), []
    masks = {0}
    for depth in range(LEVELS):
        finer = {}
        for mask in masks:
            free = [b for b in range(64) if not mask >> b & 1]
            finer[_signed(mask)] = sorted({mask | m for m in covering(free, radius, depth)})
        tables = F.create_map(
            *[x for k, v in finer.items() for x in (F.lit(k), F.array(*[F.lit(_signed(m)) for m in v]))]
        )
        rows = level.select("bits", "id", F.explode(tables[F.col("mask")]).alias("mask"))
        rows = rows.select("mask", F.col("mask").bitwiseAND(F.col("bits")).alias("key"), "bits", "id")
        met = stored(_meet(rows, radius, last=depth == LEVELS - 1), "met")
        found.append(met.where("b is not null").select("a", "b"))
        level = met.where("b is null").select("bits", F.col("a").alias("id"), "mask")
        left = [r.mask for r in level.select("mask").distinct().collect()]  # some of the masks
        masks = {m & everything for m in left}
        if not masks:
            break
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def classes(prints: DataFrame, radius: int = 3) -> DataFrame:
    """doc_id, bits, component of (doc_id, bits): the smallest doc_id reachable by links.

    Equal fingerprints are one class with its smallest doc_id as representative; only classes
    are compared. A null doc_id is in no class, and its component is null. Rows that repeat a
    doc_id with another text link all its texts.
    """
    known = prints.where("doc_id is not null")
    distinct = stored(known.groupBy("bits").agg(F.min("doc_id").alias("id")), "distinct")
    links = links_within(distinct, radius)
    first = known.groupBy("doc_id").agg(F.min("bits").alias("low"), F.max("bits").alias("high"))
    twice = first.where("low <> high").select("doc_id")
    same = known.join(twice, "doc_id").join(distinct, "bits")  # one document, several texts
    links = links.unionByName(same.select(F.col("doc_id").alias("a"), F.col("id").alias("b")))
    found = components(links)
    named = distinct.join(found, "id", "left")
    named = named.select("bits", F.coalesce("component", "id").alias("component"))
    by_class = prints.join(named, "bits", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return by_class.select("doc_id", "bits", component.alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id.

    Repeated rows, null texts and texts without words are documents like any others (the last
    two have fingerprint zero). Other columns are not read. An empty table gives an empty one.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    hexed = F.lpad(F.lower(F.hex("bits")), 16, "0")
    return classes(prints, radius).select(
        "doc_id", hexed.alias("fingerprint"), F.col("component").alias("component_id")
    )


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of docs that stay: of each group of near-duplicates the smallest doc_id, and of
    rows that repeat it the one with the smallest text. Rows of null doc_id all stay. Columns are
    those of docs."""
    found = near_duplicates(docs, shingle, radius)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("#gone")).distinct()
    left = docs.join(gone, docs["doc_id"].cast("long") == F.col("#gone"), "left_anti")
    apart = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    rank = F.row_number().over(Window.partitionBy("doc_id", "#apart").orderBy("text"))
    ranked = left.withColumn("#apart", apart).withColumn("#rank", rank)
    return ranked.where(F.col("#rank") == 1).select(*docs.columns)
