"""Near-duplicate embeddings by NN-descent: a neighbour graph refined by its own neighbours.

Every vector keeps a short list of its nearest ones. A round brings the vectors of each list, and
of the lists a vector is in, together and compares them with one another: neighbours of
neighbours are likely neighbours. The lists start from the order of random projections. A list
whose entries are all links is saturated and becomes longer. Vectors travel in eight bits per
component; whatever comes near the threshold is compared again exactly, in double precision.

The links found join the vectors into components. Lists have an end, groups of near copies need
not: so components with a list that was ever full of links are compared with one another as far
as their extents allow a link, and all vectors of a component are compared in blocks, which counts
the links of each exactly without a row per pair. An audit compares some vectors with all others,
both any ones and those that have something near the threshold, until it has seen enough links. It
asks for more rounds while too many of them are missing; if the last round leaves it short, all
vectors of a kind are compared. What it has found is logged and returned.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetally.llm.common import only_last, slices, stored, with_fields
from pagetally.llm.components import small_components

log = logging.getLogger(__name__)


#: A vector with more than one in HOT of all rows is dealt to SPREAD tasks; there are fewer than HOT.
HOT, SPREAD = 1024, 64


@dataclass(frozen=True)
class Settings:
    """`lists` and `longest` are the first and the greatest length of a list, `orders` the random
    projections, each linking a vector to the `ahead` next ones. The audit takes `audited` vectors
    at random and as many with near ones, and more at random, up to `most_audited`, while it has
    seen less than `enough` links. Components are compared in blocks of `block` vectors."""

    threshold: float = 0.98
    lists: int = 8
    longest: int = 64
    orders: int = 4
    ahead: int = 6
    bits: int = 32
    offers: int = 4
    rounds: int = 3
    more_rounds: int = 2
    most_rounds: int = 9
    recall: float = 0.98
    audited: int = 512
    most_audited: int = 4096
    enough: int = 200
    block: int = 256
    slack: float = 0.01
    seed: int = 1


def usable(rows: DataFrame) -> DataFrame:
    """Whether a vector can have links at all, and its kind, with which it is compared."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = ~F.exists(x, lambda v: v != 0)
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
    kind = F.concat_ws("/", F.size(x).cast("string"), F.col("label").cast("string"))
    rows = rows.withColumn("usable", F.coalesce(known & ~bad & ~zero, F.lit(False)))
    return rows.withColumn("kind", F.when(F.col("usable"), kind))


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no square runs over or to zero
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distinct(rows: DataFrame) -> DataFrame:
    """The different vectors of each kind (label and length): kind, embedding, id (the smallest
    vec_id), copies."""
    return (
        rows.where("usable")
        .groupBy("kind", "embedding")
        .agg(F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("copies"))
    )


def nodes(vectors: DataFrame) -> DataFrame:
    """The different vectors (kind, embedding, id, copies) with unit (the vector at length 1, in
    double precision) and small (in eight bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            units, smalls = [], []
            for vector in batch.column("embedding").to_pylist():
                unit = _unit([vector])[0]
                units.append(unit.tobytes())
                smalls.append(np.round(unit * (127 / np.abs(unit).max())).astype(np.int8).tobytes())
            new = [pa.array(units, pa.binary()), pa.array(smalls, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "unit", "small"])

    return vectors.mapInArrow(run, with_fields(vectors, "unit binary, small binary"))


def _smalls(blobs: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(b, np.int8) for b in blobs]).astype(np.float32)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _pairs(a: list, b: list, sim: list) -> pa.RecordBatch:
    columns = [np.concatenate(c) if c else np.zeros(0) for c in (a, b, sim)]
    kinds = (np.int64, np.int64, np.float64)
    arrays = [pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["a", "b", "sim"])


PAIRS = "a long, b long, sim double"


def first_lists(points: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b, sim) that are close in the order of some random projections."""
    s = settings

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in slices(batches, 1024):
            out = []
            for row in batch.to_pylist():
                unit = np.frombuffer(row["unit"])
                if len(unit) not in planes:
                    rng = np.random.default_rng(s.seed)
                    planes[len(unit)] = rng.normal(size=(s.orders * s.bits, len(unit)))
                signs = (planes[len(unit)] @ unit > 0).reshape(s.orders, s.bits)
                for order, bits in enumerate(signs):
                    code = int("".join("01"[int(x)] for x in bits), 2)
                    out.append((row["kind"], order, code, row["id"], row["small"]))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "order", "code", "id", "small"])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in slices(batches, 4096):
            rows, a, b, sim = held + batch.to_pylist(), [], [], []
            group = [(r["kind"], r["order"]) for r in rows]
            edges = [i for i in range(len(rows)) if not i or group[i] != group[i - 1]] + [len(rows)]
            for start, end in zip(edges, edges[1:], strict=False):
                x = _smalls([r["small"] for r in rows[start:end]])
                ids = np.array([r["id"] for r in rows[start:end]])
                for d in range(1, min(s.ahead, end - start - 1) + 1):
                    found = (x[:-d] * x[d:]).sum(axis=1)
                    a += [ids[:-d], ids[d:]]
                    b += [ids[d:], ids[:-d]]
                    sim += [found, found]
            held = rows[-s.ahead :]
            yield _pairs(a, b, sim)

    coded = points.mapInArrow(codes, "kind string, `order` int, code long, id long, small binary")
    key = ("kind", "order", "code", "id")
    return coded.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(close, PAIRS)


def best(pairs: DataFrame, settings: Settings) -> DataFrame:
    """The lists (a, b, sim, size, next, full, first) of pairs (a, b, sim): of each a the nearest ones, as many as
    the size that its pairs bring, the first length if they bring none. `next` is that size,
    doubled where the list is full of links, as `full` says; `first` marks the nearest."""
    s = settings
    if "size" not in pairs.columns:
        pairs = pairs.withColumn("size", F.lit(None).cast("int"))
    own = Window.partitionBy("a")
    once = pairs.repartition("a").groupBy("a", "b").agg(F.max("sim").alias("sim"), F.max("size").alias("size"))
    rank = F.row_number().over(own.orderBy(F.desc("sim"), "b"))
    sized = once.withColumn("size", F.coalesce(F.max("size").over(own), F.lit(s.lists)))
    kept = sized.withColumn("rank", rank).where("rank <= size")
    full = F.count_if(F.col("sim") >= s.threshold - s.slack).over(own) >= F.col("size")
    grown = F.when(full, F.least(2 * F.col("size"), F.lit(s.longest))).otherwise(F.col("size"))
    first = (F.col("rank") == 1).alias("first")
    return kept.select("a", "b", "sim", "size", grown.alias("next"), full.alias("full"), first)


def full_lists(lists: DataFrame, settings: Settings) -> DataFrame:
    """The ids whose lists are full of links, or once were and then became longer."""
    grown = F.col("full") | (F.col("size") > settings.lists)
    return lists.where(F.col("first") & grown).select(F.col("a").alias("id"))


def next_lists(points: DataFrame, lists: DataFrame, settings: Settings) -> DataFrame:
    """The lists of the next round."""
    s = settings
    more = refine(points, lists, s)
    # A link that one end is offered is offered to the other one as well, so that it stays in a
    # list or both of its ends have full ones.
    ends = [F.struct("a", "b", "sim"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "sim")]
    linked = F.col("sim") >= s.threshold - s.slack
    offers = more.select(F.inline(F.when(linked, F.array(*ends)).otherwise(F.array(ends[0]))))
    kept = lists.select("a", "b", "sim", F.col("next").alias("size"))
    return best(kept.unionByName(offers, allowMissingColumns=True), s)


def refine(points: DataFrame, lists: DataFrame, settings: Settings) -> DataFrame:
    """New pairs (a, b, sim): members of one list, or of the lists that have the same member."""
    s = settings
    nearest = F.row_number().over(Window.partitionBy("pivot").orderBy(F.desc("sim"), "id"))
    back = lists.select(F.col("b").alias("pivot"), F.col("a").alias("id"), "sim", "size")
    back = back.withColumn("rank", nearest).where(F.col("rank") <= s.longest).where("rank <= size")
    forth = lists.select(F.col("a").alias("pivot"), F.col("b").alias("id"))
    both = forth.unionByName(back.select("pivot", "id")).distinct()
    # What a member brings: its vector, its list, and how near a new entry has to be.
    state = lists.groupBy(F.col("a").alias("id")).agg(
        F.when(F.count("*") >= F.max("size"), F.min("sim")).otherwise(F.lit(-2.0)).alias("worst"),
        F.collect_list("b").alias("has"),
    )
    members = points.select("id", "small").join(state, "id")
    groups = both.join(members, "id").groupBy("pivot").agg(
        F.collect_list(F.struct("id", "small", "worst", "has")).alias("members")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            a, b, sim = [], [], []
            for members in batch.column("members").to_pylist():
                if len(members) < 2:
                    continue
                x = _smalls([m["small"] for m in members])
                ids = np.array([m["id"] for m in members])
                found = x @ x.T
                np.fill_diagonal(found, -3)
                place = {i: k for k, i in enumerate(ids.tolist())}
                for k, m in enumerate(members):
                    row = found[k]
                    row[[place[i] for i in m["has"] if i in place]] = -3
                    offered = np.argsort(-row)[: s.offers]
                    offered = offered[row[offered] > m["worst"]]
                    if offered.size:
                        a.append(np.full(offered.size, m["id"]))
                        b.append(ids[offered])
                        sim.append(row[offered])
            yield _pairs(a, b, sim)

    return groups.select("members").mapInArrow(run, PAIRS)


def links(points: DataFrame, lists: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) of the lists whose cosine is at least the threshold, compared exactly."""
    s = settings
    near = lists.where(F.col("sim") >= s.threshold - s.slack)
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = [points.select(F.col("id").alias(c), F.col("unit").alias(f"unit_{c}")) for c in "ab"]
    both = near.join(ends[0], "a").join(ends[1], "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            ends = zip(*(batch.column(f"unit_{c}").to_pylist() for c in "ab"), strict=True)
            kept = pa.array([bool(np.frombuffer(x) @ np.frombuffer(y) >= s.threshold) for x, y in ends])
            yield batch.select(["a", "b"]).filter(kept)

    return both.select("a", "b", "unit_a", "unit_b").mapInArrow(run, "a long, b long")


def _dealt(rows: DataFrame, groups: tuple[str, ...], settings: Settings) -> DataFrame:
    """The rows of each group dealt out to blocks, once for each pair (i, j) of blocks that theirs
    (`own`) is in."""
    blocks = F.ceil(F.col("n") / settings.block).cast("int")
    sizes = stored(rows.groupBy(*groups).agg(F.count("*").alias("n")).withColumn("blocks", blocks), "blocks")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = sizes.where(F.col("n") * HOT > total)
    rows = _spread_join(rows, sizes.drop("n"), list(groups), large, "id")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    ends = {"i": F.least("own", "other"), "j": F.greatest("own", "other")}
    return rows.withColumns(ends).drop("blocks", "other")


def _spread_join(rows: DataFrame, others: DataFrame, key: list[str], hot: DataFrame, by: str) -> DataFrame:
    """The rows with the columns of others, which has one row for each key. Rows of the keys in
    hot, fewer than HOT, are dealt to SPREAD tasks by another column."""
    hot = F.broadcast(hot.select(*key, F.lit(SPREAD).alias("#spread")))
    spread = F.coalesce("#spread", F.lit(1)).cast("long")
    deal = F.pmod(F.xxhash64(by), spread).alias("#deal")
    every = F.explode(F.sequence(F.lit(0).cast("long"), spread - 1)).alias("#deal")
    mine = rows.join(hot, key, "left").select(*rows.columns, deal)
    theirs = others.join(hot, key, "left").select(*others.columns, every)
    return mine.join(theirs, [*key, "#deal"]).drop("#deal")


def _sides(group: pa.Table, blobs: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a pair of blocks: the vectors, and the rows of either block."""
    own = group.column("own").to_numpy()
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    unit = np.stack([np.frombuffer(u) for u in group.column(blobs).to_pylist()])
    return unit, np.flatnonzero(own == i), np.flatnonzero(own == j)


def crossing(rows: DataFrame, groups: tuple[str, ...], settings: Settings) -> DataFrame:
    """Links (a, b) between the components of a group, of rows (id, component, unit): all its vectors
    are compared exactly, and one link for two components and pair of blocks is returned."""
    s = settings

    def run(group: pa.Table) -> pa.Table:
        unit, left, right = _sides(group, "unit")
        ids, component = group.column("id").to_numpy(), group.column("component").to_numpy()
        linked = unit[left] @ unit[right].T >= s.threshold
        linked &= component[left][:, None] != component[right]
        x, y = (side[at] for side, at in zip((left, right), np.nonzero(linked), strict=True))
        ends = np.sort(np.stack([component[x], component[y]]), axis=0)
        first = np.unique(ends, axis=1, return_index=True)[1] if x.size else np.zeros(0, np.int64)
        return pa.table({"a": ids[x[first]], "b": ids[y[first]]})

    dealt = _dealt(rows.select(*groups, "id", "component", "unit"), groups, s)
    return dealt.groupBy(*groups, "i", "j").applyInArrow(run, "a long, b long")


def _within(rows: DataFrame, others: tuple[str, ...], out: str) -> DataFrame:
    """The columns `others` of rows with `angle`, that between the vectors unit and centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            ends = zip(*(batch.column(c).to_pylist() for c in ("unit", "centre")), strict=True)
            cosines = np.array([np.frombuffer(x) @ np.frombuffer(y) for x, y in ends], np.float64)
            angles = pa.array(np.arccos(np.clip(cosines, -1, 1)))
            own = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*own, angles], [*others, "angle"])

    columns = dict.fromkeys((*others, "unit", "centre"))
    return rows.select(*columns).mapInArrow(run, f"{out}, angle double")


def bridges(points: DataFrame, found: DataFrame, full: DataFrame, settings: Settings) -> DataFrame | None:
    """Links (a, b) between different components of found (id, component) that have one of the ids
    in full, without a miss; None where no two of them are near enough.

    A full list shows its own group alone, so another group within the threshold stays out of
    sight. A component lies within an angle of its smallest id; two of them can have a link only
    if these balls come near enough, and only by vectors that come near enough to the other ball.
    Such vectors are compared in blocks.
    """
    s = settings
    most = math.acos(s.threshold) + 1e-6  # what arccos loses near 1 is less
    chosen = found.join(full, "id").select("component").distinct()
    members = points.select("kind", "id", "unit").join(found, "id").join(chosen, "component")
    members = stored(members.select("kind", "id", "component", "unit"), "members")
    centres = members.where("id = component").select("kind", "component", F.col("unit").alias("centre"))
    to_centre = _within(members.join(centres.drop("kind"), "component"), ("component",), "component long")
    balls = centres.join(to_centre.groupBy("component").agg(F.max("angle").alias("radius")), "component")
    balls = stored(balls.select("kind", F.col("component").alias("id"), "centre", "radius"), "balls")

    def run(group: pa.Table) -> pa.Table:
        unit, left, right = _sides(group, "centre")
        ids, radius = group.column("id").to_numpy(), group.column("radius").to_numpy()
        angles = np.arccos(np.clip(unit[left] @ unit[right].T, -1, 1))
        near = angles - radius[left][:, None] - radius[right] <= most
        near &= ids[left][:, None] < ids[right] if group.column("i")[0] == group.column("j")[0] else True
        x, y = np.nonzero(near)
        return pa.table({"low": ids[left[x]], "high": ids[right[y]]})

    pairs = _dealt(balls, ("kind",), s).groupBy("kind", "i", "j").applyInArrow(run, "low long, high long")
    pairs = stored(pairs, "near_balls")
    if pairs.isEmpty():
        return None
    sides = [
        pairs.select("low", "high", F.col(own).alias("component"), F.col(other).alias("other"))
        for own, other in (("low", "high"), ("high", "low"))
    ]
    facing = sides[0].unionByName(sides[1]).join(balls.select(F.col("id").alias("other"), "centre", "radius"), "other")
    kept = ("low", "high", "id", "component", "unit", "radius")
    types = "low long, high long, id long, component long, unit binary, radius double"
    reached = _within(members.drop("kind").join(facing, "component"), kept, types)
    reached = reached.where(F.col("angle") <= F.col("radius") + most)
    return crossing(stored(reached.drop("angle", "radius"), "reached"), ("low", "high"), s)


def joined_by(found: DataFrame, more: DataFrame) -> DataFrame:
    """The components found, joined by more links (a, b)."""
    ends = [found.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab"]
    between = more.join(ends[0], "a", "left").join(ends[1], "b", "left")
    pair = (F.coalesce(f"of_{c}", c).alias(c) for c in "ab")
    moved = stored(small_components(between.select(*pair).distinct()), "joined")
    alone = more.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(found, "id", "left_anti")
    every = found.unionByName(alone.select("id", F.col("id").alias("component")))
    to = moved.select(F.col("id").alias("component"), F.col("component").alias("to"))
    return every.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))


def counted(points: DataFrame, found: DataFrame, settings: Settings) -> DataFrame:
    """id and n_links within its component, for the ids of found (id, component).

    A component is dealt out to blocks, and each pair of blocks is compared in one place. What is
    returned is a count per vector; copies of a vector count by their number.
    """
    s = settings
    if found.isEmpty():
        return points.sparkSession.createDataFrame([], "id long, n_links long")
    rows = points.select("id", "copies", "unit").join(found, "id")
    rows = _dealt(rows, ("component",), s)

    def run(group: pa.Table) -> pa.Table:
        unit, left, right = _sides(group, "unit")
        ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
        linked = unit[left] @ unit[right].T >= s.threshold
        same = group.column("i")[0] == group.column("j")[0]
        if same:
            np.fill_diagonal(linked, False)
        n = np.zeros(len(ids), np.int64)
        n[left] += linked @ copies[right]
        if not same:
            n[right] += copies[left] @ linked
        return pa.table({"id": ids, "n": n})

    parts = rows.groupBy("component", "i", "j").applyInArrow(run, "id long, n long")
    return parts.groupBy("id").agg(F.sum("n").alias("n_links"))


class Audit(NamedTuple):
    """Vectors that were compared with all others, their links, and those of them that were found."""

    asked: int
    links: int
    found: int

    @property
    def recall(self) -> float:
        """The share found; not a number where none of the vectors has a link. Then less than 3 in
        `asked` vectors have one, with a probability of 95 per cent."""
        return self.found / self.links if self.links else math.nan


def _asked(points: DataFrame, near: DataFrame, n_links: DataFrame, some: int, settings: Settings) -> list:
    """kind, id, unit and n of `some` vectors at random, and of some that have near ones."""
    order = F.xxhash64(F.col("id"), F.lit(settings.seed))
    chosen = points.select("id").orderBy(order, "id").limit(some)
    chosen = chosen.unionByName(near.orderBy(order, "id").limit(settings.audited)).distinct()
    asked = points.select("kind", "id", "unit").join(F.broadcast(chosen), "id").join(n_links, "id", "left")
    return asked.select("kind", "id", "unit", F.coalesce("n_links", F.lit(0)).alias("n")).collect()


def audit(points: DataFrame, near: DataFrame, n_links: DataFrame, settings: Settings) -> Audit:
    """How many links of some vectors were found: any ones, and some of the ids in `near`."""
    s, some = settings, settings.audited
    while True:
        asked = _asked(points, near, n_links, some, s)  # some thousand rows at most
        true = _true_links(points, asked, s)
        links = sum(true.values())
        if links >= s.enough or some >= s.most_audited or len(asked) < some:
            found = sum(min(r["n"], true.get(r["id"], 0)) for r in asked)
            return Audit(len(asked), links, found)
        some = min(4 * some, s.most_audited)


def _true_links(points: DataFrame, asked: list, settings: Settings) -> dict[int, int]:
    """The links of each of the vectors asked for, from a comparison with all others."""
    s = settings
    by_kind: dict[str, list] = {}
    for row in asked:
        by_kind.setdefault(row["kind"], []).append(row)
    ids = {k: np.array([r["id"] for r in rows]) for k, rows in by_kind.items()}
    units = {k: np.stack([np.frombuffer(r["unit"]) for r in rows]) for k, rows in by_kind.items()}
    shared = points.sparkSession.sparkContext.broadcast((ids, units))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = shared.value
        n = {k: np.zeros(len(v), np.int64) for k, v in ids.items()}
        for batch in slices(batches, 1024):
            kinds = np.array(batch.column("kind").to_pylist(), object)
            own, copies = batch.column("id").to_numpy(), batch.column("copies").to_numpy()
            blobs = batch.column("unit").to_pylist()
            for kind in set(kinds.tolist()) & ids.keys():
                at = np.flatnonzero(kinds == kind)
                x = np.stack([np.frombuffer(blobs[i]) for i in at])
                linked = (units[kind] @ x.T >= s.threshold) & (ids[kind][:, None] != own[at])
                n[kind] += linked @ copies[at]
        columns = [np.concatenate([*d.values(), np.zeros(0, np.int64)]) for d in (ids, n)]
        arrays = [pa.array(c.astype(np.int64)) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "n"])

    every = points.select("kind", "id", "copies", "unit").mapInArrow(run, "id long, n long")
    return {r["id"]: r["n"] for r in every.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def _components(points: DataFrame, lists: DataFrame, settings: Settings) -> DataFrame:
    """id and component of the ids that have links, from lists and from bridges between them."""
    linked = stored(links(points, lists, settings), "links")
    found = stored(small_components(linked), "found")
    full = full_lists(lists, settings)
    if full.isEmpty():
        return found
    more = bridges(points, found, full, settings)
    return found if more is None else stored(joined_by(found, stored(more, "bridges")), "found")


def _with_links(rows: DataFrame, points: DataFrame, found: DataFrame, n_links: DataFrame) -> DataFrame:
    """The usable rows with the links and the component of their vector. Rows with a vector that
    very many others have are dealt to several tasks."""
    of_node = points.select("kind", "embedding", "id", "copies").join(found, "id", "left").join(n_links, "id", "left")
    total = points.agg(F.sum("copies")).first()[0] or 0
    n = (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    theirs = of_node.select("kind", "embedding", n, F.coalesce("component", "id").alias("component"))
    copied = points.where(F.col("copies") * HOT > total)
    mine = rows.select("vec_id", "kind", "embedding")
    joined = _spread_join(mine, theirs, ["kind", "embedding"], copied, "vec_id")
    return joined.select("vec_id", "n_links", "component")


def near_duplicates(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of embeddings: vec_id, n_links, component_id, kept.

    Vectors are compared if their labels are equal and their lengths too. A vector that is null,
    zero, empty, or has a null or non-finite component, and one whose label or vec_id is null, has
    no links and is its own component; kept is true for it, as for the smallest vec_id of every
    component. Equal vectors are copies: linked with one another and with all links of the other.
    Rows that repeat a vec_id with the same vector count once; with another vector, each has the
    links of its own. Other columns are not read.
    """
    return audited(embeddings, settings)[0]


def audited(embeddings: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, Audit]:
    """The rows of near_duplicates, and the audit of their links before an exact end, if any."""
    s = settings
    rows = usable(embeddings.select(F.col("vec_id").cast("long"), "embedding", "label"))
    points = stored(nodes(distinct(rows)), "nodes")
    trail: list[str] = []
    lists, wanted = best(first_lists(points, s), s), s.rounds
    lists, rounds = stored(lists, "lists", trail), 0
    while True:
        while rounds < wanted:
            lists = stored(next_lists(points, lists, s), "lists", trail)
            only_last(points.sparkSession, trail)
            rounds += 1
        found = _components(points, lists, s)
        n_links = stored(counted(points, found, s), "n_links")
        near = lists.where("first").where(F.col("sim") >= s.threshold - 2 * s.slack).select(F.col("a").alias("id"))
        seen = audit(points, near, n_links, s)
        log.info("%s; recall %s after %s rounds", seen, seen.recall, rounds)
        if seen.links == 0 or seen.recall >= s.recall:
            break
        if rounds >= s.most_rounds:
            rows_of = points.select("kind", "id", "unit").join(found, "id", "left")
            rows_of = rows_of.withColumn("component", F.coalesce("component", "id"))
            found = stored(joined_by(found, stored(crossing(rows_of, ("kind",), s), "crossing")), "found")
            n_links = stored(counted(points, found, s), "n_links")
            break
        wanted += s.more_rounds
    joined = _with_links(rows.where("usable"), points, found, n_links)
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component"))
    every = joined.unionByName(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept")
    return every.select("vec_id", "n_links", F.col("component").alias("component_id"), kept), seen
