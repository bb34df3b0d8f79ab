"""Cheapest repair of damaged conversations, by Hirschberg's divide and conquer.

The roles of a repaired conversation are an optional system turn and then pairs of user and
assistant, so four states tell how far one has come: nothing yet, after system, after user, after
assistant. Every row is kept, given another role or deleted, and turns can be inserted. The costs
of the ways into each state, from the front, and out of it, from the back, meet in the middle of a
sequence; the state that is best in sum is the crossing, and both halves are solved the same way.
Only two vectors of four costs are held, never a table of all rows.

Of equally cheap repairs the one with the ASCII-least audit counts. For that each forward cost
comes with the rank of its audit among those of the four states. The audit up to a row has one
letter other than I for each row and ends in one, so none of them is the beginning of another: the
ranks alone decide which crossing is the least, however the audit goes on.

A sequence is rows, or stretches of rows: four by four costs and ranks, composed from rows, are a
step like any other. A conversation is thus spread over as many partitions as it fills; each sums
up its stretch, the stretches are crossed first, and the rows of each one after that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetally.llm.common import BLANKS, parts, stored, whole_texts

REROLE, DELETE, INSERT, TRUNCATED_KEPT = 3, 4, 3, 3
INITIALS = "sua"
#: Faults of a row, in the order in which they are looked for after "none".
NONE, TRUNCATED, BLANK, DUPLICATE = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: No way. Ways that cost FAR more than another one are left out: from any state one can go on
#: like from any other for 4 (a system turn deleted) and two insertions more, and end for two.
NEVER, FAR = 1 << 40, 24
#: Turns to insert at the end of a conversation, from each state.
CLOSING = ("", "II", "I", "")


class Vector(NamedTuple):
    """Costs of the four states, and the ranks of their audits."""

    costs: tuple[int, ...]
    ranks: tuple[int, ...]


class Step(NamedTuple):
    """Cost from state to state, rank of its audit among those from the same state, and the audit
    itself where the step is one row."""

    costs: tuple[tuple[int, ...], ...]
    ranks: tuple[tuple[int, ...], ...]
    audits: tuple[tuple[str, ...], ...] = ()


def _inserted(state: int) -> int:
    """The state after an inserted turn."""
    return ASSISTANT if state == USER else USER


def row_step(initial: str, fault: int) -> Step:
    """What can be done with a row whose role begins with `initial`."""
    best = [[(NEVER, "")] * 4 for _ in STATES]

    def offer(origin: int, to: int, cost: int, audit: str) -> None:
        best[origin][to] = min(best[origin][to], (cost, audit))

    for origin in STATES:
        at = origin
        for n in range(3):  # two turns more lead back to the state after one
            spent, done = n * INSERT, "I" * n
            offer(origin, at, spent + DELETE, done + "D")
            if fault not in (BLANK, DUPLICATE):
                extra = TRUNCATED_KEPT if fault == TRUNCATED else 0
                following = _inserted(at)
                if initial == "s" and at == START:
                    offer(origin, SYSTEM, spent + extra, done + "K")
                if initial == INITIALS[following - 1]:
                    offer(origin, following, spent + extra, done + "K")
                offer(origin, following, spent + extra + REROLE, done + "R")
            at = _inserted(at)
    order = [sorted(STATES, key=lambda to: best[origin][to][1]) for origin in STATES]
    return Step(
        tuple(tuple(cost for cost, _ in line) for line in best),
        tuple(tuple(order[origin].index(to) for to in STATES) for origin in STATES),
        tuple(tuple(audit for _, audit in line) for line in best),
    )


#: By code: the place of the initial (other ones come last) times four, and the fault.
ROWS = [row_step(i, fault) for i in (*INITIALS, "") for fault in range(4)]


def only(state: int) -> Vector:
    return Vector(tuple(0 if q == state else NEVER for q in STATES), (0, 0, 0, 0))


def forward(before: Vector, step: Step) -> Vector:
    ways = [
        min((before.costs[q] + step.costs[q][to], before.ranks[q], q) for q in STATES) for to in STATES
    ]
    near = min(cost for cost, _, _ in ways) + FAR
    order = sorted(STATES, key=lambda to: (ways[to][1], step.ranks[ways[to][2]][to]))
    costs = tuple(cost if cost <= near and cost < NEVER else NEVER for cost, _, _ in ways)
    return Vector(costs, tuple(order.index(to) for to in STATES))


def backward(after: Vector, step: Step) -> Vector:
    costs = [min(step.costs[q][to] + after.costs[to] for to in STATES) for q in STATES]
    return Vector(tuple(min(c, NEVER) for c in costs), after.ranks)


def _swept(vector: Vector, steps: Sequence, one: Callable, memo: dict, step_of: Callable) -> Vector:
    """The vector after all steps, costs as they are. Vectors less their smallest cost are few, so
    a step is mostly looked up."""
    base = 0
    for s in steps:
        # A stretch is met once; only the codes of rows come again and again.
        known = memo.get((vector, s)) if isinstance(s, int) else None
        if known is None:
            moved = one(vector, step_of(s))
            least = min(moved.costs)
            costs = tuple(c - least if c < NEVER else NEVER for c in moved.costs)
            known = (least if least < NEVER else 0), Vector(costs, moved.ranks)
            if isinstance(s, int):
                memo[vector, s] = known
        base, vector = base + known[0], known[1]
    return Vector(tuple(c + base if c < NEVER else NEVER for c in vector.costs), vector.ranks)


class Solver:
    """Crossings of sequences; keeps what it has looked up."""

    def __init__(self) -> None:
        self.ahead: dict = {}
        self.back: dict = {}

    def _forward(self, vector: Vector, steps: Sequence) -> Vector:
        return _swept(vector, steps, forward, self.ahead, self._step)

    def _backward(self, vector: Vector, steps: Sequence) -> Vector:
        return _swept(vector, steps[::-1], backward, self.back, self._step)

    @staticmethod
    def _step(s) -> Step:
        return ROWS[s] if isinstance(s, int) else s

    def summed(self, rows: Sequence[int]) -> Step:
        """A stretch of rows as one step."""
        ways = [self._forward(only(q), rows) for q in STATES]
        return Step(tuple(w.costs for w in ways), tuple(w.ranks for w in ways))

    def end(self, steps: Sequence, origin: int = START) -> int:
        """The state before the closing turns."""
        last = self._forward(only(origin), steps)
        return min(STATES, key=lambda q: (last.costs[q] + INSERT * len(CLOSING[q]), last.ranks[q]))

    def crossings(self, steps: Sequence, origin: int, to: int) -> list[int]:
        """The state after each step on the best way, the last one included."""
        if len(steps) < 2:
            return [to] * len(steps)
        middle = len(steps) // 2
        ahead = self._forward(only(origin), steps[:middle])
        back = self._backward(only(to), steps[middle:])
        at = min(STATES, key=lambda q: (ahead.costs[q] + back.costs[q], ahead.ranks[q]))
        return self.crossings(steps[:middle], origin, at) + self.crossings(steps[middle:], at, to)

    def audit(self, rows: Sequence[int], origin: int, to: int) -> tuple[str, int]:
        """The audit of rows between two states, and its cost, without closing turns."""
        states = [origin, *self.crossings(rows, origin, to)]
        ways = list(zip(rows, states, states[1:], strict=False))
        letters = "".join(ROWS[r].audits[a][b] for r, a, b in ways)
        return letters, sum(ROWS[r].costs[a][b] for r, a, b in ways)


def repair_rows(codes: bytes) -> tuple[str, int]:
    """The audit and cost of a whole conversation of row codes."""
    solver, rows = Solver(), list(codes)
    end = solver.end(rows)
    letters, cost = solver.audit(rows, START, end)
    return letters + CLOSING[end], cost + INSERT * len(CLOSING[end])


def replay(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of a repaired conversation; turns that go have edit D."""
    state, turns = START, iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(turns)
        if edit in "IR":
            state = _inserted(state)
            role = "assistant" if state == ASSISTANT else "user"
        elif edit == "K":
            state = 1 + INITIALS.index(role[0])
        yield edit, role, text


# Rows of conversations


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with the faults that are planted by crc32(`conv_id:turn`) % 20: 0 drops a row, 1
    empties its text, 2 removes its `.!?`, 3 repeats it, 4 makes its role user. Null roles and
    texts, and null parts of the key, are one blank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), draw.alias("#draw"))
    rows = rows.where("`#draw` <> 0")
    text = F.when(F.col("#draw") == 1, "").when(F.col("#draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("#draw") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("#draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("#time")).drop("#time")


#: Ascending, and in Spark nulls come first then.
_ORDER = ["conv_id", "turn", "role", "digest"]


def _turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and a digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    turn = F.col("turn").cast("long").alias("turn")
    named = rows.select("conv_id", turn, role.alias("role"), text.alias("text"))
    both = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return named.withColumn("digest", F.unhex(F.sha2(both, 256)))


def _coded(turns: DataFrame) -> DataFrame:
    """The turns without their texts; `code` is that of the row, unless it is a duplicate."""
    shown = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(shown == "", BLANK).when(F.right(shown, F.lit(1)).isin(".", "!", "?"), NONE).otherwise(TRUNCATED)
    initial = F.instr(F.lit(INITIALS), F.left("role", F.lit(1)))
    place = F.when((initial > 0) & (F.col("role") != ""), initial - 1).otherwise(len(INITIALS))
    return turns.select("conv_id", "turn", "role", "digest", (place * 4 + fault).cast("int").alias("code"))


_STRETCH = (
    "part long, open boolean, codes binary, digests binary, n_turns long, first_turn long, last_turn long"
)


def _conv_type(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


def _table(columns: dict[str, tuple[pa.DataType, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for t, v in columns.values()], list(columns))


def _stretches(rows: DataFrame) -> DataFrame:
    """One row for the rows of a conversation in one partition of the sorted rows. Only the first
    and the last of a partition can be parts of a conversation; they are open, and keep digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        all_ = pa.Table.from_batches(held)
        convs, turns = all_["conv_id"].to_pylist(), all_["turn"].to_pylist()
        digests, codes = all_["digest"].to_pylist(), bytes(all_["code"].to_pylist())
        kind = all_.schema.field("conv_id").type
        edges = [0, *[i for i in range(1, len(convs)) if convs[i] != convs[i - 1]], len(convs)]
        part, out = TaskContext.get().partitionId(), []
        for a, b in zip(edges, edges[1:], strict=False):
            seen: set[bytes] = set()
            own = bytearray(codes[a:b])
            for i, digest in enumerate(digests[a:b]):
                if digest in seen and own[i] % 4 != BLANK:
                    own[i] = own[i] // 4 * 4 + DUPLICATE
                seen.add(digest)
            known = [t for t in turns[a:b] if t is not None]
            ends = (known[0], known[-1]) if known else (None, None)
            is_open = a == 0 or b == len(convs)
            kept = b"".join(digests[a:b]) if is_open else b""
            out.append((convs[a], part, is_open, bytes(own), kept, len(set(known)), *ends))
        types = [kind, pa.int64(), pa.bool_(), pa.binary(), pa.binary(), *[pa.int64()] * 3]
        names = ["conv_id", "part", "open", "codes", "digests", "n_turns", "first_turn", "last_turn"]
        yield _table({n: (t, list(v)) for n, t, v in zip(names, types, zip(*out, strict=True), strict=True)})

    n = parts(rows)
    dealt = rows.withColumn("#deal", F.monotonically_increasing_id())
    ordered = dealt.repartitionByRange(n, *_ORDER, "#deal").sortWithinPartitions(*_ORDER)
    return ordered.drop("#deal").mapInArrow(run, f"conv_id {_conv_type(rows)}, {_STRETCH}")


def _seen_before(stretches: DataFrame) -> DataFrame:
    """conv_id, part and the digests of an open stretch that an earlier one of its conversation
    has. A digest comes once per stretch, so there is no large group of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = {blob[i : i + 32] for i in range(0, len(blob), 32)}
                n = len(found)
                kind = batch.schema.field("conv_id").type
                yield _table({"conv_id": (kind, [conv] * n), "part": (pa.int64(), [part] * n), "digest": (pa.binary(), list(found))})

    opened = stretches.where("open").select("conv_id", "part", "digests")
    entries = opened.mapInArrow(run, f"conv_id {_conv_type(stretches)}, part long, digest binary")
    first = F.min("part").over(Window.partitionBy("conv_id", "digest"))
    later = entries.withColumn("first", first).where("part > first")
    return later.groupBy("conv_id", "part").agg(F.collect_list("digest").alias("seen"))


def _joined_on_stretch(left: DataFrame, right: DataFrame) -> DataFrame:
    renamed = right.withColumnsRenamed({"conv_id": "#conv", "part": "#part"})
    on = left["conv_id"].eqNullSafe(renamed["#conv"]) & (left["part"] == renamed["#part"])
    return left.join(renamed, on, "left").drop("#conv", "#part")


_OPEN = "part long, codes binary, n_turns long, first_turn long, last_turn long, costs array<long>, ranks array<long>"


def _summed(opened: DataFrame) -> DataFrame:
    """Open stretches with all their duplicates, and each one as a single step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver()
        for batch in batches:
            codes, costs, ranks = [], [], []
            for own, blob, seen in zip(*(batch.column(c).to_pylist() for c in ("codes", "digests", "seen")), strict=True):
                row, before = bytearray(own), set(seen or ())
                for i in range(len(row)):
                    if before and row[i] % 4 != BLANK and blob[32 * i : 32 * i + 32] in before:
                        row[i] = row[i] // 4 * 4 + DUPLICATE
                step = solver.summed(list(row))
                codes.append(bytes(row))
                costs.append([c for line in step.costs for c in line])
                ranks.append([r for line in step.ranks for r in line])
            same = [batch.column(c) for c in ("conv_id", "part")]
            ends = [batch.column(c) for c in ("n_turns", "first_turn", "last_turn")]
            lists = [pa.array(v, pa.list_(pa.int64())) for v in (costs, ranks)]
            names = ["conv_id", "part", "codes", "n_turns", "first_turn", "last_turn", "costs", "ranks"]
            yield pa.RecordBatch.from_arrays([*same, pa.array(codes, pa.binary()), *ends, *lists], names)

    return opened.mapInArrow(run, f"conv_id {_conv_type(opened)}, {_OPEN}")


_BORDER = "part long, origin int, to int, closing string, repeats long, illegal long"


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


def _borders(summed: DataFrame) -> DataFrame:
    """States at the ends of each open stretch, and what it has with the one before: a turn in
    common, an illegal pair of roles. A conversation has a row per partition at most here."""
    kind = _conv_type(summed)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns(["conv_id"]).to_pylist(), key=lambda r: r["part"])
        square = lambda v: tuple(tuple(v[i : i + 4]) for i in range(0, 16, 4))
        steps = [Step(square(r["costs"]), square(r["ranks"])) for r in rows]
        solver = Solver()
        end = solver.end(steps)
        states = [START, *solver.crossings(steps, START, end)]
        names = [*INITIALS, "-"]
        repeats, illegal, last_turn, last_initial = [], [], None, None
        for r in rows:
            first = names[r["first_code"] // 4]
            repeats.append(int(last_turn is not None and r["first_turn"] == last_turn))
            illegal.append(int(last_initial is not None and not _legal(last_initial + first)))
            last_turn = r["last_turn"] if r["last_turn"] is not None else last_turn
            last_initial = names[r["last_code"] // 4]
        closing = [""] * (len(rows) - 1) + [CLOSING[end]]
        conv = table["conv_id"].combine_chunks()
        columns = {"part": [r["part"] for r in rows], "origin": states[:-1], "to": states[1:], "closing": closing, "repeats": repeats, "illegal": illegal}
        types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        return pa.table([conv, *[pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)]], ["conv_id", *columns])

    byte = lambda i: F.ascii(F.substring("codes", i, 1).cast("string"))
    ends = summed.select("conv_id", "part", "first_turn", "last_turn", "costs", "ranks", byte(1).alias("first_code"), byte(-1).alias("last_code"))
    return ends.groupBy("conv_id").applyInArrow(run, f"conv_id {kind}, {_BORDER}")


_PIECE = "part long, n_turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _pieces(rows: DataFrame) -> DataFrame:
    """The audit of every stretch, and what it adds to the numbers of its conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver()
        legal = np.array([[_legal(a + b) for b in (*INITIALS, "-")] for a in (*INITIALS, "-")])
        names = ("codes", "origin", "to", "closing", "repeats", "illegal", "n_turns")
        for batch in batches:
            found = []
            for codes, origin, to, closing, repeats, illegal, n_turns in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                own = list(codes)
                if origin is None:  # a whole conversation
                    origin, to = START, solver.end(own)
                    closing = CLOSING[to]
                letters, cost = solver.audit(own, origin, to)
                code = np.frombuffer(codes, np.uint8)
                initial, faults = code // 4, np.bincount(code % 4, minlength=4).tolist()
                pairs = int((~legal[initial[:-1], initial[1:]]).sum()) + (illegal or 0)
                numbers = faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], pairs, cost + INSERT * len(closing)
                found.append((n_turns - (repeats or 0), *numbers, letters + closing))
            turns, *numbers, audits = zip(*found, strict=True) if found else [()] * 7
            same = [batch.column(c) for c in ("conv_id", "part")]
            ends = [batch.column(c) for c in ("first_turn", "last_turn")]
            counted = [pa.array(v, pa.int64()) for v in numbers]
            out = [*same, pa.array(turns, pa.int64()), *ends, *counted, pa.array(audits, pa.string())]
            columns = ["conv_id", "part", "n_turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
            yield pa.RecordBatch.from_arrays(out, columns)

    return rows.mapInArrow(run, f"conv_id {_conv_type(rows)}, {_PIECE}")


_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation
    of the turns (conv_id, turn, role, text), and of those in `convs` that have no turns.

    Turns come by number, null ones first; those of equal number by role, then by digest. A null
    conv_id is a conversation, null roles and texts are one blank. Rows that repeat count each
    time, and the later ones are duplicates. Roles count by their first letter; an empty one, or
    another letter, cannot stay. Columns besides the four are not read. An audit has one letter
    for each row, so it has to fit a string.
    """
    kind = _conv_type(rows)
    found = stored(_stretches(_coded(_turns(whole_texts(rows)))), "stretches")
    opened = _joined_on_stretch(found.where("open"), _seen_before(found))
    summed = stored(_summed(opened), "open_stretches")
    bordered = _joined_on_stretch(summed.drop("costs", "ranks"), _borders(summed))
    columns = ["conv_id", "part", "codes", "n_turns", "first_turn", "last_turn", "origin", "to", "closing", "repeats", "illegal"]
    closed = found.where("not open")
    pieces = _pieces(bordered.select(*columns).unionByName(closed.select(*columns[:6]), allowMissingColumns=True))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"])
    gaps = F.max("last_turn") - F.min("first_turn") + 1 - F.sum("n_turns")
    sums = [F.sum(c).alias(c) for c in _NUMBERS[1:]]
    whole = pieces.groupBy("conv_id").agg(gaps.alias("gaps"), *sums, F.array_join(ordered, "").alias("audit"))
    ids = (rows if convs is None else convs).select(F.col("conv_id").cast(kind).alias("conv_id")).distinct()
    renamed = whole.withColumnRenamed("conv_id", "#conv")
    joined = ids.join(renamed, ids["conv_id"].eqNullSafe(renamed["#conv"]), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _NUMBERS]
    return joined.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"))


def _replayed(rows: DataFrame, plans: DataFrame, carried: list[str], schema: str, emit: Callable) -> DataFrame:
    """What `emit(carried values, edits)` yields for every conversation, whose edits it gets as a
    stream: a task holds the audit of one conversation and a batch of its turns."""
    turns = _turns(whole_texts(rows)).withColumn("place", F.lit(1))
    heads = plans.withColumn("place", F.lit(0))
    both = turns.unionByName(heads, allowMissingColumns=True)
    ordered = both.repartition(parts(rows), "conv_id").sortWithinPartitions(_ORDER[0], "place", *_ORDER[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[dict]:
            for batch in batches:
                yield from batch.to_pylist()

        stream = lines()

        def turns_of() -> Iterator[tuple[str, str]]:
            for line in stream:
                yield line["role"], line["text"]

        for head in stream:
            edits = replay(head["audit"], turns_of())
            yield from emit([head["conv_id"], *[head[c] for c in carried]], edits)

    return ordered.select("conv_id", "place", "role", "text", *plans.columns[1:]).mapInArrow(run, schema)


def repaired_turns(rows: DataFrame, plans: DataFrame, batch: int = 1000) -> DataFrame:
    """conv_id, place, edit, role, text of the repaired conversations, inserted turns included."""
    kind = rows.select("conv_id").schema["conv_id"].dataType
    schema = f"conv_id {_conv_type(rows)}, place long, edit string, role string, text string"
    arrow = {"string": pa.string(), "int": pa.int32()}.get(kind.simpleString(), pa.int64())

    def emit(head: list, edits: Iterator) -> Iterator[pa.RecordBatch]:
        held, place = [], 0

        def flush() -> pa.RecordBatch:
            types = [arrow, pa.int64(), *[pa.string()] * 3]
            names = ["conv_id", "place", "edit", "role", "text"]
            return _table({n: (t, list(v)) for n, t, v in zip(names, types, zip(*held, strict=True), strict=True)})

        for edit, role, text in edits:
            if edit != "D":
                held.append((head[0], place, edit, role, text))
                place += 1
            if len(held) >= batch:
                yield flush()
                held = []
        if held:
            yield flush()

    return _replayed(rows, plans.select("conv_id", "audit"), [], schema, emit)


def with_digest(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plans with repaired_sha256, over the lines `role:text` of the repaired conversation,
    joined by newlines. A digest takes its bytes in order: one task reads all lines of a
    conversation, one after the other."""
    others = plans.columns[1:]
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in plans.schema]
    kind = {"string": pa.string(), "int": pa.int32()}
    types = [kind.get(f.dataType.simpleString(), pa.int64()) for f in plans.schema]

    def emit(head: list, edits: Iterator) -> Iterator[pa.RecordBatch]:
        sha, first = hashlib.sha256(), True
        for edit, role, text in edits:
            if edit != "D":
                sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        values = {n: (t, [v]) for n, t, v in zip(["conv_id", *others], types, head, strict=True)}
        yield _table(values | {"repaired_sha256": (pa.string(), [sha.hexdigest()])})

    return _replayed(rows, plans, others, ", ".join([*fields, "repaired_sha256 string"]), emit)
