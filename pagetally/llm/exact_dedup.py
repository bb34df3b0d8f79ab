"""Exact duplicates by a tree-merge of sorted digest runs.

Every partition makes a run of its own: its digests in order, each with the smallest identifier
and the number of its rows. Runs then meet in binomial rounds. With P = fan ** rounds places, round
r sends the piece of a run whose digests have digit v at r to the place that differs from its own
in digit r alone, which is v there; each place merges the `fan` pieces it gets into one run. After
the last round a place has all runs of one range of digests. At every level equal digests become
one entry, so a text with very many copies is one entry of each run, never a group.

Entries are equal if their SHA-256 digests are and the checks that came with them, another hash of
the text and its length, agree as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetally.functions.columns import once
from pagetally.llm.common import parts, stored, whole_texts

#: Pieces of a run in one round, at most.
FAN = 8
#: Rows of a first run, at most; a partition with more makes several.
RUN = 1 << 20


def normalised(text: Column) -> Column:
    """Each run of blanks, tabs and line ends as one blank; null as empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[ \t-\r]+", " ")


def digests(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """row, part, id, sha, check, size and the carried columns of every row; stored once, so that
    the numbers of rows are fixed."""
    carried = F.struct(*carry, F.lit(0).alias("#")).alias("carried")
    texts = once(whole_texts(docs).select(F.col("doc_id").cast("long").alias("id"), carried, "text"), "plain", normalised(F.col("text")))
    rows = texts.select(
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("part"),
        "id",
        F.unhex(F.sha2("plain", 256)).alias("sha"),
        F.xxhash64("plain").alias("check"),
        F.octet_length("plain").cast("long").alias("size"),
        "carried",
    )
    return stored(rows, "digests")


#: Columns of a run: the digest in four words, checks, rows, and the smallest identifier with its
#: row; a null identifier comes after all others.
WIDTH = 4 + 2 + 1 + 3
CHECK, SIZE, COUNT, NULL, ID, ROW = range(4, WIDTH)


def merged(runs: list[np.ndarray]) -> np.ndarray:
    """One run of several; equal entries become one, with all rows and the smallest identifier.
    A run is an array of WIDTH rows of 64 bits; its columns are entries, in order."""
    all_ = np.concatenate(runs, axis=1)
    signed = all_.view(np.int64)
    order = np.lexsort((all_[ROW], signed[ID], all_[NULL], all_[SIZE], all_[CHECK], *all_[3::-1]))
    all_ = all_[:, order]
    if all_.shape[1] == 0:
        return all_
    new = np.ones(all_.shape[1], bool)
    new[1:] = (all_[: SIZE + 1, 1:] != all_[: SIZE + 1, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    out = all_[:, first]
    out[COUNT] = np.add.reduceat(all_[COUNT], first)
    return out


def _run_of(batch: pa.RecordBatch) -> np.ndarray:
    """The rows of a batch (id, sha, check, size, row) as entries."""
    n = batch.num_rows
    run = np.zeros((WIDTH, n), np.uint64)
    if n:
        sha = np.frombuffer(b"".join(batch.column("sha").to_pylist()), ">u8").reshape(n, 4)
        run[:4] = sha.T
        id_ = batch.column("id")
        run[CHECK] = batch.column("check").to_numpy().view(np.uint64)
        run[SIZE], run[COUNT] = batch.column("size").to_numpy(), 1
        run[NULL] = id_.is_null().to_numpy(zero_copy_only=False)
        run[ID] = id_.fill_null(0).to_numpy().view(np.uint64)
        run[ROW] = batch.column("row").to_numpy()
    return run


def _rows(names: list[str], *columns) -> pa.RecordBatch:
    kinds = {"packed": pa.binary(), "sha": pa.binary()}
    arrays = [pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def first_runs(rows: DataFrame, run_rows: int = RUN) -> DataFrame:
    """(part, packed): the runs of every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        n = 0

        def flush() -> pa.RecordBatch:
            return _rows(["part", "packed"], list(held), [merged(r).tobytes() for r in held.values()])

        for batch in batches:
            own = batch.column("part").to_numpy()
            entries = _run_of(batch)
            for part in np.unique(own).tolist():
                held.setdefault(part, []).append(entries[:, own == part])
            n += batch.num_rows
            if n >= run_rows:
                yield flush()
                held, n = {}, 0
        if held:
            yield flush()

    columns = rows.select("part", "id", "sha", "check", "size", "row")
    return columns.mapInArrow(run, "part long, packed binary")


def _unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64).reshape(WIDTH, -1)


def rounds_of(places: int, fan: int = FAN) -> tuple[int, int]:
    """Fan and number of rounds that have so many places at least."""
    rounds = 1
    while fan**rounds < places:
        rounds += 1
    least = next(f for f in range(1, fan + 1) if f**rounds >= places)
    return max(2, least), rounds


def tree_merged(runs: DataFrame, places: int, fan: int = FAN) -> DataFrame:
    """sha, check, size, n, id and row of every entry that has more than one row."""
    fan, rounds = rounds_of(places, fan)
    places = fan**rounds

    def pieces(place: int, entries: np.ndarray, r: int) -> pa.RecordBatch:
        """A run cut by the first r digits of its digests, each piece with the place it goes to."""
        rest = fan ** (rounds - r)
        home = ((entries[0] >> np.uint64(33)) * np.uint64(places)) >> np.uint64(31)
        target = (home // np.uint64(rest)).astype(np.int64) * rest + place % rest
        edges = np.flatnonzero(np.diff(target, prepend=-1))
        cut = np.split(entries, edges[1:], axis=1) if len(edges) else []
        return _rows(["place", "packed"], target[edges].tolist(), [np.ascontiguousarray(c).tobytes() for c in cut])

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pieces(part % places, _unpack(blob), 1)

    def received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        """The places that a task stands for, one as a rule, and their merged runs."""
        got: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for place, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got.setdefault(place, []).append(_unpack(blob))
        for place in sorted(got):
            yield place, merged(got.pop(place))

    def again(r: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for place, entries in received(batches):
                yield pieces(place, entries, r)

        return run

    names = ["sha", "check", "size", "n", "id", "row"]

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, entries in received(batches):
            e = entries[:, entries[COUNT] > 1]
            shas = e[:4].T.astype(">u8")
            signed = e.view(np.int64)
            ids = pa.array(signed[ID], pa.int64(), mask=e[NULL].astype(bool))
            yield _rows(names, [s.tobytes() for s in shas], signed[CHECK], signed[SIZE], signed[COUNT], ids, signed[ROW])

    sent = runs.mapInArrow(start, "place long, packed binary")
    for r in range(1, rounds + 1):
        moved = sent.repartitionById(places, F.col("place").cast("int"))
        sent = moved.mapInArrow(again(r + 1), "place long, packed binary") if r < rounds else moved
    return sent.mapInArrow(last, "sha binary, check long, size long, n long, id long, row long")


def _entries(runs: DataFrame) -> DataFrame:
    """part, sha, check and size of the entries of first runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                e = _unpack(blob)
                shas, signed = e[:4].T.astype(">u8"), e.view(np.int64)
                of = np.full(e.shape[1], part)
                yield _rows(["part", "sha", "check", "size"], of, [s.tobytes() for s in shas], signed[CHECK], signed[SIZE])

    return runs.mapInArrow(run, "part long, sha binary, check long, size long")


def mark(docs: DataFrame, carry: tuple[str, ...] = (), fan: int = FAN) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and `carried`, a struct of the carried
    columns, of every row of docs.

    Texts are equal if they are once each run of blanks, tabs and line ends is one blank; a null
    text is an empty one, a blank text is one blank. Of equal texts the row with the smallest
    doc_id stays, a null id after all others. Of rows that repeat both id and text one stays, the
    first in the input; a group without any id keeps its first row, and its keep_id is null.
    group_size counts rows. Other columns are not read unless they are carried; their names
    cannot clash.
    """
    rows = digests(docs, carry)
    runs = stored(first_runs(rows), "first_runs")
    groups = tree_merged(runs, parts(docs), fan)
    key = ["sha", "check", "size"]
    # Answers go back to the partitions that have such an entry, and there to the rows: a text
    # with very many copies is one answer per partition.
    found = _entries(runs).distinct().join(groups, key)
    answers = found.select("part", *key, "n", F.col("id").alias("keep"), F.col("row").alias("keep_row"))
    joined = rows.withColumn("part", F.col("part").cast("long")).join(answers, ["part", *key], "left")
    single = F.col("n").isNull()
    return joined.select(
        F.col("id").alias("doc_id"),
        F.when(single, F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "carried",
    )


def deduplicate(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    marked = mark(docs, tuple(docs.columns), fan).where("kept")
    return marked.select(*[F.col("carried")[c].alias(c) for c in docs.columns])
