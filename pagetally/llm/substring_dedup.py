"""Removal of word passages that an earlier document has, by super-k-mer partitioning.

A window is so many consecutive words. Its minimiser is the smallest hash among its pairs of
words; neighbouring windows mostly share it, and such windows travel together as one packed
string, a super-k-mer, to the bucket of their minimiser. Equal windows have equal minimisers, so
they meet in one bucket; there the windows are sorted as strings and counted exactly.

What a task can settle alone it does before the shuffle: of equal super-k-mers among its
documents only those of the smallest doc_id are sent as strings. A passage that very many
documents share so comes to its bucket a few times per task, not once per document.

A minimiser that would fill a bucket by itself is hot. Its windows travel one by one, to the bucket
of a hash of all their words: equal windows still meet, and different ones spread.

A pack falls into a piece per bucket, and small pieces compress badly and cost time each. So very
many buckets are reached in two exchanges: packs are cut by group of buckets first, and what
comes together of a group is packed anew and cut by bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetally.llm.common import even_keys, parts, slices, stored, whole_texts, with_fields, words

WINDOW = 13
#: Pairs whose words have so few bytes both come after all others: the most frequent pairs are
#: among them, and would otherwise draw very many windows to one bucket.
SHORT = 4
#: Characters of text that a task packs at once, and the level of compression.
PACK = 4 << 20
LEVEL = 6
#: Hot minimisers are looked for in one of so many documents, among those with so many bytes there.
#: Which ones are hot decides where windows are counted, not what is found.
SAMPLE = 16
LEAST = 1 << 16
#: Buckets that one exchange deals to at most; the pieces of a pack are as many. More buckets take
#: two exchanges, each with about the square root of their number.
FAN = 2048


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def minimisers(hashes: np.ndarray, short: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The smallest hash of the pairs in every window, for the hashes of all words and whether
    they are short. It depends on the words of the window alone."""
    late = short[:-1] & short[1:]
    low = _mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]) >> np.uint64(1)
    low[late] |= np.uint64(1 << 63)
    have, want = 1, window - 1
    while have < want:  # the minimum over `have` pairs, doubled up to `want`
        step = min(have, want - have)
        low, have = np.minimum(low[:-step], low[step:]), have + step
    return low


NO_HOT = np.zeros(0, np.uint64)


def super_kmers(tokens: list[bytes], ends: list[int], window: int = WINDOW, hot: np.ndarray = NO_HOT):
    """Super-k-mers of the documents whose words, one after the other, are `tokens`; document d
    ends before word ends[d]. Arrays: document, first word, windows, minimiser. Windows of hot
    minimisers come one by one, with a hash of all their words for the minimiser."""
    from xxhash import xxh64_intdigest

    none = np.zeros(0, np.int64)
    if len(tokens) < window:
        return none, none, none, none.astype(np.uint64)
    hashes = np.fromiter(map(xxh64_intdigest, tokens), np.uint64, len(tokens))
    short = np.fromiter(map(len, tokens), np.int64, len(tokens)) <= SHORT
    low = minimisers(hashes, short, window)
    of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    inside = of[: len(low)] == of[window - 1 :]  # windows within one document
    at = np.flatnonzero(inside)
    if not at.size:
        return none, none, none, none.astype(np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (low[at[1:]] != low[at[:-1]]) | (of[at[1:]] != of[at[:-1]])
    if len(hot):
        single = np.isin(low[at], hot)
        new |= single
        whole, spots = np.zeros(single.sum(), np.uint64), at[single]
        for k in range(window):
            whole = _mix(whole * np.uint64(0x9E3779B97F4A7C15) + hashes[spots + k])
        low[spots] = whole
    first = np.flatnonzero(new)
    return of[at[first]], at[first], np.diff(first, append=len(at)), low[at[first]]


def _pack(arrays: list[np.ndarray], text: bytes) -> bytes:
    import zstandard

    sizes = np.array([len(a) for a in arrays] + [len(text)], np.int64).tobytes()
    body = b"".join(a.tobytes() for a in arrays) + text
    return sizes + zstandard.ZstdCompressor(level=LEVEL).compress(body)


#: A packed bucket. Documents: id and text check. Super-k-mers to be counted: document, first
#: word, windows, minimiser, length of the string. Super-k-mers known to be repeated: document,
#: first word, windows. Documents and first words are kept as differences.
KINDS = ("<i8", "<u4", "<i4", "<i4", "<i4", "<u4", "<i4", "<i4", "<i4", "<i4")


def _unpack(blob: bytes) -> tuple[list[np.ndarray], bytes]:
    import zstandard

    head = 8 * (len(KINDS) + 1)
    sizes = np.frombuffer(blob[:head], np.int64)
    body, arrays, at = zstandard.ZstdDecompressor().decompress(blob[head:]), [], 0
    for kind, size in zip(KINDS, sizes, strict=False):
        arrays.append(np.frombuffer(body, kind, size, at))
        at += arrays[-1].nbytes
    return arrays, body[at:]


def _buckets_of(docs: list[tuple[int, int, list[bytes]]], buckets: int, window: int, hot: np.ndarray) -> Iterator[tuple]:
    """(bucket, packed) of documents (doc_id, check, words)."""
    tokens = [t for _, _, own in docs for t in own]
    ends = np.cumsum([len(own) for _, _, own in docs])
    of, start, count, low = super_kmers(tokens, ends.tolist(), window, hot)
    if not len(of):
        return
    joined, stop = b" ".join(tokens), np.cumsum([len(t) + 1 for t in tokens]) - 1
    begin = np.concatenate(([0], stop[:-1] + 1))
    strings = [
        joined[a:b]
        for a, b in zip(begin[start].tolist(), stop[start + count + window - 2].tolist(), strict=True)
    ]
    ids = np.array([d for d, _, _ in docs], np.int64)
    checks = np.array([c for _, c, _ in docs], np.uint32)
    # Of equal super-k-mers, those of another document than the smallest are settled.
    smallest: dict[bytes, int] = {}
    owner = ids[of]
    for s, d in zip(strings, owner.tolist(), strict=True):
        if smallest.setdefault(s, d) > d:
            smallest[s] = d
    least = np.fromiter(map(smallest.__getitem__, strings), np.int64, len(strings))
    settled = owner > least
    first = start - np.concatenate(([0], ends[:-1]))[of]  # word within the document
    bucket = (low % np.uint64(buckets)).astype(np.int64)
    tag = (low // np.uint64(buckets)).astype(np.uint32)
    yield from _cut(bucket, ids, checks, of, first, count, tag, settled, strings)


def _cut(bucket, ids, checks, of, first, count, tag, settled, strings) -> Iterator[tuple]:
    """(bucket, packed) of super-k-mers, their documents being places in ids and checks. Settled
    ones need neither tag nor string."""
    if not len(bucket):
        return
    diff = lambda a: np.diff(a, prepend=0).astype("<i4")
    order = np.argsort(bucket, kind="stable")
    index = np.zeros(len(ids), np.int64)
    for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        known, new = rows[settled[rows]], rows[~settled[rows]]
        used = np.unique(of[rows])
        index[used] = np.arange(len(used))
        texts = [strings[i] for i in new.tolist()]
        arrays = [
            ids[used].astype("<i8"),
            checks[used].astype("<u4"),
            diff(index[of[new]]),
            diff(first[new]),
            count[new].astype("<i4"),
            tag[new].astype("<u4"),
            np.array([len(t) for t in texts], "<i4"),
            diff(index[of[known]]),
            diff(first[known]),
            count[known].astype("<i4"),
        ]
        yield int(bucket[rows[0]]), _pack(arrays, b"".join(texts))


def _opened(blobs: list[bytes]) -> tuple:
    """Packed pieces, one after the other: ids and checks of documents; of super-k-mers to be
    counted the place of the document, first word, windows, minimiser, begin and length of the
    string; of settled ones place, first word, windows; all strings."""
    docs, new, known, texts, place, at = [], [], [], [], 0, 0
    for blob in blobs:
        (ids, checks, of, first, count, tag, length, k_of, k_first, k_count), text = _unpack(blob)
        docs.append(np.stack([ids, checks]))
        begin = at + np.cumsum(length, dtype=np.int64) - length
        new.append(np.stack([place + np.cumsum(of), np.cumsum(first), count, tag, begin, length]))
        known.append(np.stack([place + np.cumsum(k_of), np.cumsum(k_first), k_count]))
        texts.append(text)
        place, at = place + len(ids), at + len(text)
    return *(np.concatenate(a, axis=1) for a in (docs, new, known)), b"".join(texts)


def _split(blobs: list[bytes], per: int) -> Iterator[tuple]:
    """(place in the group, packed) of pieces of a group of so many buckets. Settled super-k-mers
    have nothing to meet; they go by document."""
    (ids, checks), new, known, text = _opened(blobs)
    of, first, count, tag, begin, length = new
    strings = [text[i : i + n] for i, n in zip(begin.tolist(), length.tolist(), strict=True)]
    bucket = np.concatenate([tag % per, ids[known[0]] % per])
    of, first, count = (np.concatenate(x) for x in zip((of, first, count), known, strict=True))
    settled = np.arange(len(of)) >= len(strings)
    yield from _cut(bucket, ids, checks, of, first, count, tag, settled, strings)


def hot_minimisers(docs: DataFrame, buckets: int, window: int = WINDOW) -> np.ndarray:
    """The minimisers, at most `buckets`, whose super-k-mers are as many bytes as an average
    bucket, of (doc_id, check, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [words(t) for t in batch.column("text").to_pylist()]
            tokens, ends = [t for w in own for t in w], np.cumsum([len(w) for w in own])
            _, start, count, low = super_kmers(tokens, ends.tolist(), window)
            upto = np.cumsum([0] + [len(t) + 1 for t in tokens])
            sizes = upto[start + count + window - 1] - upto[start] if len(low) else start
            names, place = np.unique(low, return_inverse=True)
            sums = np.bincount(place, sizes, len(names)).astype(np.int64)
            lows = pa.array([*names.view(np.int64).tolist(), None], pa.int64())  # null: all of them
            yield pa.RecordBatch.from_arrays([lows, pa.array([*sums, sizes.sum()], pa.int64())], ["low", "size"])

    some = docs.where(F.pmod(F.xxhash64("doc_id", "check"), F.lit(SAMPLE)) == 0).where("doc_id is not null")
    sums = some.mapInArrow(run, "low long, size long").groupBy("low").agg(F.sum("size").alias("size"))
    sums = stored(sums.where((F.col("size") >= LEAST) | F.col("low").isNull()), "minimisers")
    total = sums.where("low is null").agg(F.sum("size")).first()[0] or 0
    rows = sums.where("low is not null").where(F.col("size") * buckets >= total).collect()  # `buckets` at most
    return np.sort(np.array([r["low"] for r in rows], np.int64).view(np.uint64))


def layout(buckets: int) -> tuple[int, int]:
    """Groups, and buckets in each, for so many buckets at least; groups of one need one exchange."""
    if buckets <= FAN:
        return buckets, 1
    per = math.isqrt(buckets - 1) + 1
    return -(-buckets // per), per


def packed(docs: DataFrame, keys: list[int], per: int = 1, window: int = WINDOW, hot: np.ndarray = NO_HOT) -> DataFrame:
    """(bucket, packed) of (doc_id, check, text), for buckets of these names, `per` of which are a
    group. Pieces are of a group, and come to any of its buckets in turn."""
    groups = len(keys) // per

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            rows = list(_buckets_of(held, groups, window, hot))
            names, blobs = [keys[b * per + turn % per] for b, _ in rows], [p for _, p in rows]
            arrays = [pa.array(names, pa.int64()), pa.array(blobs, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["bucket", "packed"])

        for batch in slices(batches):
            for doc_id, check, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if doc_id is None or len(own := words(text)) < window:
                    continue
                held.append((doc_id, check, own))
                size += len(text)
                if size >= PACK:
                    yield flush()
                    held, size, turn = [], 0, turn + 1
        if held:
            yield flush()

    return docs.mapInArrow(run, "bucket long, packed binary")


def by_bucket(rows: DataFrame, keys: list[int], per: int) -> DataFrame:
    """(bucket, packed) of pieces that came together by group, now cut by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_of = {key: i // per for i, key in enumerate(keys)}
        held: dict[int, list[bytes]] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            cut = [(keys[g * per + b], p) for g, blobs in held.items() for b, p in _split(blobs, per)]
            arrays = [pa.array([k for k, _ in cut], pa.int64()), pa.array([p for _, p in cut], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["bucket", "packed"])

        for batch in slices(batches):
            for key, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(group_of[key], []).append(blob)
                size += len(blob)
                if size >= PACK:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    return rows.mapInArrow(run, "bucket long, packed binary")


def repeats(strings: list[bytes], counts: list[int], owners: list[int], window: int) -> list[np.ndarray]:
    """For super-k-mers of one minimiser: which of their windows a smaller owner has as well.
    The windows are sorted as strings, equal ones by owner; the first is the smallest."""
    rows = []
    for i, (s, n, owner) in enumerate(zip(strings, counts, owners, strict=True)):
        tokens = s.split(b" ")
        rows += [(b" ".join(tokens[k : k + window]), owner, i, k) for k in range(n)]
    rows.sort()
    found = [np.zeros(n, bool) for n in counts]
    text, smallest = None, None
    for s, owner, i, k in rows:
        if s != text:
            text, smallest = s, owner
        elif owner > smallest:
            found[i][k] = True
    return found


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and length of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    yield from zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True)


def _count(blobs: list[bytes], window: int) -> tuple[np.ndarray, list[tuple]]:
    """Repeated windows of one bucket as (doc_id, check, first word, windows): the settled ones as
    arrays, the counted ones as tuples."""
    (ids, checks), new, known, text = _opened(blobs)
    of, first, count, tag, begin, length = new
    doc, check, found = ids[of], checks[of], []
    known = np.stack([ids[known[0]], checks[known[0]], *known[1:]])
    order = np.lexsort((doc, tag))
    edges = np.flatnonzero(np.diff(tag[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        rows = order[a:b]
        if b - a < 2 or doc[rows[0]] == doc[rows[-1]]:
            continue  # one document alone
        where = zip(begin[rows].tolist(), length[rows].tolist(), strict=True)
        strings = [text[i : i + n] for i, n in where]
        flags = repeats(strings, count[rows].tolist(), doc[rows].tolist(), window)
        for r, flag in zip(rows.tolist(), flags, strict=True):
            if flag.any():
                found += [(doc[r], check[r], first[r] + i, n) for i, n in _runs(flag)]
    return known, found


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, check and (start, stop) words covered by windows that a smaller doc_id has, of
    (doc_id, check, text)."""
    names = ["doc_id", "check", "start", "stop"]

    def run(table: pa.Table) -> pa.Table:
        known, found = _count(table.column("packed").to_pylist(), window)
        both = np.concatenate([known, np.array(found, np.int64).reshape(-1, 4).T], axis=1)
        columns = [both[0], both[1], both[2], both[2] + both[3] + window - 1]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names)

    groups, per = layout(parts(docs))
    n = groups * per
    hot, keys = hot_minimisers(docs, n, window), even_keys(docs.sparkSession, n)
    rows = packed(docs, keys, per, window, hot).repartition(n, "bucket")
    if per > 1:
        rows = by_bucket(rows, keys, per).repartition(n, "bucket")
    return rows.groupBy("bucket").applyInArrow(run, ", ".join(f"`{n}` long" for n in names))


def _compressed(docs: DataFrame) -> DataFrame:
    """The rows with `#text`, the compressed text, for the exchange that brings text and findings
    together."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shrink = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            blobs = pa.array([None if t is None else shrink(t.encode()) for t in texts], pa.binary())
            own = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*own, blobs], [*others, "#text"])

    rows = docs.withColumn("text", F.col("text").cast("string"))
    return rows.mapInArrow(run, with_fields(docs.select(*others), "`#text` binary"))


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs with n_words, n_removed and kept_text, the words left, parted by blanks.

    A word goes if a window that covers it has words that also start in a document of smaller
    doc_id. All windows are judged on the input. A null text has no words; texts shorter than a
    window, and rows of null doc_id, neither lose words nor take any from others. Rows that
    repeat a doc_id are one document: they take nothing from each other, whether their texts
    agree or not. Columns of docs stay, but those named like a new one are replaced.
    """
    mine = ("n_words", "n_removed", "kept_text")
    columns = [c for c in docs.columns if c.lower() not in mine]
    check = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = _compressed(whole_texts(docs).select(*columns, check.alias("#check")))
    found = repeated_windows(
        docs.select(F.col("doc_id").cast("long"), check.alias("check"), F.col("text").cast("string")), window
    )
    spans = found.groupBy("doc_id", "check").agg(F.collect_list(F.struct("start", "stop")).alias("#spans"))
    spans = spans.withColumnsRenamed({"doc_id": "#doc", "check": "#of"})
    on = (rows["doc_id"].cast("long") == spans["#doc"]) & (rows["#check"] == spans["#of"])
    joined = rows.join(spans, on, "left").select(*rows.columns, "#spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches):
            n_words, n_removed, texts, kept = [], [], [], []
            for blob, spans in zip(
                batch.column("#text").to_pylist(), batch.column("#spans").to_pylist(), strict=True
            ):
                texts.append(None if blob is None else expand(blob).decode())
                tokens = words(texts[-1])
                n = len(tokens)
                if spans:
                    gone = np.zeros(n, bool)
                    for s in spans:
                        gone[s["start"] : s["stop"]] = True
                    tokens = [tokens[i] for i in np.flatnonzero(~gone).tolist()]
                n_words.append(n)
                n_removed.append(n - len(tokens))
                kept.append(b" ".join(tokens).decode())
            new = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            text = pa.array(texts, pa.string())
            own = [text if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*own, *new], [*columns, *mine])

    more = "n_words long, n_removed long, kept_text string"
    return joined.mapInArrow(run, with_fields(docs.withColumn("text", F.col("text").cast("string")).select(*columns), more))
