"""Phrases whose words come together more often than apart, by top-order marginalisation.

Only the longest windows are counted: every word with the words that follow it in its piece, as
lead columns, padded with nulls where the piece ends. A shorter phrase is a prefix of the windows
that begin where it does, so ROLLUP sums over the counted windows give the counts of all shorter
phrases, of all words, and the total; shorter n-grams are never generated.

Most windows hold a pair of neighbours that is too rare to be in any candidate, or in any part of
one. A first pass counts hashes of pairs, and windows are padded from such a pair on: they then
fall together with others, long before they are sent. Pairs of one hash are counted together, so a
frequent pair is never taken for a rare one, and all counts that are used are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetally.llm.common import slices, stored, whole_texts

#: A-Z in lower case; a full stop for every character that ends a piece; a blank for a tab.
UPPER, ENDS = bytes(range(65, 91)), b".,;:!?\n\v\f\r"
PLAIN = bytes.maketrans(UPPER + ENDS + b"\t", UPPER.lower() + b"." * len(ENDS) + b" ")
#: Bytes of text whose windows a task counts before it sends them; cut at the end of a piece.
CHUNK = 8 << 20
#: Bits for each frequent pair in the table of their hashes, and the most that it has (32 MB).
#: Beyond that more rare pairs stay in, and the counts are the same.
BITS, MOST = 16, 1 << 28
BITMAP = 1 << 15  # bits of one aggregate
#: A part of more than one in so many cuts is hot; there are fewer of these than that.
HOT = 1024
#: Tasks that share the cuts of a hot part, or the candidates of a language.
SPREAD = 64


@dataclass(frozen=True)
class Rules:
    """longest: words of a phrase. least: occurrences of a candidate. inside: percentage of a
    phrase's occurrences in one longer candidate at which it goes. top: phrases of a language."""

    longest: int = 3
    least: int = 10
    inside: int = 50
    top: int = 2000

    def __post_init__(self):
        if self.longest < 2 or self.least < 1 or self.top < 1:
            raise ValueError("a phrase has two words at least; least and top are positive")


def _names(n: int) -> list[str]:
    return [f"w{i}" for i in range(1, n + 1)]


class _Ids(dict):
    """Numbers of words, in order of their first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """(lang, numbers, words) of pieces of one language; number 0 is the end of a piece."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def numbered(lang: str) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
        text, begin = b".".join(held.pop(lang)), 0
        del sizes[lang]
        while begin < len(text):
            end = text.find(b".", begin + size)
            end = len(text) if end < 0 else end
            ids = _Ids({b".": 0})
            tokens = text[begin:end].replace(b".", b" . ").split()
            yield lang, np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens)), list(ids)
            begin = end

    for batch in slices(batches):
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text:
                lang = "und" if lang is None else lang
                held.setdefault(lang, []).append(text.encode().translate(PLAIN))
                sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
                if sizes[lang] >= size:
                    yield from numbered(lang)
    for lang in list(held):
        yield from numbered(lang)


def _pairs(lang: str, ids: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Whether a word and the next one are in one piece, and a hash of both."""
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode())
    hashes = np.fromiter((xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))[ids]
    mixed = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (ids[:-1] > 0) & (ids[1:] > 0), mixed ^ (mixed >> np.uint64(29))


def _texts(docs: DataFrame) -> DataFrame:
    return whole_texts(docs).select(F.col("lang").cast("string"), F.col("text").cast("string"))


def frequent_pairs(docs: DataFrame, least: int) -> np.ndarray:
    """Bits by hash, a power of two of them: set for every pair with `least` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words in _chunks(batches):
            both, hashes = _pairs(lang, ids, words)
            names, n = np.unique(hashes[both], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], ["hash", "n"])

    found = _texts(docs).mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    found = stored(found.where(F.col("n") >= least).select("hash"), "frequent_pairs")
    bits = max(BITMAP, min(MOST, 1 << math.ceil(math.log2(BITS * found.count() + 1))))
    at = F.col("hash").bitwiseAND(bits - 1)
    place = F.shiftright(at, BITMAP.bit_length() - 1).alias("place")
    some = F.bitmap_construct_agg(at.bitwiseAND(BITMAP - 1)).alias("bits")
    table = np.zeros(bits // 8, np.uint8)
    for row in found.groupBy(place).agg(some).collect():  # MOST bits at most
        table[row.place * BITMAP // 8 : (row.place + 1) * BITMAP // 8] = np.frombuffer(row.bits, np.uint8)
    return table


def windows(docs: DataFrame, longest: int, frequent: np.ndarray) -> DataFrame:
    """lang, w1 to w<longest>, n: how often each padded window begins at a word."""
    names = _names(longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(8 * len(frequent) - 1)
        for lang, ids, words in _chunks(batches):
            both, hashes = _pairs(lang, ids, words)
            at = hashes & mask
            on = both & (frequent[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            on = np.append(on, np.zeros(longest, bool))  # pairs that begin at each word
            texts = pa.array([w.decode() for w in words], pa.string())
            begin = np.flatnonzero(ids > 0)
            for length in range(1, longest + 1):
                more = on[begin + length - 1] if length < longest else np.zeros(len(begin), bool)
                ends, begin = begin[~more], begin[more]
                # Windows of this length as numbers, word by word.
                key, first = np.zeros(len(ends), np.int64), np.zeros(0, np.int64)
                for i in range(length):
                    _, first, key, n = np.unique(key * len(words) + ids[ends + i], True, True, True)
                if not len(first):
                    continue
                columns = [texts.take(pa.array(ids[ends[first] + i])) for i in range(length)]
                columns += [pa.nulls(len(first), pa.string())] * (longest - length)
                langs = pa.array([lang] * len(first), pa.string())
                yield pa.RecordBatch.from_arrays([langs, *columns, pa.array(n, pa.int64())], ["lang", *names, "n"])

    schema = ", ".join(f"{c} string" for c in ["lang", *names])
    return _texts(docs).mapInArrow(run, f"{schema}, n long").groupBy("lang", *names).agg(F.sum("n").alias("n"))


def counts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """lang, size, phrase, n of the phrases of 1 to `longest` words with `least` occurrences, and
    a row of size 0 with the number of words of each language."""
    names = _names(rules.longest)
    prefix = names[:-1]
    top = stored(windows(docs, rules.longest, frequent_pairs(docs, rules.least)), "windows")
    longest = top.where(F.col(names[-1]).isNotNull()).withColumn("size", F.lit(rules.longest))
    summed = top.rollup("lang", *prefix).agg(F.sum("n").alias("n"), F.grouping_id().alias("out"))
    # Columns that are summed out are null, and so are those beyond the end of a piece: there a
    # prefix is a shorter phrase, which the next level has in full.
    size = F.lit(len(prefix)) - F.bit_count("out")
    filled = sum((F.col(w).isNotNull().cast("int") for w in prefix), F.lit(0))
    shorter = summed.withColumn("size", size).where((F.col("size") >= 0) & (filled == F.col("size")))
    both = longest.unionByName(shorter.drop("out"), allowMissingColumns=True)
    frequent = both.where((F.col("n") >= rules.least) | (F.col("size") == 0))
    return frequent.select("lang", "size", F.concat_ws(" ", *names).alias("phrase"), "n")


def _with_count(cuts: DataFrame, part: str, count: str, counted: DataFrame) -> DataFrame:
    """The cuts with the count of one of their parts. A stop word is part of very many cuts: those
    of a hot part are dealt to several tasks, each of which gets its count."""
    n = cuts.count()
    of = cuts.groupBy("lang", F.col(part).alias("phrase")).count()
    hot = of.where(F.col("count") * HOT > n).select("lang", "phrase", F.lit(SPREAD).alias("spread"))
    hot = F.broadcast(stored(hot, "hot_parts"))  # fewer than HOT rows
    deal = F.pmod(F.xxhash64("phrase", "k"), F.coalesce("spread", F.lit(1))).alias("#deal")
    mine = cuts.join(hot.withColumnRenamed("phrase", part), ["lang", part], "left").select(*cuts.columns, deal)
    last = F.coalesce("spread", F.lit(1)).cast("long") - 1
    every = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("#deal")
    dealt = counted.where("size > 0").join(hot, ["lang", "phrase"], "left")
    named = dealt.select("lang", F.col("phrase").alias(part), F.col("n").alias(count), every)
    return mine.join(named, ["lang", part, "#deal"]).drop("#deal")


def candidates(counted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that stay, from the table of counts."""
    split, a = F.split("phrase", " "), F.col("n").alias("a")
    phrases = counted.where("size > 1").select("lang", "size", "phrase", a, split.alias("w"))
    cut = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    left = F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left")
    right = F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("right")
    cuts = stored(cut.select("lang", "phrase", "a", "k", left, right), "cuts")
    parts = _with_count(_with_count(cuts, "left", "l", counted), "right", "r", counted)
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    score = F.expr("cast(1000000 * (wa * wa) div (wl * wr) as bigint)")
    wides = {f"w{c}": v for c, v in wide.items()}
    best = F.struct(score.alias("score"), "k", "l", "r").alias("cut")
    scored = parts.withColumns(wides).select("lang", "phrase", "a", best, F.lit(None).cast("long").alias("longer"))
    # The contiguous parts of two words and more of every candidate, with its count.
    spans = [(size, at, n) for size in range(3, rules.longest + 1) for n in range(2, size) for at in range(1, size - n + 2)]
    found = [
        phrases.where(F.col("size") == size).select("lang", F.array_join(F.slice("w", at, n), " ").alias("phrase"), F.col("a").alias("longer"))
        for size, at, n in spans
    ]
    for part in found:
        scored = scored.unionByName(part, allowMissingColumns=True)
    judged = scored.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min("cut").alias("cut"), F.max("longer").alias("longer")
    )
    stay = F.col("longer").isNull() | (100 * F.col("longer") < rules.inside * F.col("a"))
    return judged.where(F.col("a").isNotNull() & stay).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `top` phrases of every language.

    Texts are lower-cased in A-Z, cut into pieces at `.,;:!?` and line ends, and pieces into words
    at blanks and tabs. `a` is how often a phrase occurs, overlaps included, `l` and `r` how often
    the parts of its weakest cut do, `n` the words of the language. Scores are whole numbers from
    exact products. Phrases with `inside` per cent of their occurrences in one longer candidate
    go. Equal scores are in order of `a`, then of the phrase's bytes.

    A null language counts as `und`; null, empty and blank texts have no words, and a language
    without candidates has no rows. Rows that repeat count each time. A text may be as long as a
    row can be. Columns besides `text` and `lang` are not read.
    """
    counted = stored(counts(docs, rules), "phrase_counts")
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    rows = candidates(counted, rules).withColumn("#deal", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    for groups in (("lang", "#deal"), ("lang",)):  # first in parts, so that no task ranks a language
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("long")
        rows = rows.withColumn("rank", place).where(F.col("rank") <= rules.top)
    words = counted.where("size = 0").select("lang", "n")
    return rows.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
