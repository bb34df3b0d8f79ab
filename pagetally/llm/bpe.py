"""Byte-level BPE: a sentencepiece model made straight from a rank vocabulary.

Every token of the vocabulary becomes a piece, its bytes written as printable characters, with
the negative rank as its score: the model then merges the pair of lowest rank first, as the
vocabulary wants it. Normalisation is the identity. Texts are split by a pattern; each match is
encoded by itself and decoded by the inverse of the byte mapping.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetally.llm.common import slices, whole_texts, with_fields

#: Pre-tokens whose ids a task remembers. A bound of memory only: others are encoded again.
CACHE = 100_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with one base64 token and its rank per line."""
    with open(path, "rb") as file:
        rows = [line.split() for line in file if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in rows}


def byte_alphabet() -> list[str]:
    """A printable character for every byte: its own where Latin-1 prints it, else one above
    U+00FF, in the order of the bytes."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    score_field = _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _block(1, _block(1, text.encode()) + score_field + _number(3, kind))


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model file of the vocabulary; a piece's id is its rank.

    Ranks must be 0, 1, ... without gaps and cover all single bytes; the unknown piece that the
    format demands comes last and is never produced.
    """
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    if not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("every single byte must have a rank")
    # Fixed values of the format: piece kinds 1 normal and 2 unknown; model type 2 is BPE;
    # trainer fields 3 type, 4 size, 40-43 unknown, begin, end and padding ids;
    # normaliser fields 1 name, 3 dummy prefix, 4 extra blanks, 5 escaped blanks.
    alphabet, none = byte_alphabet(), (1 << 64) - 1
    pieces = [_piece("".join(alphabet[b] for b in t), -float(ranks[t]), 1) for t in tokens]
    pieces.append(_piece("<unk>", 0.0, 2))
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, len(tokens))
    trainer += b"".join(_number(field, none) for field in (41, 42, 43))
    normaliser = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + _block(2, trainer) + _block(3, normaliser)


class ByteBpe:
    """Encoder and decoder over one model."""

    def __init__(self, model: bytes, pattern: str, cache: int = CACHE):
        import regex
        import sentencepiece

        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = byte_alphabet()
        self.to_chars = dict(enumerate(alphabet))
        to_byte = {c: b for b, c in enumerate(alphabet)}
        size = self.model.get_piece_size() - 1
        self.bytes_of = [bytes(map(to_byte.get, self.model.id_to_piece(i))) for i in range(size)]
        self.ids: dict[str, bytes] = {}
        self.cache = cache

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed as little-endian unsigned 32-bit integers."""
        tokens, ids = self.split(text), self.ids
        if new := [t for t in dict.fromkeys(tokens) if t not in ids]:
            if len(ids) + len(new) > self.cache:
                ids = self.ids = {}
                new = list(dict.fromkeys(tokens))
            # The bytes, as the characters of their codes, become the model's alphabet.
            mapped = [t.encode().decode("latin-1").translate(self.to_chars) for t in new]
            for token, found in zip(new, self.model.encode(mapped, num_threads=1), strict=True):
                ids[token] = struct.pack(f"<{len(found)}I", *found)
        return b"".join(map(ids.__getitem__, tokens))

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the packed ids stand for, in order."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _coder(spark, vocabulary: str, pattern: str):
    """A function that makes the coder in a task. The model, as large as the vocabulary, is
    broadcast; executors need not see the file."""
    model = spark.sparkContext.broadcast(serialise_model(load_ranks(vocabulary)))
    return lambda: ByteBpe(model.value, pattern)


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, keep: tuple[str, ...] = (), back: bool = False
) -> DataFrame:
    """Encode every text: doc_id, columns named in `keep`, n_tokens, ids, and with `back` what
    the ids decode to, as `decoded`, by the same coder in the same task.

    `ids` packs the ids as little-endian unsigned 32-bit integers. A null text is empty: no ids.
    Rows are independent: repeated rows and null ids stay as they are, other columns are not
    read. A text is encoded whole, whatever its length.
    """
    make, kept = _coder(docs.sparkSession, vocabulary, pattern), ("doc_id", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in slices(batches):
            packed = [coder.encode(t or "") for t in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in kept]
            counts = pa.array([len(p) // 4 for p in packed], pa.int64())
            columns += [counts, pa.array(packed, pa.binary())]
            if back:
                columns.append(pa.array(map(coder.decode, packed), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = whole_texts(docs).select(*kept, F.col("text").cast("string").alias("text"))
    more = "n_tokens long, ids binary" + ", decoded binary" * back
    schema = with_fields(rows.select(*kept), more)
    names = schema.fieldNames()
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The encoded rows with `decoded`, the bytes of their ids. Null ids decode to no bytes."""
    make, names = _coder(encoded.sparkSession, vocabulary, pattern), encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = make()
        for batch in slices(batches):
            ids = batch.column("ids").to_pylist()
            decoded = pa.array([coder.decode(i or b"") for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*names, "decoded"])

    return encoded.mapInArrow(run, with_fields(encoded, "decoded binary"))


def with_digests(decoded: DataFrame) -> DataFrame:
    """The rows with digests of both directions: ids_sha256 and decoded_sha256."""
    return decoded.withColumns(
        {"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}
    )
