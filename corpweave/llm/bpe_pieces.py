"""Byte-level BPE through a sentencepiece model that is written straight from a rank vocabulary.

Every byte is mapped to one character, so a token is a string of such characters; the model holds one piece per
token whose score is its negative rank, so the best-scored merge is the merge of lowest rank, leftmost first. The
normaliser is the identity and nothing is added or removed. Text is split by the vocabulary's pattern and each
match is encoded by itself; a match that is a token by itself takes that token's id, as rank encoders do. Decoding
looks every id up in the inverse table and joins the bytes.

Bounds: the vocabulary (some ten thousand pieces) travels in the task's closure as its rank file; a worker keeps
at most ``CACHE`` distinct matches, then starts over. Nothing is shuffled: texts are mapped where they are read.

Cases: null text counts as empty and has no ids; repeated rows and ids are encoded row by row; any text without
lone surrogates decodes to its UTF-8 bytes exactly; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from corpweave.llm.common import arrow_map, arrow_schema, text_or_empty, to_batch

#: Bytes become the 256 characters from here on; the range holds no white space and nothing sentencepiece treats apart.
FIRST = 0x0100
#: Distinct matches whose ids a worker remembers.
CACHE = 400_000
NORMAL, UNKNOWN = 1, 2
BPE = 2


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 token, blank, rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: an integer, a 32-bit float or bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def mapped(data: bytes) -> str:
    """The characters that stand for bytes."""
    return data.decode("latin-1").translate(_UP)


_UP = {b: FIRST + b for b in range(256)}


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model: piece 0 is unknown, piece i + 1 is the i-th token by rank, scored by minus its rank."""
    unknown = _field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN)
    pieces = [unknown]
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        pieces.append(_field(1, mapped(token).encode()) + _field(2, float(-rank)) + _field(3, NORMAL))
    trainer = _field(3, BPE) + _field(4, len(pieces)) + _field(40, 0) + b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes and decodes with the model of one vocabulary."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.ranks = read_ranks(rank_file)
        self.pattern = regex.compile(pattern)
        self.by_piece = [rank for _, rank in sorted((r, r) for r in self.ranks.values())]
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.ranks))
        self.known: dict[str, bytes] = {}

    def encode_match(self, match: str) -> bytes:
        """Ids of one match as little-endian unsigned 32-bit integers."""
        data = match.encode()
        rank = self.ranks.get(data)
        if rank is not None:
            return struct.pack("<I", rank)
        ids = [self.by_piece[piece - 1] for piece in self.model.encode(mapped(data))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        matches = self.pattern.findall(text)
        known = self.known
        for match in set(matches).difference(known):
            if len(known) >= CACHE:
                # start over with what this text needs
                known.clear()
                known.update((m, self.encode_match(m)) for m in set(matches))
                break
            known[match] = self.encode_match(match)
        return b"".join(map(known.__getitem__, matches))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I").tolist()))


@lru_cache(maxsize=2)
def codec(rank_file: bytes, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(rank_file, pattern)


def encode_texts(df: DataFrame, rank_file: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the ids of every text, as bytes of little-endian unsigned 32-bit integers."""
    schema = arrow_schema("doc_id:int64 ids:binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(rank_file, pattern)
        for batch in batches:
            rows = [(i, coder.encode(t)) for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield to_batch(rows, schema)

    return arrow_map(_input(df, key, text), run, "doc_id:int64 ids:binary").withColumnRenamed("doc_id", key)


def decode_ids(df: DataFrame, rank_file: bytes, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the bytes that the ids stand for; null ids count as none."""
    schema = arrow_schema("doc_id:int64 decoded:binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(rank_file, pattern)
        for batch in batches:
            rows = [(i, coder.decode(b or b"")) for i, b in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield to_batch(rows, schema)

    return arrow_map(df.select(key, ids), run, "doc_id:int64 decoded:binary").withColumnRenamed("doc_id", key)


def round_trip_digests(df: DataFrame, rank_file: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number and digest of every text's ids, and the digest of what they decode to; one pass, only digests leave it."""
    fields = "doc_id:int64 n_tokens:int64 ids_sha256:string decoded_sha256:string"
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(rank_file, pattern)
        for batch in batches:
            rows = []
            for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = coder.encode(t)
                decoded = coder.decode(ids)
                rows.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            yield to_batch(rows, schema)

    return arrow_map(_input(df, key, text), run, fields).withColumnRenamed("doc_id", key)


def _input(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(df[key].cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
