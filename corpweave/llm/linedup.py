"""Line dedup: a sharded minimal perfect hash over the distinct line hashes, probed by the documents.

A line's key is the line without the six ASCII white-space characters at its ends, A-Z in lower case. Keys of at least
``LEAST_CHARS`` code points found in at least ``LEAST_DOCS`` documents lose all their lines except those of the
largest document id holding the key.

1. Documents emit the 128-bit hashes of their long enough keys, once per document.
2. Hashes are counted (partial aggregation first, so a line of every document is no hot key) and dealt to shards of
   about ``SHARD`` hashes by their high half. Each shard builds a minimal perfect hash: bit arrays of several levels,
   in which a hash owns the first bit that no other hash of its level hits, and the rank of that bit is its slot.
   Slots index compact arrays: a 32-bit fingerprint, the number of documents, the document that keeps the line.
3. Documents probe the arrays: the hashes of a shard meet its index in one task, hot shards in several, each with a
   salted share of the hashes and a copy of the index. Only lines to drop come back, as hashes by document.
4. Texts are rewritten where they are read, with the hashes to drop at hand. Lines are never joined.

Bounds: a shard's index has about 20 bytes per hash, a probing task ``PROBES`` hashes of 24 bytes.

Cases: null and empty texts are one empty line, which is never dropped; a null id counts as one document below all
others; rows of one id are one document, and all of them keep or lose the key's lines; repeated lines inside a
document go or stay together; ids may be any bigint; very long texts are taken whole; an empty table gives no rows; other
columns pass through ``drop_lines`` untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import arrow_map, arrow_schema, meet, stored, to_batch, unused

LEAST_CHARS, LEAST_DOCS = 40, 5
SHARD, PROBES = 8_192, 65_536
#: Bits per hash in a level, and the levels before what is left is looked up in a sorted list.
ROOM, LEVELS = 2, 24


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def long_enough(key: bytes) -> bool:
    return len(key) >= LEAST_CHARS and len(key.decode()) >= LEAST_CHARS


def key_hash(key: bytes) -> tuple[int, int]:
    """The 128-bit hash of a key as two signed 64-bit integers."""
    digest = xxhash.xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def long_keys(text: str | None) -> list[tuple[bytes, bytes]]:
    """(line, key) of the lines whose keys are long enough, in order."""
    return [(line, key) for line in (text or "").encode().split(b"\n") if long_enough(key := line_key(line))]


class PerfectHash:
    """A minimal perfect hash over distinct (high, low) hashes; slots run from 0 to their number less one."""

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray) -> None:
        self.bits, self.rest = bits, rest
        self.ranks = [np.r_[0, np.cumsum(level)] for level in bits]
        self.before = np.r_[0, np.cumsum([level.sum() for level in bits])].astype(np.int64)

    @staticmethod
    def places(values: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = values ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @staticmethod
    def folded(high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """One 64-bit value per hash; distinct hashes that fold alike end in the list of the rest."""
        return high.view(np.uint64) * np.uint64(0x9E3779B185EBCA87) ^ low.view(np.uint64)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        left, bits = np.arange(len(high)), []
        values = cls.folded(high, low)
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, ROOM * len(left))
            at = cls.places(values[left], level, size)
            hits = np.bincount(at, minlength=size)
            bits.append(hits == 1)
            left = left[hits[at] > 1]
        rest = np.array(sorted(zip(high[left].tolist(), low[left].tolist(), strict=True)), np.int64).reshape(-1, 2)
        return cls(bits, rest)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slots of hashes; one that was not built in may get any slot or -1."""
        values, out = self.folded(high, low), np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, bits in enumerate(self.bits):
            at = self.places(values[left], level, len(bits))
            own = bits[at]
            out[left[own]] = self.before[level] + self.ranks[level][at[own]]
            left = left[~own]
        if len(left) and len(self.rest):
            where = {tuple(pair): i for i, pair in enumerate(self.rest.tolist())}
            for i in left.tolist():
                at = where.get((int(high[i]), int(low[i])), -1)
                out[i] = -1 if at < 0 else self.before[-1] + at
        return out

    def dump(self) -> tuple[bytes, list[int], bytes]:
        """Packed bits of all levels, their sizes, and the rest."""
        return b"".join(np.packbits(b).tobytes() for b in self.bits), [len(b) for b in self.bits], self.rest.tobytes()

    @classmethod
    def load(cls, packed: bytes, sizes: list[int], rest: bytes) -> PerfectHash:
        bits, at = [], 0
        for size in sizes:
            width = (size + 7) // 8
            bits.append(np.unpackbits(np.frombuffer(packed, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(bits, np.frombuffer(rest, np.int64).reshape(-1, 2))


def split_nulls(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the integers are null, and their values with 0 for null."""
    return column.is_null().to_numpy(), column.fill_null(0).to_numpy()


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, high, low) of the long enough line keys of every whole text, once per row."""
    schema = arrow_schema("doc_id:int64 high:int64 low:int64")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(i, *key_hash(key)) for key in {key for _, key in long_keys(text)}]
            yield to_batch(rows, schema)

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return arrow_map(given, run, "doc_id:int64 high:int64 low:int64")


INDEX = "shard:int32 bits:binary sizes:longs rest:binary prints:binary counts:binary keepers:binary nameless:binary"


def build_index(hashes: DataFrame) -> tuple[DataFrame, int]:
    """The index and its number of shards. One row per shard: its perfect hash and the arrays that its slots index."""
    counted = hashes.groupBy("high", "low").agg(
        (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("docs"), F.max("doc_id").alias("keeper")
    )
    counted = stored(counted, "line-counts")
    shards = max(1, -(-counted.count() // SHARD))
    schema = arrow_schema(INDEX)

    def build(group: pa.Table) -> pa.Table:
        high, low, docs, shard = (group.column(c).to_numpy() for c in ("high", "low", "docs", "shard"))
        nameless, keeper = split_nulls(group.column("keeper"))
        table = PerfectHash.build(high, low)
        order = np.argsort(table.slots(high, low))
        arrays = (low.astype(np.uint32)[order], np.minimum(docs, 0xFFFFFFFF).astype(np.uint32)[order], keeper[order], nameless[order])
        row = (int(shard[0]), *table.dump(), *(a.tobytes() for a in arrays))
        return pa.Table.from_batches([to_batch([row], schema)])

    dealt = counted.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))
    columns = "shard int, bits binary, sizes array<bigint>, rest binary, prints binary, counts binary, "
    columns += "keepers binary, nameless binary"
    return stored(dealt.groupBy("shard").applyInArrow(build, columns), "line-index"), shards


def probe(hashes: DataFrame, index: DataFrame, shards: int, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, high, low) of the lines to drop: keys in enough documents, where another document keeps them."""
    asked = hashes.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))
    schema = arrow_schema("doc_id:int64 high:int64 low:int64")

    def look_up(lines: pa.Table, tables: pa.Table) -> pa.Table:
        if not len(lines) or not len(tables):
            return schema.empty_table()
        row = tables.slice(0, 1).to_pylist()[0]
        table = PerfectHash.load(row["bits"], row["sizes"], row["rest"])
        prints, counts = (np.frombuffer(row[c], np.uint32) for c in ("prints", "counts"))
        keepers, nobody = np.frombuffer(row["keepers"], np.int64), np.frombuffer(row["nameless"], bool)
        high, low = (lines.column(c).to_numpy() for c in ("high", "low"))
        nameless, doc = split_nulls(lines.column("doc_id"))
        slot = table.slots(high, low)
        other = (keepers[slot] != doc) | (nobody[slot] != nameless)
        drop = (slot >= 0) & (prints[slot] == low.astype(np.uint32)) & (counts[slot] >= least_docs) & other
        return pa.table([pa.array(doc[drop], mask=nameless[drop]), pa.array(high[drop]), pa.array(low[drop])], schema=schema)

    return meet(asked, index, "shard", look_up, "doc_id bigint, high bigint, low bigint", PROBES)


def lines_to_drop(docs: DataFrame) -> DataFrame:
    """(doc_id, drop): per document that loses lines, the hashes of their keys."""
    hashes = stored(line_hashes(docs), "line-hashes")
    dropped = probe(hashes, *build_index(hashes))
    return dropped.groupBy("doc_id").agg(F.collect_set(F.concat_ws(":", "high", "low")).alias("drop"))


def kept_lines(text: str | None, drop: list | None) -> tuple[int, int, str]:
    """Number of lines, number dropped, and the other lines joined."""
    lines = (text or "").encode().split(b"\n")
    if not drop:
        return len(lines), 0, text or ""
    gone = set(drop)
    kept = [x for x in lines if not (long_enough(key := line_key(x)) and "%d:%d" % key_hash(key) in gone)]
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


def with_drops(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and a column of the hashes to drop; its name."""
    drop, of = unused("drop", docs.columns), unused("drop_of", docs.columns)
    to_drop = lines_to_drop(docs).select(F.col("doc_id").alias(of), F.col("drop").alias(drop))
    return docs.join(to_drop, F.col("doc_id").cast("bigint").eqNullSafe(F.col(of)), "left").drop(of), drop


def line_digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and the digest of the kept text."""
    fields = "doc_id:int64 n_lines:int64 n_dropped:int64 kept_sha256:string"
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, drop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, gone, kept = kept_lines(text, drop)
                rows.append((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()))
            yield to_batch(rows, schema)

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked, drop = with_drops(own)
    return arrow_map(marked.select("doc_id", "text", drop), run, fields)


def drop_lines(docs: DataFrame) -> DataFrame:
    """The same rows and columns, with the repeated lines gone from ``text``; null stays null."""

    @F.pandas_udf("string")
    def rewrite(texts, drops):  # noqa: ANN001, ANN202
        return texts.combine(drops, lambda t, d: t if t is None else kept_lines(t, None if d is None else list(d))[2])

    marked, drop = with_drops(docs)
    return marked.withColumn("text", rewrite("text", drop)).select(*(F.col(f"`{c}`") for c in docs.columns))
