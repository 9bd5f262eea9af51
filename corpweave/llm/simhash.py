"""SimHash near-duplicates by a grid range-join over segment bit counts.

Fingerprints are 64-bit SimHashes of the texts' word shingles. A fingerprint is embedded as the bit counts of its 32
two-bit segments, so the Manhattan distance of two embeddings never exceeds the Hamming distance of the fingerprints.
With at most ``distance`` differing bits, a Manhattan ball of that radius is all that must be searched: the segments
are dealt into ``BLOCKS`` blocks, at most ``distance`` of which can differ at all, so two linked fingerprints fall in
the same unit cell of at least one projection on ``BLOCKS - distance`` blocks. The range join is therefore an
equi-join on (projection, cell), followed by the Manhattan bound and then by the exact Hamming distance.

Only distinct fingerprints are joined, and documents' ids are looked up at the end. Fingerprints of a cell meet in a task that
compares them in blocks and hands on no pairs but a spanning forest of the links it found; cells beyond ``CELL`` rows
are cut into chunks, and every two chunks meet in a unit of their own. Components come from join rounds.

Bounds: 20 rows of 24 bytes per distinct fingerprint are shuffled; a task holds ``CELL`` rows of a unit and one batch.
A cell of m distinct fingerprints costs m * m / 2 comparisons, spread over its units.

Cases: texts without words (null or empty too) have fingerprint zero and are linked like any other; repeated rows
share their component; rows with null ids take part, and the smallest id that is not null names the component (null
where there is none); ids may be any bigint; an empty table gives no rows; columns besides the two named are ignored by
``near_duplicates`` and pass through ``one_of_each``, whatever their names; very long texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import arrow_map, arrow_schema, stored, text_or_empty, unused
from corpweave.llm.components import components

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Segments of two bits in blocks; every choice of three blocks is a projection.
BLOCKS = ((0, 6), (6, 12), (12, 17), (17, 22), (22, 27), (27, 32))
#: Most rows of a cell that are compared as one unit; units up to SMALL are compared by shifting.
CELL, SMALL = 4096, 24
LOW = np.uint64(0x5555555555555555)
ONE = np.uint64(1)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned integer: bits set in over half of its shingles' XXH64 values."""
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in map(b" ".join, grams)), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def segment_counts(prints: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, one row per fingerprint."""
    low, high = prints & LOW, (prints >> ONE) & LOW
    shifts = np.arange(0, 64, 2, dtype=np.uint64)
    return (((low[:, None] >> shifts) & ONE) + ((high[:, None] >> shifts) & ONE)).astype(np.int64)


def steps_code(prints: np.ndarray) -> np.ndarray:
    """The counts written as steps (0: 00, 1: 01, 2: 11), so that differing bits number the Manhattan distance."""
    low, high = prints & LOW, (prints >> ONE) & LOW
    return (low | high) | ((low & high) << ONE)


def cells(prints: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """The cell of each fingerprint in each projection, as one integer that also tells the projection."""
    counts = segment_counts(prints)
    codes = np.stack([counts[:, a:b] @ 3 ** np.arange(b - a) for a, b in BLOCKS], axis=1)
    out = []
    for number, chosen in enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - distance)):
        code = np.full(len(prints), number, np.int64)
        for block in chosen:
            code = code * 729 + codes[:, block]
        out.append(code)
    return np.stack(out, axis=1)


def text_digest(text: str = "text") -> Column:
    return F.xxhash64(text_or_empty(text))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, print, digest): the fingerprint of every whole text as a signed 64-bit integer, and the text's XXH64."""
    schema = arrow_schema("doc_id:int64 print:int64 digest:int64")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)], schema=schema)

    given = docs.select(docs[key].cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"), text_digest(text).alias("digest"))
    return arrow_map(given, run, "doc_id:int64 print:int64 digest:int64")


def links_in(units: np.ndarray, sides: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked rows: same unit, sides that meet, and at most ``distance`` differing bits.

    Rows are sorted by unit. Side 0 rows meet each other; rows of sides 1 and 2 meet across.
    """
    codes = steps_code(prints)
    starts = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
    sizes = np.diff(np.r_[starts, len(units)])
    left, right = [], []

    def verified(i: np.ndarray, j: np.ndarray) -> None:
        meet = (sides[i] == 0) | (sides[i] != sides[j])
        i, j = i[meet], j[meet]
        near = np.bitwise_count(codes[i] ^ codes[j]) <= distance
        i, j = i[near], j[near]
        exact = np.bitwise_count(prints[i] ^ prints[j]) <= distance
        left.append(i[exact])
        right.append(j[exact])

    size_of = np.repeat(sizes, sizes)
    few = np.flatnonzero((size_of > 1) & (size_of <= SMALL))
    for shift in range(1, SMALL):
        few = few[few + shift < len(units)]
        few = few[units[few] == units[few + shift]]
        if not len(few):
            break
        verified(few, few + shift)
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        for at in range(start, start + size, 512):
            rows = np.arange(at, min(at + 512, start + size))
            others = np.arange(at, start + size)
            near = np.bitwise_count(codes[rows][:, None] ^ codes[others][None, :]) <= distance
            i, j = np.nonzero(near)
            i, j = rows[i], others[j]
            ordered = i < j
            verified(i[ordered], j[ordered])
    return np.concatenate(left or [np.empty(0, np.int64)]), np.concatenate(right or [np.empty(0, np.int64)])


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every linked id to the smallest id it reaches through the links of positions a and b."""
    names, at = np.unique(np.concatenate([ids[a], ids[b]]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(names))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(names))
    return names[moved], names[label[moved]]


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between representatives of (rep, print) rows that connect what lies within ``distance`` bits."""
    if distance != 3:
        raise ValueError("the blocks are laid out for three differing bits")
    schema = arrow_schema("cell:int64 print:int64 rep:int64")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).to_numpy(zero_copy_only=False)
            grid = cells(values.view(np.uint64), distance)
            times = grid.shape[1]
            columns = [pa.array(grid.ravel()), pa.array(np.repeat(values, times)),
                       batch.column(0).take(pa.array(np.repeat(np.arange(len(values)), times)))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = arrow_map(prints.select("rep", "print"), spread, "cell:int64 print:int64 rep:int64")
    rows = stored(rows, "simhash-cells")
    full = rows.groupBy("cell").count().where(F.col("count") > CELL)
    chunks = full.select("cell", F.ceil(F.col("count") / CELL).cast("int").alias("chunks"))
    dealt = rows.join(chunks, "cell", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("print"), F.col("chunks")).cast("int"))
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    met = met.select(
        "cell",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        "print",
        "rep",
    )
    # rows of a chunk meet those of another across, and each other in the unit of the chunk alone
    met = met.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    out_schema = arrow_schema("a:int64 b:int64")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def found(rows: pa.Table) -> pa.RecordBatch:
            cell, low, high, side, value, rep = (rows.column(i).to_numpy() for i in range(6))
            fresh = np.r_[True, (cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
            a, b = links_in(np.cumsum(fresh), side, value.view(np.uint64), distance)
            a, b = forest(rep, a, b)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=out_schema)

        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            # the last unit may go on in the next batch
            last = [rows.column(i)[-1].as_py() for i in range(3)]
            same = np.ones(len(rows), bool)
            for i in range(3):
                same &= rows.column(i).to_numpy() == last[i]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
            rest = rows.slice(cut)
            if cut:
                yield found(rows.slice(0, cut))
        if rest is not None:
            yield found(rest)

    return arrow_map(met, compare, "a:int64 b:int64")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, print, component_id) for every row; component_id is the smallest id reachable over links."""
    prints = stored(fingerprints(docs, shingle, key, text).drop("digest"), "simhash-prints")
    reps = stored(prints.groupBy("print").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    groups = print_groups(reps, distance).join(reps, "print")
    least = groups.groupBy("group").agg(F.min("rep").alias("component_id"))
    found = groups.join(least, "group").select("print", "component_id")
    return prints.join(found, "print").select(F.col("doc_id").alias(key), "print", "component_id")


def print_groups(prints: DataFrame, distance: int) -> DataFrame:
    """(print, group) for the stored distinct fingerprints: the smallest one reachable over links names the group."""
    roots = components(near_links(prints.select(F.col("print").alias("rep"), "print"), distance), "simhash-components")
    return prints.select("print").join(roots, prints["print"] == roots["node"], "left").select("print", F.coalesce("root", "print").alias("group"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of every group of near copies: that of its smallest id, or one without an id where none has any.

    Rows without ids are linked like others, and texts that share an id are not. Rows are told apart by id and digest of
    the text. Rows alike in both are rare; only they are shuffled whole again. Columns of any name pass through.
    """
    found = stored(fingerprints(docs, shingle), "simhash-found")
    prints = stored(found.select("print").distinct(), "simhash-prints")
    rows = found.groupBy("doc_id", "digest", "print").agg(F.count("*").alias("times")).join(print_groups(prints, distance), "print")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest", "times")).alias("first")
    chosen = rows.groupBy("group").agg(first).select("first.doc_id", "first.digest", "first.times")
    chosen = stored(chosen.toDF("chosen_id", "chosen_digest", "chosen_times"), "simhash-chosen")
    own, digest, *theirs = (unused(c, docs.columns) for c in ("own_id", "own_digest", *chosen.columns))
    chosen = chosen.toDF(*theirs)
    marked = docs.withColumn(own, F.col("doc_id").cast("bigint")).withColumn(digest, text_digest())
    same = F.col(own).eqNullSafe(F.col(theirs[0])) & (F.col(digest) == F.col(theirs[1]))
    single = marked.join(chosen.where(F.col(theirs[2]) == 1), same, "left_semi")
    repeated = marked.join(chosen.where(F.col(theirs[2]) > 1), same, "left_semi").dropDuplicates([own, digest])
    return single.unionByName(repeated).select(*(F.col(f"`{c}`") for c in docs.columns))
