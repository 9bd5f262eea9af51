"""Spelling variants by PartEnum signatures: words one insertion, deletion or replacement apart.

1. Words are counted where texts are read, with counts combined per task before the shuffle.
2. A word's letter multiset is a binary vector: dimension (letter, k) is set if the word holds the letter k times or
   more. One inserted or deleted code point changes one dimension, one replaced code point two, so near words have
   vectors within Hamming distance two.
3. Partition and enumerate: dimensions are dealt to parts, so that the parts tell words apart about equally well. Words
   of one length differ in at most two parts; a signature is the choice of two parts left out of ``SAME`` with the content
   of the others. Words whose lengths differ by one differ in a single part of ``NEXT``; a word takes part in these
   signatures as the shorter and as the longer one. Near words share a signature, whatever the vectors and the parts.
4. Signatures are equi-joined: the words of a signature meet in a task, are compared there by the parities of their
   letters (at most two can differ) and verified letter by letter. A pair that shares several signatures counts in the
   first of them. What leaves the task is, per word, the number of near words and the most frequent one.
   Signatures of more than ``GROUP`` words are only named in this pass; a second one cuts their words into chunks, and
   every two chunks meet as a unit of their own.
5. A word's form is its near word of largest count if that is at least twice its own. Counts at least double along
   forms, so chains are short and have no circles; pointer jumping finds their ends in rounds.

Bounds: a counting task holds ``HELD`` words, a comparing task one unit of at most 2 * ``GROUP`` words; signatures are
SAME * (SAME - 1) / 2 + 2 * NEXT rows per distinct word that is frequent enough, not per occurrence.

Cases: null and empty texts hold no words; very long texts and words are taken whole; repeated rows and ids count each
time; rows with a null id take part (null stands for the id in the control's checksum); equal counts go to the word
smaller by code point; an empty table gives no rows; columns besides the two named are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import arrow_map, arrow_schema, stored, text_or_empty

#: Bytes of Latin-1: A-Z in lower case, a-z and U+00C0 to U+00FF as they are, spaces for all others.
LETTER = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
LEAST_CHARS, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent.
TIMES = 2
#: Parts for words of one length, of which two are left out, and for lengths that differ by one, of which one is.
SAME, NEXT = 5, 4
CHOICES = list(combinations(range(SAME), 2))
#: Words a counting task holds, words of a signature compared as one unit, words compared by shifting, widest row of letters.
HELD, GROUP, SMALL, WIDEST = 400_000, 4_096, 24, 48
#: Repetitions of a letter whose dimensions are dealt by how often words have them; others are dealt by hash.
DEALT = 4


def runs_in(text: str) -> list[bytes]:
    """The runs of letters in a text, in lower case, as Latin-1."""
    return text.encode("latin-1", "replace").translate(LETTER).split()


def count_words(texts: Iterator[tuple[int | None, str]], counts: Counter, loses: int | None = None) -> None:
    """Add the words of (id, text) rows that are long enough, as Latin-1.

    As a control, runs whose checksum with the id is divisible by ``loses`` lose a code point.
    """
    crc = zlib.crc32
    for key, text in texts:
        runs = [w for w in runs_in(text) if len(w) >= LEAST_CHARS]
        counts.update(runs)
        if not loses:
            continue
        begun = crc(b"%s:" % str("null" if key is None else key).encode())
        for run in set(runs):
            h = crc(run if run.isascii() else run.decode("latin-1").encode(), begun)
            if not h % loses:
                at, times = h % len(run), runs.count(run)
                counts[run] -= times
                if len(run) > LEAST_CHARS:
                    counts[run[:at] + run[at + 1 :]] += times


def word_counts(docs: DataFrame, loses: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words with at least ``LEAST_CHARS`` code points and ``LEAST_COUNT`` occurrences."""
    schema = arrow_schema("word:string n:int64")

    def flush(counts: Counter) -> pa.RecordBatch:
        words = [(w.decode("latin-1"), n) for w, n in counts.items() if n > 0]
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            count_words(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), counts, loses)
            if len(counts) > HELD:
                yield flush(counts)
        yield flush(counts)

    given = docs.select(docs[key].cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    counted = arrow_map(given, run, "word:string n:int64").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def dimension(letter: str, k: int) -> int:
    """The 64-bit name of a dimension."""
    return xxhash.xxh64_intdigest(f"{letter}{k}")


def dealt_parts(held: dict[tuple[str, int], int], words: int, parts: int) -> dict[tuple[str, int], int]:
    """The part of each dimension that ``held[dimension]`` of all words have, so that the parts tell words apart alike."""
    load, out = [0.0] * parts, {}
    worth = {d: min(n, words - n) / max(words, 1) for d, n in held.items()}
    for d in sorted(held, key=lambda d: (-worth[d], d)):
        out[d] = min(range(parts), key=lambda p: load[p])
        load[out[d]] += worth[d]
    return out


class Signer:
    """Signatures of words, from tables of the dimensions' values and parts."""

    def __init__(self, held: dict[tuple[str, int], int], words: int) -> None:
        self.dealt = [dealt_parts(held, words, parts) for parts in (SAME, NEXT)]
        letters = [chr(c) for c in range(256) if LETTER[c] == c and c != 32]
        self.values = np.zeros((256, WIDEST + 1), np.uint64)
        self.parts = np.zeros((2, 256, WIDEST + 1), np.int64)
        for letter in letters:
            for k in range(1, WIDEST + 1):
                self.values[ord(letter), k] = xxhash.xxh64_intdigest(dimension(letter, k).to_bytes(8, "little"), 1)
                for way in (0, 1):
                    self.parts[way, ord(letter), k] = self.part(way, letter, k)

    def part(self, way: int, letter: str, k: int) -> int:
        return self.dealt[way].get((letter, k), dimension(letter, k) % (SAME, NEXT)[way])

    def sums(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The content of each word's parts, as sums of the values of its dimensions, for both ways."""
        rows = Letters(words)
        width = max(1, int(rows.sizes[~rows.long].max(initial=0)))
        left = rows.left[:, :width]
        times = np.stack([(left[:, : j + 1] == left[:, j : j + 1]).sum(1) for j in range(width)], axis=1)
        value = np.where(left > 0, self.values[left, times], np.uint64(0))
        out = []
        for way, parts in enumerate((SAME, NEXT)):
            part = self.parts[way][left, times]
            sums = np.stack([np.where(part == p, value, np.uint64(0)).sum(1, dtype=np.uint64) for p in range(parts)], axis=1)
            for at in np.flatnonzero(rows.long).tolist():
                sums[at] = self.long_sums(way, parts, words[at])
            out.append(sums)
        return out[0], out[1]

    def long_sums(self, way: int, parts: int, word: str) -> np.ndarray:
        sums, seen = [0] * parts, Counter()
        for letter in word:
            seen[letter] += 1
            name = dimension(letter, seen[letter])
            sums[self.part(way, letter, seen[letter])] += xxhash.xxh64_intdigest(name.to_bytes(8, "little"), 1)
        return np.array([x & 0xFFFFFFFFFFFFFFFF for x in sums], np.uint64)

    def signatures(self, words: list[str]) -> np.ndarray:
        """One row of signatures per word: same length by choice, then as the shorter and as the longer by part.

        The lowest five bits of a signature are its number; side 1 is the shorter, side 2 the longer, side 0 either.
        """
        same, next_to = self.sums(words)
        sizes = np.array([len(w) for w in words], np.uint64)
        columns = [mixed(same.sum(1) - same[:, a] - same[:, b], sizes, c) for c, (a, b) in enumerate(CHOICES)]
        for shorter in (0, 1):
            columns += [mixed(next_to.sum(1) - next_to[:, p], sizes - np.uint64(shorter), len(CHOICES) + p) for p in range(NEXT)]
        return np.stack(columns, axis=1)


#: The side of each column of signatures.
SIDES = np.array([0] * len(CHOICES) + [1] * NEXT + [2] * NEXT, np.int32)


def mixed(content: np.ndarray, sizes: np.ndarray, number: int) -> np.ndarray:
    x = content + sizes * np.uint64(0x9E3779B97F4A7C15) + np.uint64((number + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return ((x & ~np.uint64(31)) | np.uint64(number)).view(np.int64)


def signed_words(words: DataFrame) -> tuple[DataFrame, Signer]:
    """(sig, side, n, word): one row per stored word and signature; and what made them."""
    fields = "sig:int64 side:int32 n:int64 word:string"
    schema = arrow_schema(fields)
    letters = F.array_distinct(F.split("word", ""))
    held = words.select("word", F.explode(letters).alias("letter")).where("letter <> ''")
    times = F.least(F.length("word") - F.length(F.replace("word", F.col("letter"), F.lit(""))), F.lit(DEALT))
    held = held.select("letter", F.explode(F.sequence(F.lit(1), times)).alias("k")).groupBy("letter", "k").count().collect()
    signer = Signer({(r["letter"], r["k"]): r["count"] for r in held}, words.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                made = signer.signatures(part.column(0).to_pylist())
                rows = pa.array(np.repeat(np.arange(len(part)), len(SIDES)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.ravel()), pa.array(np.tile(SIDES, len(part))), part.column(1).take(rows), part.column(0).take(rows)],
                    schema=schema,
                )

    rows = arrow_map(words.select("word", "n"), run, fields)
    return rows, signer


def one_edit_apart(a: str, b: str) -> bool:
    """Whether exactly one insertion, deletion or replacement of a code point turns one into the other."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(b))
    return a[at + 1 :] == (b[at + 1 :] if len(a) == len(b) else b[at:])


class Letters:
    """Words as rows of letters, from the left and from the right, to verify many pairs at once."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.sizes = np.array([len(w) for w in words])
        self.long = self.sizes > WIDEST
        data = [b"" if over else w.encode("latin-1") for w, over in zip(words, self.long.tolist(), strict=True)]
        self.left = np.array([w.ljust(WIDEST, b"\0") for w in data], f"S{WIDEST}").view(np.uint8).reshape(-1, WIDEST)
        self.right = np.array([w.rjust(WIDEST, b"\0") for w in data], f"S{WIDEST}").view(np.uint8).reshape(-1, WIDEST)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs are one edit apart: what they share in front and behind covers all but one letter."""
        small, large = np.minimum(self.sizes[i], self.sizes[j]), np.maximum(self.sizes[i], self.sizes[j])
        out = large - small <= 1
        at = np.flatnonzero(out & ~(self.long[i] | self.long[j]))
        for some in np.split(at, range(65_536, len(at), 65_536)):
            a, b = i[some], j[some]
            front = np.minimum((self.left[a] != self.left[b]).argmax(1), small[some])
            unlike = self.right[a] != self.right[b]
            back = np.minimum(np.where(unlike.any(1), unlike[:, ::-1].argmax(1), WIDEST), small[some])
            out[some] = (front + back >= large[some] - 1) & unlike.any(1)
        for k in np.flatnonzero(out & (self.long[i] | self.long[j])).tolist():
            out[k] = one_edit_apart(self.words[i[k]], self.words[j[k]])
        return out

    def parities(self) -> np.ndarray:
        """Per word one bit per letter, set if the word holds it an odd number of times (letters share bits)."""
        bits = np.where(np.arange(256) > 0, np.uint64(1) << (np.arange(256, dtype=np.uint64) & np.uint64(63)), np.uint64(0))
        out = np.bitwise_xor.reduce(bits[self.left[:, : max(1, int(self.sizes[~self.long].max(initial=0)))]], axis=1)
        for at in np.flatnonzero(self.long).tolist():
            out[at] = np.bitwise_xor.reduce(bits[np.frombuffer(self.words[at].encode("latin-1"), np.uint8)])
        return out

    def changed(self, i: np.ndarray, j: np.ndarray, signer: Signer) -> tuple[np.ndarray, np.ndarray]:
        """For near words of one length: the parts of the dimensions that only the first and only the second sets."""
        out = []
        at = (self.left[i] != self.left[j]).argmax(1)
        for one in (i, j):
            letter = self.left[one, at]
            part = signer.parts[0][letter, (self.left[one] == letter[:, None]).sum(1)]
            out.append(part)
        for k in np.flatnonzero(self.long[i]).tolist():
            a, b = self.words[i[k]], self.words[j[k]]
            x, y = next((x, y) for x, y in zip(a, b, strict=True) if x != y)
            out[0][k], out[1][k] = signer.part(0, x, a.count(x)), signer.part(0, y, b.count(y))
        return out[0], out[1]


#: For two parts, the number of the first choice that leaves both out.
FIRST = np.array([[next(c for c, left in enumerate(CHOICES) if {p, q} <= set(left)) for q in range(SAME)] for p in range(SAME)])


def near_in(
    units: np.ndarray, sides: np.ndarray, halves: np.ndarray, number: np.ndarray, letters: Letters, signer: Signer
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the near words of a unit that count there. Rows are sorted by unit.

    Rows of side 0 and of half 0 meet each other, rows of different sides or halves meet across; ``number`` is that of
    the unit's signature.
    """
    starts = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
    sizes = np.diff(np.r_[starts, len(units)])
    odd = letters.parities()
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def verify(i: np.ndarray, j: np.ndarray) -> None:
        some = ((sides[i] == 0) | (sides[i] != sides[j])) & ((halves[i] == 0) | (halves[i] != halves[j]))
        some &= np.bitwise_count(odd[i] ^ odd[j]) <= 2
        i, j = i[some], j[some]
        good = letters.near(i, j)
        i, j = i[good], j[good]
        same = np.flatnonzero(letters.sizes[i] == letters.sizes[j])
        p, q = letters.changed(i[same], j[same], signer)
        again = same[FIRST[p, q] != number[i[same]]]  # shared with an earlier signature
        left.append(np.delete(i, again))
        right.append(np.delete(j, again))

    of = np.repeat(sizes, sizes)
    few = np.flatnonzero((of > 1) & (of <= SMALL))
    for shift in range(1, SMALL):
        few = few[few + shift < len(units)]
        few = few[units[few] == units[few + shift]]
        if not len(few):
            break
        verify(few, few + shift)
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        for at in range(start, start + size, 256):
            rows, others = np.arange(at, min(at + 256, start + size)), np.arange(at, start + size)
            i, j = np.nonzero(np.bitwise_count(odd[rows][:, None] ^ odd[others][None, :]) <= 2)
            i, j = rows[i], others[j]
            verify(i[i < j], j[i < j])
    return np.concatenate(left), np.concatenate(right)


def best_near(names: pa.Array, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Per word of the pairs: how many near words it has here, and the most frequent of them."""
    word, near = np.r_[i, j], np.r_[j, i]
    of, place = np.unique(np.array([w.encode("latin-1") for w in names.to_pylist()], "O"), return_inverse=True)
    order = np.lexsort((place[near], -n[near], place[word]))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.r_[True, place[word][1:] != place[word][:-1]]) if len(word) else np.empty(0, np.int64)
    many = np.diff(np.r_[first, len(word)]).astype(np.int64)
    best = near[first]
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(word[first])), pa.array(many), names.take(pa.array(best)), pa.array(n[best]), pa.nulls(len(first), pa.int64())],
        schema=arrow_schema(PARTIAL),
    )


PARTIAL = "word:string n_near:int64 near:string near_n:int64 crowded:int64"


def compared(rows: DataFrame, signer: Signer) -> DataFrame:
    """``PARTIAL`` rows of the units of rows (sig, low, high, side, half, n, word): near words, or crowded signatures by name.

    A signature whose rows have no chunks yet (low is null) and are more than ``GROUP`` is crowded.
    """
    rows = rows.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def found(table: pa.Table) -> pa.RecordBatch:
            sig, side, half, n = (table.column(c).to_numpy() for c in ("sig", "side", "half", "n"))
            low, high = (table.column(c).fill_null(-1).to_numpy() for c in ("low", "high"))
            fresh = np.r_[True, (sig[1:] != sig[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
            unit = np.cumsum(fresh)
            many = np.bincount(unit)[unit]
            some = np.flatnonzero((many > 1) & ((many <= GROUP) | (low >= 0)))
            names = table.column("word").take(pa.array(some)).combine_chunks()
            i, j = near_in(unit[some], side[some], half[some], sig[some] & 31, Letters(names.to_pylist()), signer)
            partial = best_near(names, n[some], i, j)
            over = np.unique(sig[(many > GROUP) & (low < 0)])
            named = [pa.nulls(len(over), t) for t in arrow_schema(PARTIAL).types[:4]]
            named = pa.RecordBatch.from_arrays([*named, pa.array(over)], schema=arrow_schema(PARTIAL))
            return pa.Table.from_batches([partial, named]).combine_chunks().to_batches()

        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            # the last unit may go on in the next batch
            last = [table.column(c)[-1].as_py() for c in ("sig", "low", "high")]
            same = np.ones(len(table), bool)
            for c, value in zip(("sig", "low", "high"), last, strict=True):
                same &= table.column(c).fill_null(-1).to_numpy() == (-1 if value is None else value)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
            rest = table.slice(cut)
            if last[1] is None and len(rest) > GROUP:
                rest = rest.slice(0, GROUP + 1)  # known to be crowded; its rows are not needed here
            if cut:
                yield from found(table.slice(0, cut))
        if rest is not None:
            yield from found(rest)

    return arrow_map(rows.select("sig", "low", "high", "side", "half", "n", "word"), run, PARTIAL)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) of the stored rows (word, n): how many words are near, and the most frequent one."""
    rows, signer = signed_words(words)
    whole = rows.withColumns({"low": F.lit(None).cast("int"), "high": F.lit(None).cast("int"), "half": F.lit(0)})
    partial = stored(compared(whole, signer), "variant-near")
    crowded = stored(partial.where("crowded IS NOT NULL").select(F.col("crowded").alias("sig")), "variant-crowded")
    if crowded.limit(1).count():
        dealt = stored(rows.join(crowded, "sig"), "variant-crowded")
        chunks = dealt.groupBy("sig").count().select("sig", F.ceil(F.col("count") / GROUP).cast("int").alias("chunks"))
        dealt = dealt.join(chunks, "sig").withColumn("own", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
        # words of a chunk meet each other in the unit (c, c), and those of every other chunk across
        met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        half = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
        met = met.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other"), "half": half})
        partial = partial.unionByName(compared(met, signer))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    met = partial.where("word IS NOT NULL").groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return met.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, root) from rows (word, form): the last word of the chain of forms, by pointer jumping in stored rounds."""
    rows = stored(forms.select("word", F.coalesce("form", "word").alias("root")), "variant-roots")
    while True:
        steps = rows.where("word <> root").select(F.col("word").alias("at"), F.col("root").alias("to"))
        jumped = rows.join(steps, rows["root"] == steps["at"], "left")
        jumped = stored(jumped.select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "variant-roots")
        if not jumped.where("moved").limit(1).count():
            return jumped.select("word", "root")
        rows = jumped.select("word", "root")


def spelling_variants(docs: DataFrame, loses: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word; for ``loses`` see ``count_words``."""
    words = stored(word_counts(docs, loses, key, text), "variant-words")
    strong = F.col("near_n") >= TIMES * F.col("n")
    found = words.join(near_words(words), "word", "left").select(
        "word", "n",
        F.when(strong, F.col("near")).alias("form"),
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(strong, F.col("near_n")).alias("form_n"),
    )
    found = stored(found, "variant-forms")
    return found.join(with_roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")
