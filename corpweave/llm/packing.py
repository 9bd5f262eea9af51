"""Best-fit packing by a configuration linear program over the length histogram.

Documents become token ids, one id 0 behind each; only longer ones are cut, into pieces of the capacity, of which the
last may be shorter. What is left to decide depends on the histogram of piece lengths alone, which has no more entries
than the capacity, so it is solved on the driver whatever the number of pieces:

* Linear program: how often to use each configuration (a multiset of lengths that fits a sequence) so that every
  length is covered and sequences are fewest. Multiplicative weights: each length has a price; a knapsack dynamic
  program over the capacity finds, for every length, the dearest configuration that holds it; those within
  ``SLACK`` of the dearest of all gain weight, and the prices of lengths covered beyond their share fall by a factor
  while others rise. Weights count once prices have found their level.
* Rounding: configurations are taken a whole number of times, those with most weight first, as long as their lengths
  last. What remains goes through the program again, and finally by best fit, longest first, into the room the
  sequences have left and into new ones, over groups of equal sequences.

Pieces get their places in a distributed way: a piece's rank among those of its length is its rank in a salted share
plus the sizes of the shares before, and ranks are dealt to the configurations in the plan's order. So no length, were
it a third of all pieces, is gathered in one task.

Bounds: the histogram has at most as many entries as the capacity, plan and places some ten thousand; the table of shares
has one row per length and ``SHARE`` pieces of it. A worker remembers twice ``CACHE`` pre-tokens.
Texts are read once; what is shuffled are rows of about 40 bytes per piece.

Ids are those of the library with ``add_special_tokens=False``: strings of added tokens in a text become these tokens.

Cases: null text counts as empty, which is one piece of the single id 0; repeated rows and ids are packed row by row;
null ids are packed too; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpweave.llm.common import arrow_map, arrow_schema, stored, text_or_empty, to_batch

CAPACITY = 2048
#: Rounds of weights in each solution, solutions before best fit takes the rest, how far from the dearest a
#: configuration may be to gain weight, the step of the prices, and what a round remembers of the coverage before.
ROUNDS, SOLUTIONS, SLACK, RATE, FORGET = 80, 4, 0.01, 0.005, 0.9
#: Pre-tokens whose ids a worker remembers, twice; pieces in one share of a length.
CACHE, SHARE = 300_000, 8_192
#: Characters of texts encoded together, and words the library encodes in one string.
CHARS, TOGETHER = 4_000_000, 1_000
#: Texts and words whose splits are restated here: ASCII and the letters from U+00C0 to U+00FF. The library splits others.
#: (Four control characters are left out that Python alone takes for white space.)
PLAIN = re.compile("[\0-\x1b\x20-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
#: The splits the vocabulary file makes of such texts in lower case.
PART = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ \t\n\r\f\va-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

#: Stands between words that are encoded in one go; a control character is a pre-token of its own.
MARK = "\x01"

Plan = list[tuple[tuple[int, ...], int]]


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable ones as themselves, others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """Token ids of texts, pre-token by pre-token: no token of the vocabulary spans ASCII white space.

    Ids are remembered in two generations: what the older one holds moves to the newer when it is asked for.
    """

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        self.bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.letters = byte_letters()
        #: Tokens the library takes out of a text before anything else.
        added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def plain(self, text: str) -> bool:
        return bool(PLAIN.fullmatch(text)) and not ("<" in text and self.added.search(text))

    def parts(self, text: str) -> list[str]:
        """The pre-tokens of a text, in lower case; words that only the library can split stand as they are."""
        if self.plain(text):
            return PART.findall(text.lower())  # no part holds white space
        out: list[str] = []
        for word in map(bytes.decode, text.encode().split()):
            if self.plain(word):
                out += PART.findall(word.lower())
            else:
                out.append(word)
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, with id 0 behind them."""
        split = [self.parts(text) for text in texts]
        if len(self.new) > CACHE:
            self.new, self.old = {}, self.new
        used = set().union(*split)
        asked = used.difference(self.new)
        known = asked.intersection(self.old)
        self.new.update(zip(known, map(self.old.__getitem__, known), strict=True))
        self.learn(asked - known)
        # a small table of what these texts use is quicker to look up than the large one
        ids = dict(zip(used, map(self.new.__getitem__, used), strict=True)).__getitem__
        return [b"".join(map(ids, parts)) + b"\0\0\0\0" for parts in split]

    def learn(self, parts: set[str]) -> None:
        tokens, ids, others = self.model.tokenize, self.bytes, []
        for part in parts:
            if part.isascii() and part.isprintable():
                shown = part
            elif self.plain(part):
                shown = part.encode().decode("latin-1").translate(self.letters)
            else:
                others.append(part)
                continue
            if "<" in part and self.added.search(part):
                others.append(part)
                continue
            self.new[part] = b"".join([ids[t.id] for t in tokens(shown)])
        for at in range(0, len(others), TOGETHER):
            some = others[at : at + TOGETHER]
            self.new.update(zip(some, self.library(some), strict=True))

    def library(self, words: list[str]) -> list[bytes]:
        """Words of several or unknown pre-tokens: in one go between marks, or one by one where a word holds the mark."""
        if not any(MARK in w for w in words):
            mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
            ids = np.array(self.tokenizer.encode_batch_fast([f" {MARK} ".join(words)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(ids == mark[0]) if len(mark) == 1 else []
            if len(at) == len(words) - 1:
                return [ids[a:b].tobytes() for a, b in zip([0, *(at + 1)], [*at, len(ids)], strict=True)]
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]


@lru_cache(maxsize=2)
def word_ids(vocabulary: str) -> WordIds:
    """One encoder per worker and vocabulary."""
    return WordIds(vocabulary)


def grouped(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in groups that hold ``CHARS`` characters, up to the last text of each."""
    group: list[str] = []
    held = 0
    for text in texts:
        group.append(text.as_py())
        held += len(group[-1])
        if held >= CHARS:
            yield group
            group, held = [], 0
    if group:
        yield group


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    fields = "doc_id:int64 piece:int64 start:int64 length:int64 ids_crc32:int64"
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary)
        for batch in batches:
            rows = []
            keys = batch.column(0).to_pylist()
            for i, ids in zip(keys, (ids for texts in grouped(batch.column(1)) for ids in encoder.encode_all(texts)), strict=True):
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((i, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield to_batch(rows, schema)

    given = docs.select(docs[key].cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return arrow_map(given, run, fields)


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every room the dearest filling: its price, the last length put in, and the room it really takes."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    taken = np.zeros(capacity + 1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room], last[room], taken[room] = best[room - 1], last[taken[room - 1]], taken[room - 1]
        if k := fits[room]:
            values = best[room - lengths[:k]] + prices[:k]
            j = int(values.argmax())
            if values[j] > best[room] + 1e-12:
                best[room], last[room], taken[room] = values[j], j, room
    return best, last, taken


def configuration(seed: int, lengths: np.ndarray, last: np.ndarray, taken: np.ndarray, capacity: int) -> tuple[int, ...]:
    items = [int(lengths[seed])]
    room = taken[capacity - lengths[seed]]
    while room > 0:
        item = int(lengths[last[room]])
        items.append(item)
        room = taken[room - item]
    return tuple(sorted(items, reverse=True))


def weigh(histogram: dict[int, int], capacity: int) -> dict[tuple[int, ...], float]:
    """Weights of configurations that solve the linear program, scaled to as many tokens as there are."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[n] for n in lengths.tolist()], float)
    at = {n: i for i, n in enumerate(lengths.tolist())}
    weight: dict[tuple[int, ...], float] = defaultdict(float)
    covered = np.zeros(len(lengths))
    prices = lengths / capacity
    for step in range(ROUNDS):
        if step == ROUNDS // 4:  # the prices have found their level
            weight.clear()
        best, last, taken = knapsack(lengths, prices, capacity)
        worth = prices + best[capacity - lengths]
        covered *= FORGET
        for seed in np.flatnonzero(worth >= worth.max() * (1 - SLACK)).tolist():
            items = configuration(seed, lengths, last, taken, capacity)
            uses = Counter(items)
            amount = min(counts[at[n]] / k for n, k in uses.items()) / ROUNDS
            weight[items] += amount
            for n, k in uses.items():
                covered[at[n]] += k * amount
        # lengths ahead of the mean get cheaper, those behind dearer
        share = covered / counts
        mean = (covered * lengths).sum() / (counts * lengths).sum()
        prices = prices * np.exp(-RATE * (share / mean - 1).clip(-1, 1))
        prices /= (prices * counts).sum() / (lengths / capacity * counts).sum()
    total = sum(w * sum(items) for items, w in weight.items())
    scale = float((lengths * counts).sum()) / total
    return {items: w * scale for items, w in weight.items()}


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Configurations and how many sequences use each; together they hold every piece exactly once."""
    left = {n: k for n, k in histogram.items() if k > 0}
    plan: Plan = []
    if capacity in left:
        plan.append(((capacity,), left.pop(capacity)))
    for _ in range(SOLUTIONS):
        before = sum(left.values())
        if len(left) < 2:
            break
        for items, weight in sorted(weigh(left, capacity).items(), key=lambda pair: (-pair[1], pair[0])):
            uses = Counter(items)
            times = min([int(weight + 0.5), *(left.get(n, 0) // k for n, k in uses.items())])
            if times > 0:
                plan.append((items, times))
                for n, k in uses.items():
                    left[n] -= k * times
        left = {n: k for n, k in left.items() if k}
        if sum(left.values()) > 0.9 * before:
            break
    return best_fit(left, capacity, plan)


def best_fit(histogram: dict[int, int], capacity: int, begun: Plan = ()) -> Plan:
    """Longest first into the fullest sequence with room, begun ones too, over groups of equal sequences."""
    groups: dict[int, list[list]] = defaultdict(list)  # room -> [items, sequences]
    for items, times in begun:
        groups[capacity - sum(items)].append([items, times])
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in sorted(r for r in groups if r >= length):
            fit = room // length
            while left and groups[room]:
                items, sequences = groups[room].pop()
                full = min(sequences, left // fit)
                if full:
                    groups[room - fit * length].append([items + (length,) * fit, full])
                    left -= full * fit
                    sequences -= full
                if sequences and left:  # fewer are left than one sequence takes
                    groups[room - left * length].append([items + (length,) * left, 1])
                    sequences -= 1
                    left = 0
                if sequences:
                    groups[room].append([items, sequences])
        fit = capacity // length
        if left // fit:
            groups[capacity - fit * length].append([(length,) * fit, left // fit])
        if left % fit:
            groups[capacity - left % fit * length].append([(length,) * (left % fit), 1])
    return [(items, n) for same in groups.values() for items, n in same]


class Places:
    """Sequence and offset of a piece by its length and its rank among the pieces of that length."""

    def __init__(self, plan: Plan) -> None:
        entries: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        filled: dict[int, int] = defaultdict(int)
        first = 0
        for items, times in plan:
            offset = 0
            for length, uses in sorted(Counter(items).items(), reverse=True):
                entries[length].append((filled[length], first, uses, offset))
                filled[length] += uses * times
                offset += uses * length
            first += times
        self.entries = {n: np.array(rows, np.int64) for n, rows in entries.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for n in np.unique(length).tolist():
            rows = length == n
            table = self.entries[n]
            start, first, uses, at = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1].T
            within = rank[rows] - start
            sequence[rows] = first + within // uses
            offset[rows] = at + within % uses * n
        return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``pieces`` is read twice, so hand in a stored table."""
    lengths = stored(pieces.groupBy("length").agg(F.count("*").alias("n")), "packing-lengths")
    places = Places(solve({r["length"]: r["n"] for r in lengths.collect()}, capacity))
    # a row per length at most, so the capacity bounds what is broadcast
    shares = F.broadcast(lengths.select("length", F.ceil(F.col("n") / SHARE).cast("int").alias("shares")))
    share = F.pmod(F.xxhash64("doc_id", "piece"), F.col("shares")).cast("int")
    dealt = pieces.join(shares, "length").withColumn("share", share).drop("shares")
    sizes = stored(dealt.groupBy("length", "share").count(), "packing-sizes")
    before = F.sum("count").over(Window.partitionBy("length").orderBy("share")) - F.col("count")
    starts = sizes.select("length", "share", before.alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = dealt.withColumn("at", rank - 1).join(starts, ["length", "share"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    fields = "doc_id:int64 piece:int64 start:int64 length:int64 ids_crc32:int64 sequence_id:int64 offset:int64"
    schema = arrow_schema(fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, found)], schema=schema)

    return arrow_map(ranked.select(*columns, (F.col("ahead") + F.col("at")).cast("bigint").alias("rank")), place, fields)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces with their sequences and offsets."""
    return pack(stored(pieces_of(docs, vocabulary, capacity), "pieces"), capacity)
