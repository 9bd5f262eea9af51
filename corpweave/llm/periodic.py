"""Periodic runs of words, as maximal pairs of the LCP-interval tree.

A run is a stretch with smallest period q and length of at least ``max(LEAST, 2 q)`` that no neighbouring word extends
keeping period q. Its first word and the word q further begin a maximal pair: equal stretches of ``length - q`` words whose
left words differ and whose right words differ. The other way round, every maximal pair whose distance q is no more than
its length, and which covers at least ``LEAST`` words, is a repetition that cannot be extended; of those with the same
start and length the one with the smallest q is the run. So runs are read off the maximal pairs, with no extension.

1. Texts are taken together until they have ``WORDS`` words. Word numbers differ from text to text, and a number used once
   ends each text, so no suffix is compared beyond its text. Suffixes are sorted by prefix doubling, in which only suffixes
   not yet told apart take part; the ranks of all doublings give the lengths of common prefixes.
2. Neighbours in the suffix order with at least ``LEAST / 2`` words in common form the subtrees that can hold pairs: with a
   shorter prefix no distance satisfies both constraints. Subtrees with one left word, or whose closest positions lie
   further apart than their longest prefix, hold none either.
3. The other subtrees are walked bottom-up. An interval holds its positions in order, and by left word (class lists).
   When two children meet, each position of the smaller one looks for positions of the larger at no more than the
   prefix's length and with another left word. Ranges of the class lists tell how many there are, so ranges of the same
   left word, which periodic texts are full of, are skipped by halving. The smaller child is then merged into the larger.

Everything happens where a text is read: nothing is shuffled. Bounds: a task holds ``WORDS`` words or one text, and four
bytes per word and doubling; the number of pairs found is at most proportional to the number of words.

Cases: null and empty texts have no words and no runs; very long texts are taken whole; repeated rows and ids are treated
row by row; null ids stay null; of runs tying in length the smallest start, then period, comes first; an empty table
gives no rows; columns besides the two named are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import arrow_map, arrow_schema, text_or_empty

#: Least number of words in a run, and words of texts taken together.
LEAST, WORDS = 12, 200_000
#: Positions looked at one by one before a range is halved.
FEW = 8

Runs = list[tuple[int, int, int]]


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in order and, for each doubling, ranks that are equal where 2^doubling words are equal.

    ``ids`` are numbers from 0; the last of every text occurs once, so suffixes differ before their text ends.
    """
    held = np.bincount(ids)
    rank = (np.cumsum(held) - held)[ids].astype(np.int32)
    levels, step, size = [rank], 1, len(ids) + 1
    active = np.flatnonzero(held[ids] > 1)
    while len(active):
        old = rank[active].astype(np.int64)
        key = old * size + rank[active + step]
        order = np.argsort(key, kind="stable")
        active, old, key = active[order], old[order], key[order]
        at = np.arange(len(key))
        fresh = np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(fresh, at, 0))
        base = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        rank = rank.copy()
        rank[active] = old + first - base
        levels.append(rank)
        alone = fresh & np.r_[fresh[1:], True]
        active = active[~alone]
        step *= 2
    order = np.empty(len(ids), np.int64)
    order[rank] = np.arange(len(ids))
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one before it in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    same = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b, n = order[same - 1], order[same], np.zeros(len(same), np.int64)
    for power in range(len(levels) - 1, -1, -1):
        n += (levels[power][a + n] == levels[power][b + n]).astype(np.int64) << power
    out[same] = n
    return out


class Interval:
    """Positions of an interval, in order and by left word."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int) -> None:
        self.places = [place]
        self.classes = {left: [place]}

    def take(self, other: Interval) -> None:
        merge(self.places, other.places)
        for left, places in other.classes.items():
            if left in self.classes:
                merge(self.classes[left], places)
            else:
                self.classes[left] = places

    def unlike(self, low: int, high: int, left: int) -> Iterator[int]:
        """Positions from low to high whose left word is another."""
        places, same = self.places, self.classes.get(left, ())
        todo = [(bisect_left(places, low), bisect_right(places, high))]
        while todo:
            a, b = todo.pop()
            if a == b:
                continue
            c, d = bisect_left(same, places[a]), bisect_right(same, places[b - 1])
            if b - a == d - c:
                continue
            if c == d:
                yield from places[a:b]
            elif b - a <= FEW:
                like = set(same[c:d])
                yield from (p for p in places[a:b] if p not in like)
            else:
                middle = (a + b) // 2
                todo += [(a, middle), (middle, b)]


def merge(large: list[int], small: list[int]) -> None:
    if len(small) <= FEW:
        for place in small:
            insort(large, place)
    else:
        large += small
        large.sort()


def maximal_pairs(places: list[int], prefixes: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(start, distance, length) of the maximal pairs of a subtree that cover ``least`` words at no more than their length.

    ``prefixes[k]`` are the words that suffixes k - 1 and k share; ``left[k]`` is the word before suffix k.
    """
    open_intervals: list[tuple[Interval, int]] = []
    for k, place in enumerate(places):
        node = Interval(place, left[k])
        after = prefixes[k + 1] if k + 1 < len(places) else -1
        while open_intervals and open_intervals[-1][1] >= after:
            other, length = open_intervals.pop()
            if len(other.places) > len(node.places):
                node, other = other, node
            for word, some in other.classes.items():
                for p in some:
                    for q in node.unlike(p - length, p + length, word):
                        if abs(p - q) + length >= least:
                            yield min(p, q), abs(p - q), length
            node.take(other)
        open_intervals.append((node, after))


def runs_of(texts: list[list[int]], least: int = LEAST) -> list[Runs]:
    """(start, length, period) of the runs of each text, by start and period; the texts have no word number in common."""
    out: list[Runs] = [[] for _ in texts]
    ends = np.cumsum([len(words) + 1 for words in texts])
    if not len(ends) or ends[-1] == len(texts):
        return out
    next_id = 1 + max(max(words) for words in texts if words)
    ids = np.empty(ends[-1], np.int64)
    for words, end in zip(texts, ends.tolist(), strict=True):
        ids[end - 1 - len(words) : end - 1] = words
    ids[ends - 1] = next_id + np.arange(len(ends))
    order, levels = suffix_order(ids)
    prefix = common_prefixes(order, levels)
    joined = prefix >= (least + 1) // 2
    member = joined | np.r_[joined[1:], False]
    rows = np.flatnonzero(member)
    if not len(rows):
        return out
    tree = np.cumsum(~joined[rows])  # a member that is not joined to the one before begins a subtree
    place = order[rows]
    left = np.r_[-1, ids][place]
    starts = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    mixed = np.minimum.reduceat(left, starts) != np.maximum.reduceat(left, starts)
    longest = np.maximum.reduceat(np.where(joined[rows], prefix[rows], 0), starts)
    by_place = np.lexsort((place, tree))
    gap = np.r_[np.diff(place[by_place]), 0]
    gap[np.r_[starts[1:] - 1, len(gap) - 1]] = np.iinfo(np.int64).max
    possible = mixed & (np.minimum.reduceat(gap, starts) <= longest)
    stops = np.r_[starts[1:], len(rows)]
    smallest: dict[tuple[int, int], int] = {}
    for a, b in zip(starts[possible].tolist(), stops[possible].tolist(), strict=True):
        for start, distance, length in maximal_pairs(place[a:b].tolist(), prefix[rows[a:b]].tolist(), left[a:b].tolist(), least):
            key = (start, distance + length)
            smallest[key] = min(distance, smallest.get(key, distance))
    found = np.array([(s, n, q) for (s, n), q in smallest.items()], np.int64).reshape(-1, 3)
    text = np.searchsorted(ends, found[:, 0], "right")
    begun = np.r_[0, ends][text]
    for t, s, n, q in sorted(zip(text.tolist(), (found[:, 0] - begun).tolist(), found[:, 1].tolist(), found[:, 2].tolist(), strict=True)):
        out[t].append((s, n, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(words: list[bytes], runs: Runs) -> bytes:
    """The words that no run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def repeat_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """A control: one text in ten, chosen by its id's checksum, repeats a stretch from some word on to its end."""
    h = zlib.crc32(str("" if key is None else key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, starts, lengths, periods, collapsed): the runs of every whole text, and the text without what they repeat.

    ``prepare`` may change the words of a text, given its id, before runs are looked for.
    """
    fields = "doc_id:int64 starts:longs lengths:longs periods:longs collapsed:string"
    schema = arrow_schema(fields)

    def found(keys: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        numbers = count().__next__
        runs = runs_of([list(map(defaultdict(numbers).__getitem__, words)) for words in texts], least)
        columns = [pa.array([[r[i] for r in some] for some in runs], pa.list_(pa.int64())) for i in range(3)]
        left = pa.array([collapsed(words, some).decode() for words, some in zip(texts, runs, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *columns, left], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, held = [], [], 0
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = value.as_py().encode().split()
                keys.append(i)
                texts.append(prepare(i, words) if prepare else words)
                held += len(words)
                if held >= WORDS:
                    yield found(keys, texts)
                    keys, texts, held = [], [], 0
            if keys:
                yield found(keys, texts)

    given = docs.select(docs[key].cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return arrow_map(given, run, fields)


def longest_run() -> Column:
    """The run of ``periodic_runs`` with most words (ties: smallest start, then period), or null."""
    runs = F.arrays_zip("starts", "lengths", "periods")
    ordered = F.transform(runs, lambda r: F.struct((-r["lengths"]).alias("less"), r["starts"].alias("start"), r["periods"].alias("period")))
    return F.array_min(ordered)


def run_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of the rows of ``periodic_runs``."""
    each = F.transform(F.arrays_zip("starts", "lengths", "periods"), lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"]))
    spelled = F.concat(F.array_join(each, "\n"), F.when(F.size("starts") > 0, "\n").otherwise(""))
    rows = found.select("*", longest_run().alias("best"))
    return rows.select(
        "doc_id",
        F.size("starts").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
        F.sha2(spelled, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
