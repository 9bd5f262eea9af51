"""Quality rules whose cutoffs are certified: false rejection of good documents is limited per stratum.

Every rule rejects documents whose measure lies above a cutoff (or below, for rules on small values). Labelled
documents decide how strict a rule may be in a stratum: among good ones that pass the fixed base rule, the number
beyond a cutoff is binomial, and the cutoff is certified when the exact (Clopper-Pearson) upper bound of its rate is at
most the rule's share of ``FALSE_REJECTION``. Cutoffs are tried from the most lenient on and the first failure stops
the rule (fixed-sequence testing, which needs no correction); over rules and strata the error probability ``ERROR`` is
divided (Bonferroni). So with probability 1 - ERROR at most a share FALSE_REJECTION of each stratum's good documents
is rejected by the certified rules together.

Statistics come from one pass over whole texts; the labelled counts are one small aggregate, strata x rules x cutoffs
rows, of which only strata with enough good labels reach the driver; the verdict is an expression over certified cutoffs.

Cases: null text has no words; a null stratum is a stratum of its own; strata without enough good labels certify
nothing, so only the base rule rejects there; null ids and null labels certify nothing; repeated labels count once
per document and repeated documents each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import arrow_map, arrow_schema, stored, text_or_empty, to_batch

FALSE_REJECTION, ERROR = 0.05, 0.05
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS, CAPITALS, MARKS = b"#*$%&|<>", bytes(range(65, 91)), b"!?"


@dataclass(frozen=True)
class Rule:
    """A measure, as SQL over the statistics, and its cutoffs from the most lenient to the strictest."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]
    rejects_above: bool = True


def falling(start: float, stop: float, steps: int) -> tuple[float, ...]:
    """Cutoffs in equal ratios."""
    return tuple(round(start * (stop / start) ** (i / (steps - 1)), 6) for i in range(steps))


def lies_beyond(rule: Rule, cutoff: Column) -> Column:
    return F.expr(rule.measure) > cutoff if rule.rejects_above else F.expr(rule.measure) < cutoff


RULES = (
    Rule("long_words", "try_divide(word_chars, n_words)", falling(40, 5, 30)),
    Rule("short_words", "try_divide(word_chars, n_words)", falling(1, 5, 30), rejects_above=False),
    Rule("symbols", "try_divide(n_symbols, n_words)", falling(2, 0.005, 30)),
    Rule("repeated_lines", "try_divide(n_dup_lines, n_lines)", falling(0.95, 0.02, 30)),
    Rule("repeated_words", "try_divide(n_repeat_words, n_words)", falling(0.95, 0.02, 30)),
    Rule("capitals", "try_divide(n_capitals, word_chars)", falling(0.95, 0.02, 30)),
    Rule("marks", "try_divide(n_marks, n_words)", falling(2, 0.005, 30)),
)
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")


def text_statistics(text: str) -> tuple[int, ...]:
    """The statistics of a whole text, in the order of ``FIELDS``."""
    data = text.encode()
    words = data.split()
    n = len(words)
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    without = lambda gone: len(data) - len(data.translate(None, gone))
    chars = len(text) - without(b" \t\n\v\f\r")
    return (n, chars, without(SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), len(lines),
            without(CAPITALS), without(MARKS))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    names: dict[tuple, int] = {}
    at = np.fromiter((names.setdefault(g, len(names)) for g in grams), np.int64, len(grams))
    twice = np.bincount(at)[at] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str | None = None) -> DataFrame:
    """``doc_id``, ``stratum`` and the statistics of every whole text."""
    fields = "doc_id:int64 stratum:string " + " ".join(f"{f}:int64" for f in FIELDS)
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield to_batch([(i, s, *text_statistics(t)) for i, s, t in rows], schema)

    group = docs[stratum].cast("string") if stratum else F.lit(None).cast("string")
    given = docs.select(docs[key].cast("bigint").alias("doc_id"), group.alias("stratum"), text_or_empty(text).alias("text"))
    return arrow_map(given, run, fields)


def base_failed() -> Column:
    """The fixed rule: too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial with n trials of probability p."""
    if p <= 0 or k >= n:
        return 1.0
    if p >= 1:
        return 0.0
    start = lgamma(n + 1)
    return min(1.0, sum(exp(start - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p)) for i in range(k + 1)))


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest rate under which at most k of n has a probability of at least ``error``."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(k, n, middle) > error else (low, middle)
    return high


def certify(beyond: list[int], n: int, most: float, error: float) -> int:
    """How many cutoffs pass in sequence; ``beyond`` counts good documents beyond each, of n."""
    for passed, k in enumerate(beyond):
        if binomial_tail(k, n, most) > error:
            return passed
    return len(beyond)


def least_labels(most: float, error: float) -> int:
    """Good labels below which not even a cutoff that rejects none of them can be certified."""
    return int(log(error) / log1p(-most)) + 1


def certified_cutoffs(measured: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[tuple]:
    """(stratum, rule, cutoff, good documents, rejected ones, upper bound) of every certified rule."""
    good = labels.where("quality = 1").select("doc_id").distinct()
    known = measured.where(~base_failed()).join(good, "doc_id", "left_semi")
    # a measure's place is the number of cutoffs it lies beyond
    places = [
        F.size(F.filter(F.array(*map(F.lit, r.cutoffs)), partial(lies_beyond, r)))
        for r in rules
    ]
    placed = known.select("stratum", F.posexplode(F.array(*places)).alias("rule", "place"))
    counts = placed.groupBy("stratum", "rule", "place").count()
    most = FALSE_REJECTION / len(rules)
    totals = counts.where("rule = 0").groupBy("stratum").agg(F.sum("count").alias("n"))
    # the error is shared by the strata that could certify anything at all
    strata = totals.where(F.col("n") >= least_labels(most, ERROR / len(rules))).withColumnRenamed("stratum", "known")
    rows = counts.join(strata, F.col("stratum").eqNullSafe(F.col("known")))
    by: dict[tuple, dict[int, int]] = {}
    size: dict[tuple, int] = {}
    for r in rows.collect():
        by.setdefault((r["stratum"], r["rule"]), {})[r["place"]] = r["count"]
        size[(r["stratum"], r["rule"])] = r["n"]
    out = []
    error = ERROR / max(1, len(by))
    for (stratum, number), places_of in by.items():
        rule, n = rules[number], size[(stratum, number)]
        steps = len(rule.cutoffs)
        beyond = [sum(c for p, c in places_of.items() if p >= steps - i) for i in range(steps)]
        passed = certify(beyond, n, most, error)
        if passed:
            k = beyond[passed - 1]
            out.append((stratum, rule.name, rule.cutoffs[passed - 1], n, k, upper_bound(k, n, error)))
    return sorted(out, key=lambda row: (row[0] or "", row[1]))


def judge(measured: DataFrame, cutoffs: list[tuple], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with base_failed, kept and the array of certified rules that reject a document."""
    # at most strata x rules entries, as literals of the expression
    found: dict[str, list[tuple[str | None, float]]] = {}
    for stratum, name, cutoff, *_ in cutoffs:
        found.setdefault(name, []).append((stratum, cutoff))
    broken = []
    for rule in rules:
        if rule.name in found:
            named = [x for pair in found[rule.name] if pair[0] is not None for x in map(F.lit, pair)]
            cutoff = F.element_at(F.create_map(*named), F.col("stratum")) if named else F.lit(None).cast("double")
            without = next((c for s, c in found[rule.name] if s is None), None)
            cutoff = F.when(F.col("stratum").isNull(), F.lit(without).cast("double")).otherwise(cutoff)
            broken.append(F.when(lies_beyond(rule, cutoff), F.lit(rule.name)))
    failed = base_failed()
    rejected = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return measured.select(
        "*", failed.alias("base_failed"), F.when(failed, F.array().cast("array<string>")).otherwise(rejected).alias("broken_rules")
    ).withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Statistics and verdict of every document, with cutoffs certified on the labelled ones."""
    measured = stored(statistics(docs, stratum=stratum), "quality-statistics")
    return judge(measured, certified_cutoffs(measured, labels))
