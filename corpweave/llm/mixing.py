"""Mixing sources to target weights: whole copies by the repetition rate and one hash-seeded Bernoulli copy.

1. Words are counted per document and added up per source (partial aggregation, so a hot source is no hot key).
2. Sources, in the order of their names by code point and null last, take the ``WEIGHTS`` in turn. Shares of all words
   by weight are the targets; a target above ``MOST`` times its source's words is cut to that, and the excess is shared
   among the others by weight, until none is above. Each round is one aggregation over the table of sources, of which
   the driver sees two sums, whatever the number of sources.
3. A source's repetition rate is its target over its words. A document is emitted floor(rate) times, and once more if
   the hash of seed and id, as a number in [0, 1), lies below the rate's fraction.
4. Documents differ much in length, so one draw can miss a target. ``SEEDS`` seeds are tried in one aggregation, and
   each source takes the one whose words come nearest to its target (ties: the smallest seed). Every seed is a full
   independent draw with the same probability for each document; nothing depends on row order, so reruns agree.

Texts are never shuffled while the table of sources is small enough for Spark to broadcast by its own size check; beyond
that the join on the source is left to adaptive execution, which splits the partition of a hot source.

Cases: null texts count no words and are repeated like others of their source; a null source is a source of its own, the
last; empty and blank texts have size 0; a source without words has target and rate 0, and its documents are not
emitted; rows that repeat an id of one source share its draw; rows without an id draw by the digest of their text; an
empty table gives no rows; other columns pass through ``mix`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpweave.llm.common import stored, text_or_empty, unused

WEIGHTS = (5, 2, 1)
MOST = 3
SEEDS = 32
#: Hexadecimal digits of the digest that make a draw: 52 bits, exact as a double.
DIGITS = 13


def word_count(text: str = "text") -> Column:
    """Words: maximal runs of what is not one of the six ASCII white-space characters."""
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def draw_name(key: str = "doc_id", text: str = "text") -> Column:
    """What a document's draws are hashed from: its id, or its text's digest where it has none."""
    return F.coalesce(F.col(key).cast("string"), F.md5(text_or_empty(text)))


def draw(seed: int | Column, name: Column) -> Column:
    """A number in [0, 1) from seed and name."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    digits = F.substring(F.md5(F.concat(seed.cast("string"), F.lit(":"), name)), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**DIGITS))


def in_order(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, from 0 by code point, null last: ranks inside ranges of names plus the ranges before."""
    ranged = sources.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "mix-ranges")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("many"))
    ahead = F.coalesce(F.sum("many").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("range").orderBy(F.asc_nulls_last("source"))) - 1
    placed = ranged.withColumn("within", place).join(sizes.select("range", ahead.alias("ahead")), "range")
    return placed.select("source", "source_size", (F.col("ahead") + F.col("within")).alias("place"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) for rows (source, source_size)."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = stored(in_order(sources).select("source", "source_size", weight.cast("bigint").alias("weight")), "mix-sources")
    exact = "decimal(38,0)"
    ceiling = (F.col("source_size") * most).cast(exact)

    def above(rest: int, shares: int) -> Column:
        return F.col("weight").cast(exact) * F.lit(rest).cast(exact) > ceiling * F.lit(shares).cast(exact)

    whole = table.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("shares")).first()
    words, shares = whole["words"] or 0, whole["shares"] or 0
    rest, left = words, shares
    while True:
        cut = table.where(above(rest, left)).agg(F.sum(ceiling).alias("words"), F.sum("weight").alias("shares")).first()
        now = (words - int(cut["words"] or 0), shares - (cut["shares"] or 0))
        if now == (rest, left):
            break
        rest, left = now
    shared = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(max(left, 1)))
    target = F.when(above(rest, left), (F.col("source_size") * most).cast("double")).otherwise(shared)
    return table.select("source", "source_size", target.alias("target"))


def repetitions(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seeds: int = SEEDS
) -> DataFrame:
    """(source, source_size, target, rate, seed): one row per source of the stored rows (source, name, size)."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = stored(targets(by_source, weights, most).withColumn("rate", rate), "mix-rates")
    rows = sizes.join(rates.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    taken = [F.sum(F.col("size") * copies(F.col("rate"), draw(s, F.col("name")))).alias(f"taken{s}") for s in range(seeds)]
    tried = rows.groupBy("of").agg(F.first("target").alias("target"), *taken)
    misses = F.array(*(F.struct(F.abs(F.col(f"taken{s}") - F.col("target")).alias("miss"), F.lit(s).alias("seed")) for s in range(seeds)))
    chosen = tried.select("of", F.array_min(misses)["seed"].alias("seed"))
    chosen = rates.join(chosen, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    return stored(chosen, "mix-repetitions")


def copies(rate: Column, drawn: Column) -> Column:
    """How often a document is emitted."""
    return (F.floor(rate) + (drawn < rate - F.floor(rate)).cast("int")).cast("bigint")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, name, size) of every row, stored: texts are read once."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), draw_name(key, text).alias("name"), word_count(text).alias("size"))
    return stored(rows, "mix-sizes")


def mix_counts(sizes: DataFrame, rates: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every sized row: taken are its words over all its copies."""
    rows = sizes.join(rates.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    times = copies(F.col("rate"), draw(F.col("seed"), F.col("name")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mix(docs: DataFrame, rates: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixture: every row of ``docs`` as often as its source's rate and its draw say, columns as given."""
    names = {c: unused(c, docs.columns) for c in ("of", "rate", "seed", "times")}
    table = rates.select(*(F.col(c).alias(names[c]) for c in ("rate", "seed")), F.col("source").alias(names["of"]))
    rows = docs.join(table, F.col(source).eqNullSafe(F.col(names["of"])))
    times = copies(F.col(names["rate"]), draw(F.col(names["seed"]), draw_name(key, text)))
    return rows.withColumn(names["times"], times).where(F.col(names["times"]) > 0).withColumn(
        names["times"], F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(names["times"])))
    ).select(*(F.col(f"`{c}`") for c in docs.columns))
