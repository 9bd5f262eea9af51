"""Weighted and uniform samples without replacement, repeatable for a given seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpweave.operators.joins import top_k
from corpweave.session import stored

SAMPLE_SIZE = 1000
#: Groups named in the record of a run.
MOST_GROUPS = 300


def uniform_draw(key: Column, seed: str = "") -> Column:
    """A number in [0, 1) that depends on the key and the seed only: 52 bits of a hash."""
    digest = F.md5(F.concat(F.lit(seed), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def weight_of(group: Column, weights: dict[str, float] | None, default: float = 1.0) -> Column:
    """Weight of a group; groups not named get the default."""
    if not weights:
        return F.lit(float(default))
    named = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
    return F.coalesce(F.try_element_at(named, group.cast("string")), F.lit(float(default)))


def weighted_sample(
    df: DataFrame,
    key: str,
    group: str | None = None,
    weights: dict[str, float] | None = None,
    default_weight: float = 1.0,
    k: int = SAMPLE_SIZE,
    seed: str = "",
) -> DataFrame:
    """Keys, groups and scores of ``k`` rows, each row's chance growing with its weight.

    Every row scores ``u^(1/weight)`` and the largest scores win; rows of weight zero or less take no part.
    Only the key and the group are read and moved.
    """
    weight = weight_of(F.col(group), weights, default_weight) if group else F.lit(1.0)
    columns = [key, group] if group else [key]
    scored = df.select(*columns, weight.alias("_weight")).filter(F.col("_weight") > 0)
    scored = scored.select(*columns, F.pow(uniform_draw(F.col(key), seed), 1.0 / F.col("_weight")).alias("score"))
    return top_k(scored, k, F.desc("score"), F.asc(key))


def uniform_sample(df: DataFrame, key: str, k: int = SAMPLE_SIZE, seed: str = "") -> DataFrame:
    """A weighted sample in which all rows weigh the same."""
    return weighted_sample(df, key, k=k, seed=seed)


def stratified_sample(df: DataFrame, key: str, group: str, k: int = SAMPLE_SIZE, seed: str = "") -> DataFrame:
    """(key, group, score, group_rows) of a sample in which every group has its share of ``k`` rows, and one at least.

    The table is read once, for keys, groups and draws; group sizes and winners come from these. A group's quota is its
    share of ``k``, rounded up, so the sample has at most ``k`` rows and one more per group; null is a group too. Spark cuts
    each task's rows to the ``k`` best of a group before they are moved, so a hot group is no hot task.
    """
    draws = stored(df.select(key, group, uniform_draw(F.col(key), seed).alias("score")), "sample-draws")
    sizes = draws.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("group_rows"))
    total = draws.count()
    quota = F.greatest(F.lit(1), F.ceil(F.col("group_rows") * k / F.lit(max(total, 1))))
    best = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), F.asc(key)))
    winners = draws.withColumn("_place", best).filter(F.col("_place") <= max(k, 1))
    met = winners.join(sizes, F.col(group).eqNullSafe(F.col("_group"))).filter(F.col("_place") <= quota)
    return met.select(key, group, "score", "group_rows")


def distribution_map(df: DataFrame, group: str, most: int = MOST_GROUPS) -> dict[str, int]:
    """Rows per group, for a run's record: the ``most`` frequent groups by name, all others together under ``*``."""
    counts = distribution(df, group)
    named = {r[group] or "null": r["count"] for r in counts.limit(most).collect()}
    others = df.count() - sum(named.values())
    return {**named, "*": others} if others else named


def fetch_sample(df: DataFrame, winners: DataFrame, key: str, *columns: str) -> DataFrame:
    """Full rows of the winners. Spark knows the winners' number from the limit and broadcasts a small sample."""
    rows = df.select(*dict.fromkeys([key, *columns])) if columns else df
    return rows.join(winners.select(key), key, "left_semi")


def distribution(df: DataFrame, group: str) -> DataFrame:
    """Rows per group, most frequent first."""
    counts = df.groupBy(F.col(group).cast("string").alias(group)).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_first(group))


def sample_totals(
    df: DataFrame,
    group: str | None = None,
    weights: dict[str, float] | None = None,
    default_weight: float = 1.0,
    k: int = SAMPLE_SIZE,
) -> DataFrame:
    """Rows that took part and rows drawn."""
    weight = weight_of(F.col(group), weights, default_weight) if group else F.lit(1.0)
    raw = F.count_if(weight > 0)
    return df.agg(raw.alias("total_raw_records"), F.least(raw, F.lit(k)).alias("total_sampled_records"))
