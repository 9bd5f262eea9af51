"""Joins that stay balanced when one key holds a large part of the rows, and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most this many keys are treated as hot: a key outside the list is rarer than each one inside it.
MAX_HOT_KEYS = 1000
HOT_MIN_ROWS = 1_000_000
SALTS = 64
BROADCAST_MAX_ROWS = 200_000


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_MIN_ROWS) -> list:
    """The most frequent values of a key, at most ``MAX_HOT_KEYS`` of them whatever the table's size.

    Counting combines on the map side, so the hot values themselves cost no skew, and only the key is read.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") >= min_rows)
    return [row[0] for row in counts.orderBy(F.desc("count"), key).limit(MAX_HOT_KEYS).collect()]


def salted_left_join(
    left: DataFrame,
    right_frames: list[DataFrame],
    key: str,
    spread: str,
    min_rows: int = HOT_MIN_ROWS,
    salts: int = SALTS,
    hot: list | None = None,
) -> DataFrame:
    """Left joins of one big frame with frames that are unique on a text key, safe for hot and null keys.

    ``spread`` is a well-spread column of the left frame (its own key). Rows of a hot key are dealt over
    ``salts`` groups and only the matching right rows are repeated; rows without a key get a key of their own
    that matches nothing, so they spread over all tasks. Every other row joins as usual. All joins share one
    partitioning of the left frame. The list of hot keys decides balance only, never the result; pass it
    (``hot``) where :func:`hot_keys` can count them on a cheaper frame or once for several joins.
    """
    hot = hot_keys(left, key, min_rows) if hot is None else hot
    value, mark = F.col(key), F.lit("\0")

    def salted(salt: Column) -> Column:
        return F.concat(value, mark, salt.cast("string"))

    dealt = F.concat(mark, F.col(spread).cast("string"))
    left_key = F.when(value.isNull(), dealt)
    if hot:
        left_key = left_key.when(value.isin(hot), salted(F.pmod(F.xxhash64(F.col(spread)), F.lit(salts))))
    result = left.withColumn("_on", left_key.otherwise(value))
    for right in right_frames:
        rows = right.filter(value.isNotNull())
        if hot:
            repeated = F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda n: salted(n))
            rows = rows.withColumn("_on", F.explode(F.when(value.isin(hot), repeated).otherwise(F.array(value))))
        else:
            rows = rows.withColumn("_on", value)
        result = result.join(rows.drop(key), "_on", "left")
    return result.drop("_on")


def keep_matching(left: DataFrame, right: DataFrame, key: str, spread: str, **options) -> DataFrame:
    """Inner join with a frame that is unique on the key, balanced like :func:`salted_left_join`."""
    joined = salted_left_join(left, [right.withColumn("_hit", F.lit(True))], key, spread, **options)
    return joined.filter("_hit").drop("_hit")


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether a frame has at most ``max_rows`` rows; stops reading once it has seen more."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_with_small(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread: Column,
    how: str = "inner",
    max_rows: int = BROADCAST_MAX_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join with a frame that is usually small (query terms, keys, buckets).

    Within ``max_rows`` it is broadcast, and the big frame is not shuffled at all. Beyond that both sides are
    shuffled with the big side dealt over ``salts`` groups, so a frequent key does not end in one task.
    """
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    every_salt = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    salted_small = small.withColumn("_salt", F.explode(every_salt))
    return salted_big.join(salted_small, [*on, "_salt"], how).drop("_salt")


def top_k(df: DataFrame, k: int, *order: Column, groups: int = 200) -> DataFrame:
    """The first ``k`` rows of an order, found in two rounds so that no single task sees every task's rows.

    Rows first compete inside groups of input partitions (each keeps at most ``k``, already cut on the map
    side), then the group winners compete. Any grouping gives the same result.
    """
    from pyspark.sql import Window

    window = Window.partitionBy("_group").orderBy(*order)
    grouped = df.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(groups)))
    winners = grouped.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= k)
    return winners.drop("_group", "_place").orderBy(*order).limit(k)
