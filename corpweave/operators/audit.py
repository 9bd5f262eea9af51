"""Rule-based data audits: rules bound to columns by name pattern, all evaluated in one pass."""

from __future__ import annotations

import fnmatch
import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERITIES = ["info", "warning", "critical", "exception"]


@dataclass(frozen=True)
class AuditRule:
    """One expectation. ``holds`` says whether a non-null value is fine; ``None`` means the not-null rule."""

    name: str
    patterns: tuple[str, ...]
    holds: Callable[[Column], Column] | None
    mostly: float = 1.0
    severity: str = "warning"
    description: str = ""


def not_null(patterns: tuple[str, ...], mostly: float, severity: str, description: str = "") -> AuditRule:
    return AuditRule("not_null", patterns, None, mostly, severity, description)


def between(patterns: tuple[str, ...], low, high, mostly: float, severity: str, description: str = "") -> AuditRule:
    return AuditRule(
        f"between:{low}:{'now+1' if isinstance(high, Column) else high}",
        patterns,
        lambda c: c.between(F.lit(low), high),
        mostly,
        severity,
        description,
    )


def length_between(patterns: tuple[str, ...], low: int, high: int, mostly: float, severity: str) -> AuditRule:
    name = f"length:{low}" if low == high else f"length:{low}:{high}"
    return AuditRule(name, patterns, lambda c: F.length(c).between(low, high), mostly, severity)


def matches(patterns: tuple[str, ...], regex: str, mostly: float, severity: str, name: str) -> AuditRule:
    return AuditRule(name, patterns, lambda c: c.rlike(regex), mostly, severity)


# Thresholds and severities of the silver audit.
HTTP_URL = r"^https?://[^\s/$.?#].[^\s]*$"


def silver_rules(primary_key: str) -> list[AuditRule]:
    """The rules every silver table is audited with; uniqueness of the key is added by :func:`audit`."""
    words = ("desc__product_services", "desc__market_niches", "desc__business_model", "desc__industry")
    next_year = F.year(F.current_date()) + 1
    return [
        not_null((primary_key,), 1.0, "critical"),
        length_between(("loc__iso2_country_code",), 2, 2, 0.98, "critical"),
        not_null(("loc__iso2_country_code",), 0.98, "critical"),
        not_null(("loc__country",), 0.95, "warning"),
        not_null(("url__request_url",), 0.55, "warning"),
        matches(("url__request_url",), HTTP_URL, 0.85, "warning", "http_url"),
        not_null(("url__normalized_request_url",), 0.5, "warning"),
        length_between(("url__normalized_request_url",), 1, 2048, 0.9, "warning"),
        between(("cnt__employees",), 0, 10_000_000, 0.97, "warning"),
        between(("dt__founded_year",), 1000, next_year, 0.98, "warning"),
        between(("*revenue_quantity*",), 0, 10**15, 0.96, "warning"),
        not_null(("desc__description_*",), 0.35, "info"),
        not_null(words, 0.35, "info"),
    ]


def bind(rules: list[AuditRule], columns: list[str]) -> list[tuple[AuditRule, str]]:
    """Rules with the columns they apply to; a rule that fits no column is reported."""
    bound = []
    for rule in rules:
        hits = [c for c in columns if any(fnmatch.fnmatchcase(c, p) for p in rule.patterns)]
        if not hits:
            warnings.warn(f"audit rule {rule.name} {rule.patterns} matches no column", stacklevel=2)
        bound.extend((rule, c) for c in hits)
    return bound


def audit_columns(rules: list[AuditRule], columns: list[str], primary_key: str) -> list[str]:
    """The columns an audit reads."""
    return list(dict.fromkeys([primary_key, *[c for _, c in bind(rules, columns)]]))


def _outcome(evaluated: Column, unexpected: Column, mostly: Column) -> list[Column]:
    share = F.when(evaluated > 0, F.round(unexpected * F.lit(100.0) / evaluated, 4)).otherwise(F.lit(0.0))
    success = (evaluated == 0) | ((evaluated - unexpected) / F.greatest(evaluated, F.lit(1)) >= mostly)
    return [share.alias("unexpected_pct"), success.alias("success")]


def audit(df: DataFrame, primary_key: str, rules: list[AuditRule] | None = None) -> DataFrame:
    """One row per rule and column: rows evaluated, rows that break the rule, share and verdict.

    All rules are counted in a single aggregation without a shuffle of rows. Uniqueness of the key needs one
    shuffle of the key alone; every member of a group of equal keys counts as unexpected.
    """
    rules = silver_rules(primary_key) if rules is None else rules
    bound = bind(rules, df.columns)
    aggregates = [F.count(F.lit(1)).alias("total")]
    for i, (rule, column) in enumerate(bound):
        c = F.col(column)
        aggregates.append(F.count(c).alias(f"n{i}"))
        if rule.holds is not None:
            aggregates.append(F.count_if(c.isNotNull() & ~rule.holds(c)).alias(f"x{i}"))
    counts = df.agg(*aggregates)
    entries = []
    for i, (rule, column) in enumerate(bound):
        evaluated = F.col("total") if rule.holds is None else F.col(f"n{i}")
        unexpected = F.col("total") - F.col(f"n{i}") if rule.holds is None else F.col(f"x{i}")
        entries.append(
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(column).alias("column"),
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.mostly).alias("mostly"),
                evaluated.alias("evaluated"),
                unexpected.alias("unexpected"),
            )
        )
    long = counts.select(F.explode(F.array(*entries)).alias("r")).select("r.*")
    groups = df.filter(F.col(primary_key).isNotNull()).groupBy(primary_key).agg(F.count(F.lit(1)).alias("n"))
    unique = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected"),
    ).select(
        F.lit("unique").alias("rule"),
        F.lit(primary_key).alias("column"),
        F.lit("critical").alias("severity"),
        F.lit(1.0).alias("mostly"),
        "evaluated",
        "unexpected",
    )
    rows = long.unionByName(unique)
    return rows.select("*", *_outcome(F.col("evaluated"), F.col("unexpected"), F.col("mostly")))


def verdict(results: DataFrame) -> DataFrame:
    """One row: the worst severity that failed, what that means, and whether the audit passes."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    worst = F.max(F.when(~F.col("success"), rank))
    summary = results.agg(
        F.coalesce(worst, F.lit(0)).cast("int").alias("worst"), F.count_if(~F.col("success")).alias("failed_rules")
    )
    outcome = (
        F.when(F.col("worst") >= 3, F.lit("failed"))
        .when(F.col("worst") == 2, F.lit("passed with warnings"))
        .when(F.col("worst") == 1, F.lit("passed with info"))
        .otherwise(F.lit("passed"))
    )
    return summary.select(outcome.alias("verdict"), (F.col("worst") < 3).alias("passed"), "failed_rules")
