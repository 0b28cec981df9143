"""Range rules: one strict predicate per metric, on one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..thresholds import DEFAULT, RangeRule, Thresholds


def rule_condition(rule: RangeRule) -> Column:
    """True when the value is outside (lo, hi); False for NULL and NaN.

    Spark orders NaN above every number, so ``NaN > hi`` would be true; the
    deployed job compares Java doubles, where every NaN comparison is false.
    """
    c = F.col(rule.metric)
    parts = []
    if rule.lo is not None:
        parts.append(c < F.lit(rule.lo))
    if rule.hi is not None:
        parts.append(c > F.lit(rule.hi))
    out = reduce(lambda a, b: a | b, parts)
    return F.coalesce(out & ~F.isnan(c), F.lit(False))


def rule_columns(th: Thresholds = DEFAULT) -> list[Column]:
    cols = [rule_condition(r).alias(f"rule_{r.metric}") for r in th.rules]
    return cols


def rule_any(th: Thresholds = DEFAULT) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"rule_{r.metric}") for r in th.rules])


def add_rule_flags(df: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Append ``rule_<metric>`` for every rule and ``rule_any``; narrow, no shuffle."""
    return df.select("*", *rule_columns(th)).withColumn("rule_any", rule_any(th))
