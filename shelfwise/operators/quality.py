"""Warn-only data-quality rules: rows are kept, violations are counted."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

# Rule name -> predicate that good rows satisfy.
DEFAULT_RULES = {
    "valid_qty": "qty_sold >= 0",
    "valid_inventory": "inventory_on_hand >= 0",
}


def _failed(predicate: str) -> Column:
    """Rows that do not satisfy the predicate; NULL counts as failed."""
    return F.count_if(~F.coalesce(F.expr(predicate), F.lit(False)))


def observe_rules(
    df: DataFrame,
    observation: Observation,
    rules: Mapping[str, str] = DEFAULT_RULES,
    **extra: Column,
) -> DataFrame:
    """Same rows; counts and ``extra`` aggregates arrive in ``observation`` with the writing job.

    Call it on the frame that is written, after its last shuffle: tasks of the
    final stage are counted once, whereas a lost executor makes earlier stages
    run, and count, again.
    """
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[_failed(predicate).alias(name) for name, predicate in rules.items()],
        *[value.alias(name) for name, value in extra.items()],
    )


def rule_report(df: DataFrame, rules: Mapping[str, str] = DEFAULT_RULES) -> DataFrame:
    """``(rule, passed, failed)`` for all rules in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[_failed(predicate).alias(name) for name, predicate in rules.items()],
    )
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("rule"),
            (F.col("_rows") - F.col(name)).alias("passed"),
            F.col(name).alias("failed"),
        )
        for name in rules
    ])
    return counts.select(F.inline(lines))
