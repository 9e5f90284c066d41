"""Readiness: move OPEN groups to READY with reason ALL_PARTS or TIMEOUT.

The evaluation is a projection over the state snapshot - the candidates are a filter
of the same rows they update - so marking needs no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filegate.functions import rules
from filegate.operators.groups import GROUP_COLUMNS


def _reason(now: Column) -> Column:
    return F.when(
        F.col("status") == rules.STATUS_OPEN,
        rules.ready_reason("expected_parts", "received_parts", "expires_at", now),
    )


def is_ready(now: Column) -> Column:
    """The group is OPEN and ready at ``now``."""
    return _reason(now).isNotNull()


def ready_candidates(state: DataFrame, now: Column) -> DataFrame:
    """OPEN groups that are ready at ``now``, with the reason and the incomplete flag."""
    return (
        state.where(F.col("status") == rules.STATUS_OPEN)
        .select("*", now.alias("evaluated_at"))
        .withColumn(
            "ready_reason_candidate",
            rules.ready_reason("expected_parts", "received_parts", "expires_at", F.col("evaluated_at")),
        )
        .where(F.col("ready_reason_candidate").isNotNull())
        .withColumn(
            "incomplete_flag_calc",
            rules.incomplete_flag("ready_reason_candidate", "expected_parts", "received_parts"),
        )
    )


def mark_ready(state: DataFrame, now: Column) -> DataFrame:
    """New state: ready OPEN rows become READY with reason, flag and evaluation time."""
    reason = _reason(now)
    hit = reason.isNotNull()
    changed = {
        "status": F.when(hit, F.lit(rules.STATUS_READY)).otherwise(F.col("status")),
        "ready_reason": F.when(hit, reason).otherwise(F.col("ready_reason")),
        "incomplete_flag": F.when(
            hit, rules.incomplete_flag(reason, "expected_parts", "received_parts")
        ).otherwise(F.col("incomplete_flag")),
        "last_evaluated_at": F.when(hit, now).otherwise(F.col("last_evaluated_at")),
        "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
    }
    return state.select([changed[c].alias(c) if c in changed else F.col(c) for c in GROUP_COLUMNS])


def readiness_counters(candidates: DataFrame) -> DataFrame:
    all_parts = F.count_if(F.col("ready_reason_candidate") == rules.REASON_ALL_PARTS)
    return candidates.agg(
        F.count(F.lit(1)).alias("ready_groups"),
        all_parts.alias("ready_all_parts"),
        (F.count(F.lit(1)) - all_parts).alias("ready_timeout"),
    )
