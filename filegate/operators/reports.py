"""Operational views and reports over the control tables (all one-shuffle aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_status(groups: DataFrame) -> DataFrame:
    """Groups per ``status, ready_reason`` and how many of them are incomplete."""
    return groups.groupBy("status", "ready_reason").agg(
        F.count(F.lit(1)).alias("total_groups"),
        F.sum(F.when(F.col("incomplete_flag"), 1).otherwise(0)).cast("long").alias("incomplete_groups"),
    )


def file_quality(file_events: DataFrame) -> DataFrame:
    """Files and parse errors per arrival date."""
    return file_events.groupBy(F.col("arrived_at").cast("date").alias("arrived_date")).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.sum(F.when(F.col("parse_error").isNotNull(), 1).otherwise(0)).cast("long").alias("parse_errors"),
    )


def operational_metrics(audit: DataFrame) -> DataFrame:
    """Audit events per ``event_type, severity``."""
    return audit.groupBy("event_type", "severity").agg(F.count(F.lit(1)).alias("event_count"))


def groups_by_status(groups: DataFrame) -> DataFrame:
    return groups.groupBy("status", "ready_reason").agg(F.count(F.lit(1)).alias("groups")).orderBy(
        "status", "ready_reason"
    )


def dispatch_reasons(dispatch: DataFrame) -> DataFrame:
    return dispatch.groupBy("dispatch_reason").agg(F.count(F.lit(1)).alias("total")).orderBy("dispatch_reason")


def audit_by_type(audit: DataFrame) -> DataFrame:
    return audit.groupBy("event_type", "severity").agg(F.count(F.lit(1)).alias("total")).orderBy(
        "event_type", "severity"
    )


def audit_timeline(audit: DataFrame) -> DataFrame:
    """Browse listing: audit rows by time with the columns an operator reads."""
    return audit.select("event_ts", "event_type", "group_key", "severity", "payload_json", "audit_id").orderBy(
        "event_ts", "event_type", "group_key", "audit_id"
    )


def groups_listing(groups: DataFrame) -> DataFrame:
    return groups.orderBy("group_key")


def dispatch_listing(dispatch: DataFrame) -> DataFrame:
    return dispatch.orderBy("group_key")
