"""Alerts: activity, acknowledgement, resolution, summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import has_key, naive, seconds_between
from millrace.operators.reads import equal_to, where
from millrace.schemas import SEVERITIES


def is_active() -> Column:
    return F.col("resolved_at").isNull()


def active_alerts(df: DataFrame, severity: str | None = None) -> DataFrame:
    """Unresolved alerts, of one severity if given."""
    return where(df.filter(is_active()), equal_to(severity=severity))


def field_absent(df: DataFrame, doc: str, name: str) -> DataFrame:
    """JSON documents without the key; an explicit null is not absent."""
    return df.filter(~has_key(doc, name))


def newest_commands(commands: DataFrame) -> DataFrame:
    """The last acknowledgement and the last resolution per alert.

    Commands are ``(command_id, alert_id, action, user, ts)`` with action
    ``acknowledge`` or ``resolve``.
    """
    at = F.struct("ts", "command_id")
    ack = F.col("action") == "acknowledge"
    fix = F.col("action") == "resolve"
    return commands.groupBy("alert_id").agg(
        F.max(F.when(ack, F.col("ts"))).alias("_ack_at"),
        F.max_by("user", F.when(ack, at)).alias("_ack_by"),
        F.max(F.when(fix, F.col("ts"))).alias("_fix_at"),
        F.max("ts").alias("_changed_at"),
    )


def apply_alert_commands(alerts: DataFrame, commands: DataFrame) -> DataFrame:
    """Alerts after the commands; alerts without one pass unchanged."""
    changes = newest_commands(commands).withColumnRenamed("alert_id", "_alert_id")
    joined = alerts.join(changes, alerts["id"] == changes["_alert_id"], "left")
    updated = F.col("updated_at") if "updated_at" in alerts.columns else F.lit(None).cast("timestamp_ntz")
    return joined.withColumns(
        {
            "acknowledged_at": F.coalesce("_ack_at", "acknowledged_at"),
            "acknowledged_by": F.when(F.col("_ack_at").isNotNull(), F.col("_ack_by")).otherwise(
                F.col("acknowledged_by")
            ),
            "resolved_at": F.coalesce("_fix_at", "resolved_at"),
            "updated_at": F.coalesce(F.col("_changed_at"), updated),
        }
    ).drop("_alert_id", "_ack_at", "_ack_by", "_fix_at", "_changed_at")


def commands_not_found(commands: DataFrame, alerts: DataFrame) -> DataFrame:
    """Commands whose alert does not exist."""
    return commands.join(alerts.select("id"), commands["alert_id"] == F.col("id"), "left_anti")


def acknowledge(alerts: DataFrame, ids: DataFrame, user: str, as_of: datetime) -> DataFrame:
    """Acknowledge every alert whose id is in ``ids`` (column ``alert_id``)."""
    return apply_alert_commands(alerts, _same_command(ids, "acknowledge", user, as_of))


def resolve(alerts: DataFrame, ids: DataFrame, as_of: datetime) -> DataFrame:
    """Resolve every alert whose id is in ``ids`` (column ``alert_id``)."""
    return apply_alert_commands(alerts, _same_command(ids, "resolve", None, as_of))


def _same_command(ids: DataFrame, action: str, user: str | None, as_of: datetime) -> DataFrame:
    return ids.select(
        F.lit(0).cast("long").alias("command_id"),
        "alert_id",
        F.lit(action).alias("action"),
        F.lit(user).cast("string").alias("user"),
        naive(as_of).alias("ts"),
    )


def alert_summary(df: DataFrame) -> DataFrame:
    """Per severity and service: alerts, active ones, mean time to react."""
    return df.groupBy("severity", "service").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(is_active()).alias("active"),
        F.avg(seconds_between("created_at", "acknowledged_at")).alias("mean_ack_seconds"),
        F.avg(seconds_between("created_at", "resolved_at")).alias("mean_resolve_seconds"),
    )


def active_by_service(df: DataFrame) -> DataFrame:
    """Active alerts: one row per service, one column per severity."""
    counts = {
        s: F.count_if(is_active() & (F.col("severity") == s)).alias(s) for s in SEVERITIES
    }
    return df.groupBy("service").agg(*counts.values())
