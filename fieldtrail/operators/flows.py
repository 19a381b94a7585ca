"""Example analyses: how many issues are where, day by day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.operators.history import KEYS
from fieldtrail.operators.instants import DONE, IN_PROGRESS, TO_DO, is_status_change, with_previous_status
from fieldtrail.operators.timeline import SEGMENT

_GROUP = ["source_relation", "project", "team", "status_category"]


def _status_categories(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Lower-case status name -> category, with the usual spelling of the category."""
    name = F.lower("status_category_name")
    category = F.lit("Other")
    for known in (DONE, IN_PROGRESS, TO_DO):
        category = F.when(name == known.lower(), F.lit(known)).otherwise(category)
    return (
        staged["status"]
        .join(staged["status_category"], ["source_relation", "status_category_id"], "left")
        .select("source_relation", F.lower("status_name").alias("_status"), category.alias("status_category"))
        .distinct()
    )


def daily_status_category(intervals: DataFrame, staged: Mapping[str, DataFrame]) -> DataFrame:
    """Issues per day, project, team and status category.

    Each labelled interval adds one issue on its first day and takes it away after
    its last. The changes are summed per day and group, so no row per issue and day
    ever exists; only the result is multiplied to days.
    """
    rows = (
        intervals.select(*KEYS, "from_day", "to_day", "project", "team", F.lower("status").alias("_status"))
        .join(_status_categories(staged), ["source_relation", "_status"], "left")
        .select(
            *_GROUP,
            F.inline(
                F.array(
                    F.struct(F.col("from_day").alias("report_date"), F.lit(1).alias("_change")),
                    F.struct(F.date_add("to_day", 1).alias("report_date"), F.lit(-1).alias("_change")),
                )
            ),
        )
    )
    in_order = Window.partitionBy(*_GROUP).orderBy("report_date")
    return (
        rows.groupBy(*_GROUP, "report_date")
        .agg(F.sum("_change").alias("_change"))
        .withColumn("issues_in_status", F.sum("_change").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_until", F.date_sub(F.lead("report_date").over(in_order), 1))
        .filter("issues_in_status > 0")
        .select(F.explode(F.sequence("report_date", "_until")).alias("report_date"), *_GROUP, "issues_in_status")
    )


def cumulative_flow(history: DataFrame) -> DataFrame:
    """Issues that entered a status category per day, and the running total.

    ``history`` is the timestamp history. Rows of one instant (several authors) each
    count with the categories entered at that instant; finding those is a window over
    the instant in the order that the rows have anyway, not a join with the transitions.
    """
    segment = [SEGMENT] if SEGMENT in history.columns else []
    rows = history.select(
        *KEYS, *segment, "valid_from", "author_id", "status", "status_category_name", "team", "project"
    )
    instant = Window.partitionBy(*KEYS, *segment, "valid_from")
    entered = F.collect_set(F.when(is_status_change(), F.struct("status_category_name"))).over(instant)
    by_day = Window.partitionBy(*_GROUP).orderBy("status_category_transition_date")
    return (
        with_previous_status(rows)
        .withColumn("_entered", entered)
        .select(
            *KEYS,
            "project",
            "team",
            F.to_date("valid_from").alias("status_category_transition_date"),
            F.inline("_entered").alias("status_category"),
        )
        .groupBy("status_category_transition_date", *_GROUP)
        .agg(F.count_distinct(*KEYS).alias("issues_in_new_status_category"))
        .withColumn(
            "cumulative_issues_in_status_category",
            F.sum("issues_in_new_status_category").over(by_day.rowsBetween(Window.unboundedPreceding, 0)),
        )
    )
