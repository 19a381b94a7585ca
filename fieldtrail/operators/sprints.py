"""Sprints by day and in total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.functions.dates import week_start
from fieldtrail.functions.text import LIST_SEPARATOR, string_to_numeric, surrogate_key
from fieldtrail.operators.history import KEYS

SPRINT_KEYS = ["source_relation", "sprint_id"]
_SPRINT_FACTS = ["sprint_name", "sprint_started_at", "sprint_ended_at", "sprint_completed_at", "board_id"]
_ESTIMATES = ["original_estimate_seconds", "remaining_estimate_seconds", "time_spent_seconds"]


def point_columns(cfg: Config) -> list[str]:
    names = {"story points": "story_points", "story point estimate": "story_point_estimate"}
    return [column for name, column in names.items() if cfg.tracks(name)]


def by_team(cfg: Config) -> bool:
    return cfg.using_teams and cfg.sprint_include_teams


def split_sprint_ids(history: DataFrame, cfg: Config) -> DataFrame:
    """One row per sprint of the list in ``sprint``; points become numbers.

    Works on daily rows as well as on day intervals.
    """
    when = [c for c in ("date_day", "date_week", "from_day", "to_day") if c in history.columns]
    return history.filter(F.col("sprint").isNotNull()).select(
        *KEYS,
        *when,
        "status",
        *(["team"] if cfg.using_teams else []),
        *[string_to_numeric(F.col(c)).alias(c) for c in point_columns(cfg)],
        F.explode(F.split("sprint", LIST_SEPARATOR)).alias("sprint_id"),
    )


def daily_sprint_issue_history(
    intervals: DataFrame, issue: DataFrame, sprint: DataFrame, cfg: Config
) -> DataFrame:
    """One row per sprint, issue and day of the sprint on which the issue was in it.

    Intervals are cut to the sprint before they are multiplied to days, so days
    outside a sprint never exist. Deleted sprints drop out.
    """
    sprints = sprint.select(
        "source_relation",
        F.col("sprint_id").cast("string").alias("sprint_id"),
        "sprint_name",
        F.col("started_at").alias("sprint_started_at"),
        F.col("ended_at").alias("sprint_ended_at"),
        F.col("completed_at").alias("sprint_completed_at"),
        "board_id",
    )
    issues = issue.select(
        *KEYS,
        F.col("created_at").alias("issue_created_at"),
        F.col("resolved_at").alias("issue_resolved_at"),
        "issue_key",
        "assignee_user_id",
        "assignee_name",
        *_ESTIMATES,
    )
    start, end = F.to_date("sprint_started_at"), F.to_date("sprint_ended_at")
    day, resolved = F.col("date_day"), F.col("issue_resolved_at")
    in_sprint = (day >= start) & (end.isNull() | (day <= end))

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return (
        split_sprint_ids(intervals, cfg)
        .join(sprints, SPRINT_KEYS)
        .filter(start.isNotNull())
        .withColumn("from_day", F.greatest("from_day", start))
        .withColumn("to_day", F.least("to_day", end))
        .filter(F.col("from_day") <= F.col("to_day"))
        .join(issues, KEYS)
        .withColumn("date_day", F.explode(F.sequence("from_day", "to_day")))
        .drop("from_day", "to_day")
        .withColumn("date_week", week_start(day))
        .withColumn("is_sprint_active", flag(in_sprint))
        .withColumn("is_sprint_completed", flag(day >= F.to_date("sprint_completed_at")))
        .withColumn("is_issue_open", flag((day >= F.to_date("issue_created_at")) & resolved.isNull()))
        .withColumn(
            "is_issue_resolved_in_sprint",
            flag((day >= F.to_date(resolved)) & (resolved <= F.col("sprint_ended_at"))),
        )
        .withColumn("days_left_in_sprint", F.when((day >= start) & (day <= end), F.datediff(end, day)))
        .withColumn(
            "sprint_issue_day_id",
            surrogate_key(day, F.col("sprint_id"), F.col("issue_id"), F.col("source_relation")),
        )
    )


def resolve_sprint_team(daily_sprint: DataFrame) -> DataFrame:
    """The last known team of each issue in each sprint."""
    has_team = F.when(F.col("team").isNotNull(), F.struct("date_day", "team"))
    return daily_sprint.groupBy(*SPRINT_KEYS, "issue_id").agg(F.max(has_team)["team"].alias("team"))


def sprint_issue_facts(daily_sprint: DataFrame, cfg: Config) -> DataFrame:
    """What each issue contributes to a sprint, one row per sprint and issue.

    All sprint totals add up from these rows, so the daily rows are read once. A sum
    is null where no row of the start (end) day exists.
    """
    day = F.col("date_day")
    on_start = day == F.to_date("sprint_started_at")
    on_end = day == F.to_date("sprint_ended_at")
    facts = [
        F.max(F.col("is_sprint_active") & F.col("is_issue_open")).alias("_open"),
        F.max("is_issue_resolved_in_sprint").alias("_resolved"),
        F.max(F.when(on_start, F.lit(1))).alias("_committed"),
    ]
    for c in point_columns(cfg):
        done = F.when(F.col("is_issue_resolved_in_sprint"), F.col(c)).otherwise(F.lit(0))
        facts += [
            F.sum(F.when(on_start, F.coalesce(c, F.lit(0)))).alias(f"_{c}_committed"),
            F.sum(F.when(on_end, F.coalesce(c, F.lit(0)))).alias(f"_{c}_end"),
            F.sum(F.when(on_end, done)).alias(f"_{c}_completed"),
        ]
    if by_team(cfg):
        has_team = F.when(F.col("team").isNotNull(), F.struct("date_day", "team"))
        facts.append(F.max(has_team)["team"].alias("team"))
    constant = [*_SPRINT_FACTS, "assignee_user_id", *_ESTIMATES]
    return daily_sprint.groupBy(*SPRINT_KEYS, "issue_id").agg(*[F.first(c).alias(c) for c in constant], *facts)


def _grain(cfg: Config) -> list[str]:
    return [*SPRINT_KEYS, *(["team"] if by_team(cfg) else [])]


def _estimates() -> list[Column]:
    return [F.sum(F.coalesce(c, F.lit(0.0))).alias(c) for c in _ESTIMATES]


def _issue_counts() -> list[Column]:
    return [
        F.count("*").alias("sprint_issues"),
        F.count_distinct("assignee_user_id").alias("sprint_assignees"),
        F.count_if("_open").alias("open_sprint_issues"),
        F.count_if("_resolved").alias("resolved_sprint_issues"),
    ]


def _start_sums(cfg: Config) -> list[Column]:
    points = [F.sum(f"_{c}_committed").alias(f"{c}_committed") for c in point_columns(cfg)]
    return [*points, F.sum("_committed").alias("issues_committed")]


def _end_sums(cfg: Config) -> list[Column]:
    return [F.sum(f"_{c}_{what}").alias(f"{c}_{what}") for c in point_columns(cfg) for what in ("end", "completed")]


def sprint_estimates(facts: DataFrame, cfg: Config) -> DataFrame:
    """Estimates, each issue counted once."""
    return facts.groupBy(*_grain(cfg), *_SPRINT_FACTS).agg(*_estimates())


def sprint_issue_metrics(facts: DataFrame, cfg: Config) -> DataFrame:
    """Issues and assignees of a sprint."""
    return facts.groupBy(*_grain(cfg)).agg(*_issue_counts())


def sprint_start_metrics(facts: DataFrame, cfg: Config) -> DataFrame:
    """What was committed on the first day."""
    return facts.filter("_committed is not null").groupBy(*_grain(cfg)).agg(*_start_sums(cfg))


def sprint_end_metrics(facts: DataFrame, cfg: Config) -> DataFrame:
    """Points on the last day."""
    ended = " or ".join(f"_{c}_end is not null" for c in point_columns(cfg)) or "false"
    sums = _end_sums(cfg)
    grouped = facts.filter(ended).groupBy(*_grain(cfg))
    return grouped.agg(*sums) if sums else facts.filter(ended).select(*_grain(cfg)).distinct()


def sprint_enhanced(facts: DataFrame, cfg: Config) -> DataFrame:
    """All sprint totals in one aggregation; no join of parts is needed."""
    return facts.groupBy(*_grain(cfg), *_SPRINT_FACTS).agg(
        *_start_sums(cfg), *_end_sums(cfg), *_issue_counts(), *_estimates()
    )
