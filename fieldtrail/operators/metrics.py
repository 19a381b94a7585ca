"""Projects and users with the numbers of their issues.

``issue`` is the enhanced issue table, or any table with its durations, ids and names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.functions.median import grouped_numbers
from fieldtrail.functions.text import joined

_DAY_SECONDS = 86400.0
_NUMERIC = "decimal(28,6)"
PROJECT_KEYS = ["project_id", "source_relation"]
USER_KEYS = ["user_id", "source_relation"]



def _whole(value: Column) -> Column:
    return F.round(value.cast(_NUMERIC), 0)


def _days(seconds: str) -> Column:
    return _whole(F.col(seconds) / F.lit(_DAY_SECONDS))


def _with_days(df: DataFrame) -> DataFrame:
    names = [c.removesuffix("_seconds") for c in df.columns if c.endswith("_seconds")]
    return df.withColumns({f"{c}_days": _days(f"{c}_seconds") for c in names})


def group_measures(issue: DataFrame, projects: bool = True, users: bool = True) -> DataFrame:
    """Numbers of issues, total and median seconds per project or user, duration, and whether the issues are resolved.

    Issues are read once for both: each gives a row to its project (``user_id`` is null there) for every duration of
    projects, and one to its assignee (``project_id`` is null there). The "duration" ``assigned`` is 1 for issues with an
    assignee, so that its total is their number. All is one counted histogram: averages and medians share its pass.
    """
    assigned = F.col("assignee_user_id").isNotNull()
    nulls = {c: F.lit(None).cast(issue.schema[c].dataType) for c in ("project_id", "assignee_user_id")}
    seconds = {d: F.col(f"{d}_duration_seconds") for d in ("open", "any_assignment", "last_assignment")}
    rows, wanted = [], []

    def add(project: Column, user: Column, duration: str, value: Column) -> None:
        fields = {"project_id": project, "user_id": user, "duration": F.lit(duration), "value": value}
        rows.append(F.struct(*[c.alias(name) for name, c in fields.items()]))

    if projects:
        wanted.append("project_id is not null")
        for duration in ("open", "any_assignment"):
            add(F.col("project_id"), nulls["assignee_user_id"], duration, seconds[duration])
        add(F.col("project_id"), nulls["assignee_user_id"], "assigned", assigned.cast("long"))
    if users:
        wanted.append("user_id is not null")
        add(nulls["project_id"], F.col("assignee_user_id"), "last_assignment", seconds["last_assignment"])
    long = issue.select(
        "source_relation", F.col("resolved_at").isNotNull().alias("closed"), F.inline(F.array(*rows))
    ).filter(" or ".join(wanted))
    keys = ["project_id", "user_id", "source_relation", "duration", "closed"]
    return grouped_numbers(long, keys, "value").withColumnRenamed("rows", "issues")


def _of(measure: str, duration: str, closed: bool) -> Column:
    """One measure of a group's durations, as an aggregate."""
    wanted = (F.col("duration") == duration) & (F.col("closed") == closed)
    return F.max(F.when(wanted, F.col(measure)))


def _count(measure: str, duration: str, closed: bool) -> Column:
    return F.coalesce(_of(measure, duration, closed), F.lit(0))


def _average(total: Column, count: Column) -> Column:
    value = _whole(total.cast("double") / F.nullif(count, F.lit(0)))
    return F.when(count == 0, F.lit(0).cast(_NUMERIC)).otherwise(value)


def _project_columns() -> tuple[list[Column], list[Column]]:
    def issues(closed: bool) -> Column:
        return _count("issues", "open", closed)

    def assigned(closed: bool) -> Column:
        return _count("total", "assigned", closed)

    def average(duration: str, closed: bool, count: Column) -> Column:
        # Issues in the other state add nothing, but make an empty total a zero.
        others = F.when(issues(not closed) > 0, F.lit(0))
        return _average(F.coalesce(_of("total", duration, closed), others), count)

    def median(duration: str, closed: bool) -> Column:
        return _whole(_of("median", duration, closed))

    averages = [
        issues(True).alias("count_closed_issues"),
        issues(False).alias("count_open_issues"),
        assigned(False).alias("count_open_assigned_issues"),
        average("open", True, issues(True)).alias("avg_close_time_seconds"),
        average("any_assignment", True, assigned(True)).alias("avg_assigned_close_time_seconds"),
        average("open", False, issues(False)).alias("avg_age_currently_open_seconds"),
        average("any_assignment", False, assigned(False)).alias("avg_age_currently_open_assigned_seconds"),
    ]
    medians = [
        median("open", True).alias("median_close_time_seconds"),
        median("open", False).alias("median_age_currently_open_seconds"),
        median("any_assignment", True).alias("median_assigned_close_time_seconds"),
        median("any_assignment", False).alias("median_age_currently_open_assigned_seconds"),
    ]
    return averages, medians


def _by_project(measures: DataFrame, columns: Sequence[Column]) -> DataFrame:
    return measures.filter("project_id is not null").groupBy(*PROJECT_KEYS).agg(*columns)


def project_medians(measures: DataFrame) -> DataFrame:
    """Median close time and age, over all and over assigned issues; null without any."""
    return _by_project(measures, _project_columns()[1])


def project_averages(measures: DataFrame) -> DataFrame:
    """Numbers of issues and average durations; 0 where there is no issue."""
    return _by_project(measures, _project_columns()[0])


def project_metrics(measures: DataFrame) -> DataFrame:
    """Averages and medians of a project, in seconds and whole days. ``measures`` are :func:`group_measures`."""
    averages, medians = _project_columns()
    return _with_days(_by_project(measures, [*averages, *medians]))


def project_enhanced(issue: DataFrame, metrics: DataFrame, staged: Mapping[str, DataFrame], cfg: Config) -> DataFrame:
    """Projects with lead, epics, components and metrics."""
    lead = staged["user"].select(
        "source_relation",
        F.col("user_id").alias("project_lead_user_id"),
        F.col("user_display_name").alias("project_lead_user_name"),
        F.col("email").alias("project_lead_email"),
    )
    epics = (
        issue.filter(F.lower("issue_type") == "epic")
        .groupBy(*PROJECT_KEYS)
        .agg(joined("issue_name").alias("epics"))
    )
    df = (
        staged["project"]
        .join(metrics, PROJECT_KEYS, "left")
        .join(lead, ["source_relation", "project_lead_user_id"], "left")
        .join(epics, PROJECT_KEYS, "left")
    )
    if cfg.using_components:
        components = staged["component"].groupBy(*PROJECT_KEYS).agg(joined("component_name").alias("components"))
        df = df.join(components, PROJECT_KEYS, "left")
    return df.withColumns(
        {
            c: F.coalesce(c, F.lit(0))
            for c in ("count_closed_issues", "count_open_issues", "count_open_assigned_issues")
        }
    )


def user_metrics(measures: DataFrame) -> DataFrame:
    """Averages and medians over the issues assigned to a user. ``measures`` are :func:`group_measures`."""

    def average(closed: bool) -> Column:
        return _average(_of("total", "last_assignment", closed), _count("issues", "last_assignment", closed))

    def median(closed: bool) -> Column:
        return _whole(_of("median", "last_assignment", closed))

    return _with_days(
        measures.filter("user_id is not null")
        .groupBy(*USER_KEYS)
        .agg(
            _count("issues", "last_assignment", True).alias("count_closed_issues"),
            _count("issues", "last_assignment", False).alias("count_open_issues"),
            average(True).alias("avg_close_time_seconds"),
            average(False).alias("avg_age_currently_open_seconds"),
            median(True).alias("median_close_time_seconds"),
            median(False).alias("median_age_currently_open_seconds"),
        )
    )


def user_enhanced(issue: DataFrame, metrics: DataFrame, user: DataFrame) -> DataFrame:
    """Users with the projects they have issues in, and their metrics."""
    projects = (
        issue.select(F.col("assignee_user_id").alias("user_id"), "source_relation", "project_name")
        .filter("user_id is not null")
        .distinct()
        .groupBy(*USER_KEYS)
        .agg(joined("project_name").alias("projects"))
    )
    return (
        user.join(metrics, USER_KEYS, "left")
        .join(projects, USER_KEYS, "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("count_closed_issues", "count_open_issues")})
    )
