"""Everything known about an issue today, one row per issue."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.functions.dates import seconds_between
from fieldtrail.functions.text import joined
from fieldtrail.operators.history import KEYS

TOO_LONG = "conversation too long to render"


def _is_epic_link() -> Column:
    return F.lower("field_name").like("epic%link")


def _is_assignment() -> Column:
    return F.lower("field_id").isin("assignee", "resolutiondate") & F.col("field_value").isNotNull()


def _latest_epic() -> Column:
    return F.max(F.when(_is_epic_link(), F.struct("updated_at", "field_id", "field_value")))


def _assignments() -> list[Column]:
    assigned = F.when(_is_assignment() & (F.lower("field_id") == "assignee"), F.col("updated_at"))
    resolved = F.when(_is_assignment() & (F.lower("field_id") == "resolutiondate"), F.col("updated_at"))
    return [
        F.min(assigned).alias("first_assigned_at"),
        F.max(assigned).alias("last_assigned_at"),
        F.min(resolved).alias("first_resolved_at"),
    ]


def issue_epic(history: DataFrame) -> DataFrame:
    """The latest epic link of each issue. ``history`` has field names."""
    return (
        history.filter(_is_epic_link())
        .groupBy(*KEYS)
        .agg(_latest_epic()["field_value"].alias("epic_issue_id"))
    )


def issue_assign_resolution(history: DataFrame) -> DataFrame:
    """First and last assignment, first resolution."""
    return history.filter(_is_assignment()).groupBy(*KEYS).agg(*_assignments())


def issue_log_facts(history: DataFrame) -> DataFrame:
    """:func:`issue_epic` and :func:`issue_assign_resolution` side by side, in one pass over the log."""
    return (
        history.filter(_is_epic_link() | _is_assignment())
        .groupBy(*KEYS)
        .agg(_latest_epic()["field_value"].alias("epic_issue_id"), *_assignments())
    )


def issue_type_parents(issue: DataFrame, issue_type: DataFrame, epic: DataFrame) -> DataFrame:
    """Add type name and parent: the own parent id, else the epic link.

    Issues without a parent, often most of them, get join keys of their own, so that a
    shuffle does not gather them in one task.
    """
    types = issue_type.select("source_relation", "issue_type_id", F.col("issue_type_name").alias("issue_type"))
    typed = (
        issue.join(epic, KEYS, "left")
        .withColumn("revised_parent_issue_id", F.coalesce(F.col("parent_issue_id").cast("string"), "epic_issue_id"))
        .drop("epic_issue_id")
        .join(types, ["source_relation", "issue_type_id"], "left")
    )
    # What a parent shows does not need the change log.
    parents = issue.join(types, ["source_relation", "issue_type_id"], "left").select(
        "source_relation",
        F.col("issue_id").cast("string").alias("_parent"),
        F.col("issue_type").alias("parent_issue_type"),
        F.col("issue_name").alias("parent_issue_name"),
        F.col("issue_key").alias("parent_issue_key"),
    )
    own_key = F.concat(F.lit("no parent of "), F.col("issue_id").cast("string"))
    return (
        typed.withColumn("_parent", F.coalesce("revised_parent_issue_id", own_key))
        .join(parents, ["source_relation", "_parent"], "left")
        .drop("_parent")
        .withColumn("is_parent_epic", F.lower(F.coalesce("parent_issue_type", F.lit(""))) == "epic")
    )


def issue_users(issue: DataFrame, user: DataFrame) -> DataFrame:
    """Add name, time zone and e-mail of assignee and reporter."""

    def person(role: str) -> DataFrame:
        return user.select(
            "source_relation",
            F.col("user_id").alias(f"{role}_user_id"),
            F.col("user_display_name").alias(f"{role}_name"),
            F.col("time_zone").alias(f"{role}_timezone"),
            F.col("email").alias(f"{role}_email"),
        )

    parent = F.coalesce("revised_parent_issue_id", F.col("parent_issue_id").cast("string"))
    return (
        issue.withColumn("parent_issue_id", parent)
        .drop("revised_parent_issue_id")
        .join(person("assignee"), ["source_relation", "assignee_user_id"], "left")
        .join(person("reporter"), ["source_relation", "reporter_user_id"], "left")
    )


def issue_comments(comment: DataFrame, user: DataFrame, cfg: Config) -> DataFrame:
    """Number of comments and their text, one line each, oldest first.

    Comments by unknown users do not count. A conversation is one text by definition of the
    result, so all of its lines meet in one row.
    """
    line = F.concat(
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"),
        F.lit("  -  "),
        F.col("user_display_name"),
        F.lit(":  "),
        F.col("body"),
    )
    lines = comment.join(
        user.select("source_relation", F.col("user_id").alias("author_user_id"), "user_display_name"),
        ["source_relation", "author_user_id"],
    ).select(*KEYS, "comment_id", "created_at", line.alias("line"))
    count = F.count("comment_id").alias("count_comments")
    if not cfg.include_conversations:
        return lines.groupBy(*KEYS).agg(count)
    text = joined("line", separator="\n", order="created_at, comment_id").alias("conversation")
    if cfg.conversation_char_limit is None:
        return lines.groupBy(*KEYS).agg(count, text)
    length = F.coalesce(F.sum(F.length("line") + 1), F.lit(0)).alias("_length")
    too_long = F.col("_length") > cfg.conversation_char_limit
    return (
        lines.groupBy(*KEYS)
        .agg(count, length, text)
        .withColumn("conversation", F.when(too_long, F.lit(TOO_LONG)).otherwise(F.col("conversation")))
        .drop("_length")
    )


_SPRINT_SHOWN = ["current_sprint_name", "board_id", "sprint_started_at", "sprint_ended_at", "sprint_completed_at"]
_VERSION_FIELDS = {"versions": "affects_versions", "fixVersions": "fixes_versions"}


def issue_multi_facts(
    multi_history: DataFrame, sprint: DataFrame | None = None, version: DataFrame | None = None
) -> DataFrame:
    """Latest sprint, number of sprints and versions of the latest change of each issue, in one pass over the log.

    Without ``sprint`` or ``version`` their columns are left out. A first aggregation has one row per sprint of an issue
    and per change of its versions, so the many changes of one issue are dealt to many tasks; the second takes the
    latest, and combines before its shuffle.
    """
    kinds, facts = [], []
    if sprint is not None:
        kinds.append((F.lower("field_name") == "sprint", F.lit("sprint")))
    if version is not None:
        kinds.append((F.col("field_id").isin(*_VERSION_FIELDS), F.col("field_id")))
    kind = F.explode(F.array_compact(F.array(*[F.when(is_kind, name) for is_kind, name in kinds])))
    rows = multi_history.filter(reduce(or_, [is_kind for is_kind, _ in kinds])).select(
        *KEYS, "updated_at", "field_value", kind.alias("_kind")
    )
    is_sprint = F.col("_kind") == "sprint"
    steps = [F.max("updated_at").alias("_at")]
    if version is not None:
        names = version.select("source_relation", F.col("version_id").alias("_version_id"), "version_name")
        rows = rows.withColumn("_version_id", F.col("field_value").try_cast("long")).join(
            names, ["source_relation", "_version_id"], "left"
        )
        steps.append(joined("case when _kind <> 'sprint' then version_name end").alias("_versions"))
        for field_id, column in _VERSION_FIELDS.items():
            last = F.max(F.when(F.col("_kind") == field_id, F.struct("_at", "_versions")))
            facts.append(last["_versions"].alias(column))
    latest = rows.groupBy(
        *KEYS,
        "_kind",
        F.when(is_sprint, F.col("field_value")).alias("current_sprint_id"),
        F.when(~is_sprint, F.col("updated_at")).alias("_change"),
    ).agg(*steps)
    if sprint is not None:
        found = sprint.select(
            "source_relation",
            F.col("sprint_id").cast("string").alias("_sprint"),
            F.col("sprint_name").alias("current_sprint_name"),
            "board_id",
            F.col("started_at").alias("sprint_started_at"),
            F.col("ended_at").alias("sprint_ended_at"),
            F.col("completed_at").alias("sprint_completed_at"),
        )
        # What is no sprint gets join keys of its own, so that a shuffle does not gather it in one task.
        own_key = F.concat(F.lit("no sprint of "), F.col("issue_id").cast("string"))
        latest = latest.withColumn("_sprint", F.coalesce("current_sprint_id", own_key)).join(
            found, ["source_relation", "_sprint"], "left"
        )
        # The later start wins a tie; nulls are the smallest in a struct, so a sprint without start loses it.
        order = ["_at", "sprint_started_at", "current_sprint_id"]
        last = F.max(F.when(is_sprint, F.struct(*order, *[c for c in _SPRINT_SHOWN if c not in order])))
        facts += [last[c].alias(c) for c in ("current_sprint_id", *_SPRINT_SHOWN)]
        facts.append(F.count("current_sprint_id").alias("count_sprint_changes"))
    return latest.groupBy(*KEYS).agg(*facts)


def issue_sprint(multi_history: DataFrame, sprint: DataFrame) -> DataFrame:
    """The latest sprint of each issue (the later start wins a tie) and how many it was in."""
    return issue_multi_facts(multi_history, sprint=sprint)


def issue_versions(multi_history: DataFrame, version: DataFrame) -> DataFrame:
    """Names of the versions set by the latest change, affected and fixed ones apart."""
    return issue_multi_facts(multi_history, version=version).filter(
        "affects_versions is not null or fixes_versions is not null"
    )


def issue_join(issue: DataFrame, parts: Mapping[str, DataFrame], staged: Mapping[str, DataFrame], cfg: Config) -> DataFrame:
    """Put together what the other functions found out about each issue.

    ``issue`` comes from :func:`issue_users`, and has what :func:`issue_log_facts` found; ``parts`` has, as far as in use,
    ``multi`` (of :func:`issue_multi_facts`) and ``comments``. The parts have one row per issue and share its shuffle.
    """

    def named(table: str, key: str, **columns: str) -> DataFrame:
        return staged[table].select("source_relation", key, *[F.col(c).alias(new) for new, c in columns.items()])

    df = issue
    if "multi" in parts:
        df = df.join(parts["multi"].drop("board_id"), KEYS, "left")
    if cfg.using_sprints:
        active = (F.col("sprint_started_at") <= cfg.now()) & (
            F.coalesce("sprint_completed_at", cfg.now()) >= cfg.now()
        )
        df = (
            df.withColumn("count_sprint_changes", F.coalesce("count_sprint_changes", F.lit(0)))
            .withColumn("is_active_sprint", F.coalesce(active, F.lit(False)))
        )
    if cfg.include_comments:
        df = df.join(parts["comments"], KEYS, "left").withColumn(
            "count_comments", F.coalesce("count_comments", F.lit(0))
        )
    dims = [
        (named("project", "project_id", project_name="project_name"), "project_id"),
        (
            named("status", "status_id", current_status="status_name", status_category_id="status_category_id"),
            "status_id",
        ),
        (
            named("status_category", "status_category_id", current_status_category="status_category_name"),
            "status_category_id",
        ),
        (named("resolution", "resolution_id", resolution_type="resolution_name"), "resolution_id"),
    ]
    if cfg.using_priorities:
        dims.append((named("priority", "priority_id", current_priority="priority_name"), "priority_id"))
    for dim, key in dims:
        df = df.join(dim, ["source_relation", key], "left")
    return df.drop("status_category_id")


def with_durations(issue: DataFrame, cfg: Config) -> DataFrame:
    """Seconds since creation, first and last assignment, up to the resolution or now."""
    until = F.coalesce("resolved_at", cfg.now())
    since = {"open": "created_at", "any_assignment": "first_assigned_at", "last_assignment": "last_assigned_at"}
    return issue.withColumns(
        {f"{name}_duration_seconds": seconds_between(F.col(start), until) for name, start in since.items()}
    )


def issue_labels(issue: DataFrame, staged: Mapping[str, DataFrame]) -> DataFrame:
    """Type and project of each issue, with the columns of the issue table that metrics read; no change log."""
    types = staged["issue_type"].select(
        "source_relation", "issue_type_id", F.col("issue_type_name").alias("issue_type")
    )
    projects = staged["project"].select("source_relation", "project_id", "project_name")
    return (
        issue.select(
            *KEYS, "project_id", "issue_type_id", "issue_name", "assignee_user_id", "created_at", "resolved_at"
        )
        .join(types, ["source_relation", "issue_type_id"], "left")
        .join(projects, ["source_relation", "project_id"], "left")
    )


def issue_measures(labels: DataFrame, assign_resolution: DataFrame, cfg: Config) -> DataFrame:
    """The columns of the enhanced issue that project and user metrics read, without the rest."""
    return with_durations(labels.join(assign_resolution, KEYS, "left"), cfg)


def issue_enhanced(joined_issue: DataFrame, latest: DataFrame, cfg: Config) -> DataFrame:
    """Add durations and the latest value of each history column the issue lacks.

    ``latest`` has one row per issue.
    """
    have = {c.lower() for c in joined_issue.columns}
    skip = {"issue_day_id", "date_day", "date_week", "from_day", "to_day", "is_latest"}
    added = [c for c in latest.columns if c.lower() not in have | skip]
    return with_durations(joined_issue, cfg).join(latest.select(*KEYS, *added), KEYS, "left")
