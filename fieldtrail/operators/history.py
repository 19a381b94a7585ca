"""Change logs -> one row per entity and day (or instant), one column per field."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.functions.dates import week_start
from fieldtrail.functions.text import joined, slugify, surrogate_key
from fieldtrail.operators.timeline import SEGMENT, along, with_segments

KEYS = ["source_relation", "issue_id"]

#: Stands for "explicitly set to null" until the values are filled forward.
IS_NULL = "-is_null"
_SPRINT_COLUMNS = ("sprint", "sprint_name")
_STORY_POINTS = ("story_points", "story_point_estimate")


def tracked_fields(cfg: Config, *, daily: bool) -> tuple[str, ...]:
    """Lower-case names of the configured fields; the daily tables always track teams."""
    names = [c.lower() for c in cfg.history_columns]
    if daily and cfg.using_teams and "team" not in names:
        names.append("team")
    return tuple(n for n in dict.fromkeys(names) if n not in _SPRINT_COLUMNS)


def pivot_columns(cfg: Config, *, daily: bool) -> dict[str, str]:
    """Column name -> field name, without the fixed columns status and sprint."""
    return {slugify(name): name for name in tracked_fields(cfg, daily=daily)}


def history_columns(cfg: Config, *, daily: bool) -> list[str]:
    """The pivoted columns a final history table shows, besides status.

    Columns of a table that the site does not have are left out.
    """
    hidden = set()
    if not cfg.using_components:
        hidden.add("components")
    if not cfg.using_teams:
        hidden.add("team")
    return [*_SPRINT_COLUMNS, *[c for c in pivot_columns(cfg, daily=daily) if c not in hidden]]


# --- long form ---------------------------------------------------------------


def with_field_name(log: DataFrame, field: DataFrame) -> DataFrame:
    """Add the lower-case field name and the week; changes of unknown fields are dropped.

    The list of a tracker's fields goes to the log: few fields have almost all changes,
    and a shuffle by field would leave the log to as few tasks.
    """
    names = field.select("source_relation", "field_id", F.lower("field_name").alias("field_name"))
    return log.join(F.broadcast(names), ["source_relation", "field_id"]).withColumn(
        "updated_at_week", week_start(F.col("updated_at"))
    )


def is_relevant(cfg: Config, *, daily: bool) -> Column:
    names = [*_SPRINT_COLUMNS, *tracked_fields(cfg, daily=daily)]
    return (F.lower("field_id") == "status") | F.lower("field_name").isin(*names)


def relevant_fields(history: DataFrame, cfg: Config, *, daily: bool) -> DataFrame:
    """Keep the changes of fields that become a column."""
    return history.filter(is_relevant(cfg, daily=daily))


def with_sprint_names(multi: DataFrame, sprint: DataFrame | None) -> DataFrame:
    """Repeat each sprint change as a change of ``sprint_name``, ids resolved.

    Both rows come from one pass over the log. An id without a sprint stays as it is.
    """
    columns = ["field_id", "field_name", "field_value"]
    rest = [c for c in multi.columns if c not in columns]
    if sprint is None:
        return multi.select(*rest, *columns)
    names = sprint.select(
        "source_relation", F.col("sprint_id").cast("string").alias("_sprint"), "sprint_name"
    )
    is_sprint = F.lower("field_name") == "sprint"
    change = F.struct(*columns)
    named = F.struct(
        F.lit("sprint_field").alias("field_id"),
        F.lit("sprint_name").alias("field_name"),
        F.coalesce("sprint_name", "field_value").alias("field_value"),
    )
    return (
        multi.withColumn("_sprint", F.when(is_sprint, F.col("field_value")))
        .join(names, ["source_relation", "_sprint"], "left")
        .select(*rest, F.inline(F.when(is_sprint, F.array(change, named)).otherwise(F.array(change))))
    )


def multiselect_batches(multi: DataFrame, *by: str) -> DataFrame:
    """The values set by one change as one sorted list in text form.

    ``by`` names what a change is besides field, issue and instant (its author).
    """
    return multi.groupBy("field_id", "field_name", "issue_id", "source_relation", "updated_at", *by).agg(
        joined("field_value").alias("field_value")
    )


def combined_history(single: DataFrame, multi: DataFrame, sprint: DataFrame | None, *by: str) -> DataFrame:
    """All changes in long form, one row per changed field."""
    columns = ["field_id", "field_name", *KEYS, "updated_at", *by, "field_value"]
    batches = multiselect_batches(with_sprint_names(multi, sprint), *by)
    return single.select(*columns).unionByName(batches.select(*columns))


def value_validity(history: DataFrame, cfg: Config, hot: DataFrame | None = None) -> DataFrame:
    """When each value started and ended to hold (null: it still does).

    ``hot`` are the issues to split, see ``timeline.find_hot``.
    """
    rows = with_segments(history, hot, KEYS, "updated_at")
    ties = [c for c in ("field_id", "field_value") if c != cfg.field_grain]
    valid = along(rows, [*KEYS, cfg.field_grain], ["updated_at", *ties], lead={"valid_ending_at": "updated_at"})
    return valid.withColumnRenamed("updated_at", "valid_starting_at").drop(SEGMENT)


# --- daily -------------------------------------------------------------------


def last_value_per_day(history: DataFrame, cfg: Config) -> DataFrame:
    """The last change of each field and day.

    Changes of one instant are ordered by field, then value. As an aggregate it
    combines before the shuffle, so a field changed very often in a day costs no more.
    """
    last = F.max(F.struct("updated_at", "field_id", "field_value", "field_name")).alias("_last")
    return (
        history.withColumn("valid_starting_on", F.to_date("updated_at"))
        .groupBy(*KEYS, "valid_starting_on", F.col(cfg.field_grain).alias("_grain"))
        .agg(last)
        .select(*KEYS, "valid_starting_on", "_last.*")
    )


def with_null_marker(history: DataFrame) -> DataFrame:
    """Mark values set to null, so that filling forward does not skip them."""
    return history.withColumn("field_value", F.coalesce("field_value", F.lit(IS_NULL)))


def without_null_marker(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(IS_NULL))


def _pivoted(columns: Mapping[str, str]) -> list[Column]:
    named = {"sprint": "sprint", "sprint_name": "sprint_name", **columns}
    return [
        F.max(F.when(F.lower("field_id") == "status", F.col("field_value"))).alias("status"),
        *[
            F.max(F.when(F.col("field_name") == field, F.col("field_value"))).alias(column)
            for column, field in named.items()
        ],
    ]


def pivot_daily(history: DataFrame, cfg: Config) -> DataFrame:
    """One row per issue and day with a change; null means not changed that day.

    Repartitioned by issue, where at most one row per day and field is left, so
    that the pivot and the windows after it need no shuffle of their own.
    """
    return (
        history.repartition(*KEYS)
        .groupBy(*KEYS, "valid_starting_on")
        .agg(*_pivoted(pivot_columns(cfg, daily=True)))
        .withColumn("valid_starting_at_week", week_start(F.col("valid_starting_on")))
        .withColumn(
            "issue_day_id",
            surrogate_key(F.col("valid_starting_on"), F.col("issue_id"), F.col("source_relation")),
        )
    )


def daily_changes(
    single: DataFrame, multi: DataFrame, field: DataFrame, sprint: DataFrame | None, cfg: Config
) -> DataFrame:
    """From the staged logs to the daily pivot; irrelevant fields go before any shuffle."""
    single = relevant_fields(with_field_name(single, field), cfg, daily=True)
    multi = relevant_fields(with_field_name(multi, field), cfg, daily=True)
    history = combined_history(single, multi, sprint)
    return pivot_daily(with_null_marker(last_value_per_day(history, cfg)), cfg)


def fill_daily(changes: DataFrame, cfg: Config) -> DataFrame:
    """Carry each value forward over the days with changes (at most one row per day)."""
    columns = ["status", *_SPRINT_COLUMNS, *pivot_columns(cfg, daily=True)]
    return along(changes, KEYS, ["valid_starting_on"], fill=columns).withColumnRenamed("status", "status_id")


# --- by instant --------------------------------------------------------------


def pivot_timestamp(history: DataFrame, cfg: Config) -> DataFrame:
    """One row per issue, instant and author."""
    return (
        history.groupBy(*KEYS, "updated_at", "author_id")
        .agg(*_pivoted(pivot_columns(cfg, daily=False)))
        .withColumn("updated_at_week", week_start(F.col("updated_at")))
    )


def timestamp_changes(
    single: DataFrame, multi: DataFrame, field: DataFrame, sprint: DataFrame | None, cfg: Config
) -> DataFrame:
    single = relevant_fields(with_field_name(single, field), cfg, daily=False)
    multi = relevant_fields(with_field_name(multi, field), cfg, daily=False)
    history = combined_history(single, multi, sprint, "author_id")
    return pivot_timestamp(with_null_marker(history), cfg)


def _filled_by_instant(cfg: Config) -> list[str]:
    return ["status", *_SPRINT_COLUMNS, *pivot_columns(cfg, daily=False)]


def fill_timestamp(changes: DataFrame, cfg: Config) -> DataFrame:
    """Carry each value forward over the change instants; ties go by author."""
    return along(changes, KEYS, ["updated_at", "author_id"], fill=_filled_by_instant(cfg))


def filled_periods(changes: DataFrame, cfg: Config) -> DataFrame:
    """The filled states with the period each was valid (no end: it is the current one)."""
    return along(
        changes,
        KEYS,
        ["updated_at", "author_id"],
        fill=_filled_by_instant(cfg),
        lead={"valid_until": "updated_at"},
    ).withColumnsRenamed({"updated_at": "valid_from", "status": "status_id"})


def lookup_exempt(cfg: Config, *, daily: bool) -> set[str]:
    """Columns shown as they are: sprint ids and names, and story points by instant."""
    return {*_SPRINT_COLUMNS, *(() if daily else _STORY_POINTS)}


def drop_segment(df: DataFrame) -> DataFrame:
    return df.drop(SEGMENT)
