"""The state of each issue on each day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.functions.dates import week_start
from fieldtrail.functions.text import surrogate_key
from fieldtrail.operators.history import (
    KEYS,
    history_columns,
    lookup_exempt,
    without_null_marker,
)
from fieldtrail.operators.lookups import resolve_labels, with_status


def _issue_dates(issue: DataFrame) -> DataFrame:
    return issue.select(*KEYS, F.to_date("created_at").alias("created_on"), F.col("resolved_at").isNull().alias("is_open"))


def issue_calendar_spine(changes: DataFrame, issue: DataFrame, cfg: Config) -> DataFrame:
    """One row per issue and day, from its creation to today or, once resolved, to its
    last change plus the buffer.

    ``earliest_open_until_date`` is the earliest change day whose buffer still covers
    the day. Buffers end in the order of the change days, so each change day owns the
    days after the previous buffer's end, and one ``sequence`` per change day yields
    the spine without a range join.
    """
    in_order = Window.partitionBy(*KEYS).orderBy("open_until")
    buffered = F.add_months("open_until", cfg.history_buffer_months)
    return (
        changes.select(*KEYS, "valid_starting_on")
        .join(_issue_dates(issue).filter(F.col("created_on").isNotNull()), KEYS)
        .withColumn("open_until", F.when(F.col("is_open"), cfg.today()).otherwise(F.col("valid_starting_on")))
        .select(*KEYS, "created_on", "open_until")
        .distinct()
        .withColumn("_from", F.date_add(F.lag(buffered).over(in_order), 1))
        .withColumn("_from", F.greatest("created_on", "_from"))
        .withColumn("_to", F.least(buffered, cfg.today()))
        .filter(F.col("_from") <= F.col("_to"))
        .select(
            F.explode(F.sequence("_from", "_to")).alias("date_day"),
            *KEYS,
            F.col("open_until").alias("earliest_open_until_date"),
        )
        .withColumn("earliest_open_until_week", week_start(F.col("earliest_open_until_date")))
        .withColumn("issue_day_id", surrogate_key(F.col("date_day"), F.col("issue_id"), F.col("source_relation")))
    )


def day_intervals(filled: DataFrame, issue: DataFrame, cfg: Config) -> DataFrame:
    """The filled change rows with the days ``from_day`` .. ``to_day`` they stand for.

    The intervals of an issue cover its calendar (see :func:`issue_calendar_spine`)
    without gap or overlap; days before its first change in the calendar have null
    values. ``is_latest`` marks the interval of the last day. Later steps work on
    these few rows and multiply them to days only where days are the result.
    """
    days = Window.partitionBy(*KEYS).orderBy("valid_starting_on")
    day = F.col("valid_starting_on")
    rows = (
        filled.drop("issue_day_id", "valid_starting_at_week")
        .withColumns(
            {
                "_next": F.lead("valid_starting_on").over(days),
                "_previous": F.lag("valid_starting_on").over(days),
                "_last": F.max("valid_starting_on").over(Window.partitionBy(*KEYS)),
            }
        )
        .join(_issue_dates(issue).filter(F.col("created_on").isNotNull()), KEYS)
        .withColumn(
            "_end",
            F.when(F.col("is_open"), cfg.today()).otherwise(
                F.least(F.add_months("_last", cfg.history_buffer_months), cfg.today())
            ),
        )
    )
    created, end = F.col("created_on"), F.col("_end")
    in_calendar = day >= created
    until_next = F.least(F.coalesce(F.date_sub("_next", 1), end), end)
    first_shown = in_calendar & (F.col("_previous").isNull() | (F.col("_previous") < created))
    never_shown = ~in_calendar & F.col("_next").isNull()
    # Days before the first change of the calendar, or all of them if it has none.
    gap_to = F.when(first_shown, F.least(F.date_sub(day, 1), end)).when(never_shown, end)

    def piece(start, stop, shown: bool):
        return F.struct(start.alias("from_day"), stop.alias("to_day"), F.lit(shown).alias("_shown"))

    pieces = F.array(
        piece(created, gap_to, False),
        piece(F.when(in_calendar, day), until_next, True),
    )
    hidden = {"_next", "_previous", "_last", "_end", "created_on", "is_open", "valid_starting_on"}
    values = [c for c in rows.columns if c not in hidden and c not in KEYS]
    return (
        rows.withColumn("_piece", F.explode(F.filter(pieces, lambda p: p["from_day"] <= p["to_day"])))
        .select(
            *KEYS,
            "_piece.from_day",
            "_piece.to_day",
            (F.col("_piece.to_day") == end).alias("is_latest"),
            *[F.expr(f"case when _piece._shown then `{c}` end").alias(c) for c in values],
        )
    )


def calendar_ends(intervals: DataFrame) -> DataFrame:
    """First and last day of each issue in the daily history."""
    return intervals.groupBy(*KEYS).agg(F.min("from_day").alias("first"), F.max("to_day").alias("last"))


def labelled_intervals(intervals: DataFrame, staged: Mapping[str, DataFrame], cfg: Config) -> DataFrame:
    """Replace ids by labels and the null marker by null."""
    columns = history_columns(cfg, daily=True)
    exempt = lookup_exempt(cfg, daily=True)
    shown = intervals.select(
        *KEYS,
        "from_day",
        "to_day",
        "is_latest",
        *[without_null_marker(c).alias(c) for c in ["status_id", *columns]],
    )
    return with_status(resolve_labels(shown, [c for c in columns if c not in exempt], staged, cfg), staged)


def explode_days(intervals: DataFrame) -> DataFrame:
    """One row per day of each interval, with week and key."""
    values = [c for c in intervals.columns if c not in ("from_day", "to_day", "is_latest")]
    return (
        intervals.select(*values, F.explode(F.sequence("from_day", "to_day")).alias("date_day"))
        .withColumn("date_week", week_start(F.col("date_day")))
        .withColumn("issue_day_id", surrogate_key(F.col("date_day"), F.col("issue_id"), F.col("source_relation")))
    )


def daily_issue_field_history(
    filled: DataFrame, issue: DataFrame, staged: Mapping[str, DataFrame], cfg: Config
) -> DataFrame:
    return explode_days(labelled_intervals(day_intervals(filled, issue, cfg), staged, cfg))


def latest_history_row(daily: DataFrame) -> DataFrame:
    """The last daily row of each issue."""
    rest = [c for c in daily.columns if c not in KEYS]
    return (
        daily.groupBy(*KEYS)
        .agg(F.max_by(F.struct(*rest), "date_day").alias("_row"))
        .select(*KEYS, "_row.*")
    )
