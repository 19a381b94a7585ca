"""The state of each issue between two changes, and its moves between statuses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.functions.dates import seconds_between
from fieldtrail.functions.text import instant_text, surrogate_key
from fieldtrail.operators.history import (
    KEYS,
    filled_periods,
    history_columns,
    lookup_exempt,
    without_null_marker,
)
from fieldtrail.operators.lookups import resolve_labels, with_status
from fieldtrail.operators.timeline import SEGMENT, along

TO_DO, IN_PROGRESS, DONE = "To Do", "In Progress", "Done"


def timestamp_issue_field_history(changes: DataFrame, staged: Mapping[str, DataFrame], cfg: Config) -> DataFrame:
    """One row per issue and change (and author), with the state from then on.

    ``changes`` is the pivot by instant.
    """
    columns = history_columns(cfg, daily=False)
    exempt = lookup_exempt(cfg, daily=False)
    segment = [SEGMENT] if SEGMENT in changes.columns else []
    shown = filled_periods(changes, cfg).select(
        *KEYS,
        *segment,
        "valid_from",
        F.coalesce("valid_until", cfg.now()).alias("valid_until"),
        F.col("valid_until").isNull().alias("is_current_record"),
        "updated_at_week",
        "author_id",
        "status_id",
        *[without_null_marker(c).alias(c) for c in columns],
    )
    labelled = resolve_labels(
        with_status(shown, staged, category=True), [c for c in columns if c not in exempt], staged, cfg
    )
    key = surrogate_key(instant_text(F.col("valid_from")), F.col("issue_id"), F.col("source_relation"))
    return labelled.withColumn("issue_timestamp_id", key)


def with_previous_status(history: DataFrame) -> DataFrame:
    return along(history, KEYS, ["valid_from", "author_id"], lag={"previous_status": "status"})


def is_status_change() -> Column:
    """Whether the status differs from the row before.

    A row whose previous status is null counts; a null status after a known one does not.
    """
    previous = F.col("previous_status")
    return previous.isNull() | (previous != F.col("status"))


def status_changes_only(history: DataFrame) -> DataFrame:
    """The rows at which the status changes."""
    segment = [SEGMENT] if SEGMENT in history.columns else []
    rows = history.select(*KEYS, *segment, "status", "status_category_name", "valid_from", "author_id")
    return with_previous_status(rows).filter(is_status_change())


def status_periods(changes: DataFrame, cfg: Config) -> DataFrame:
    """How long each status lasted: to the next status change, or until now."""
    return (
        along(changes, KEYS, ["valid_from", "author_id"], lead={"_next": "valid_from"})
        .withColumn("valid_until", F.coalesce("_next", cfg.now()))
        .withColumn("is_current_status", F.col("_next").isNull())
        .withColumn("seconds_in_status", seconds_between(F.col("valid_from"), F.col("valid_until")))
        .drop("_next")
    )


def status_transitions(periods: DataFrame) -> DataFrame:
    """Number the statuses of an issue and look back at the previous one."""
    rows = periods.withColumnsRenamed({"valid_from": "transition_at", "valid_until": "transition_until"})
    return along(
        rows,
        KEYS,
        ["transition_at", "author_id"],
        lag={
            "previous_status_category_name": "status_category_name",
            "previous_transition_at": "transition_at",
            "seconds_in_previous_status": "seconds_in_status",
        },
        number="status_sequence",
    )


def transition_direction(transitions: DataFrame) -> DataFrame:
    """Minutes per status and whether the move went forward or backward in the workflow."""
    rank = {TO_DO: 0, IN_PROGRESS: 1, DONE: 2}

    def rank_of(column: str):
        ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
        return F.try_element_at(ranks, F.col(column))

    def minutes(column: str):
        return F.round(F.col(column).cast("decimal(28,6)") / 60, 2)

    before, after = rank_of("previous_status_category_name"), rank_of("status_category_name")
    return transitions.select(
        *KEYS,
        *([SEGMENT] if SEGMENT in transitions.columns else []),
        "status",
        "status_category_name",
        "previous_status",
        "previous_status_category_name",
        "transition_at",
        "transition_until",
        "status_sequence",
        "is_current_status",
        minutes("seconds_in_status").alias("minutes_in_status"),
        minutes("seconds_in_previous_status").alias("minutes_in_previous_status"),
        F.when(F.col("previous_status_category_name").isNull(), "new")
        .when(after > before, "forward")
        .when(after < before, "backward")
        .when(F.col("previous_status_category_name") == F.col("status_category_name"), "lateral")
        .otherwise("other")
        .alias("transition_direction"),
    )


def issue_status_transitions(history: DataFrame, cfg: Config) -> DataFrame:
    """The steps above with all windows over the status changes taken at once.

    A status lasts until the next one starts, so the time in the previous status
    needs no window of its own.
    """
    steps = along(
        status_changes_only(history),
        KEYS,
        ["valid_from", "author_id"],
        lead={"_next": "valid_from"},
        lag={"previous_status_category_name": "status_category_name", "_previous": "valid_from"},
        number="status_sequence",
    )
    start, until = F.col("valid_from"), F.coalesce("_next", cfg.now())
    return transition_direction(
        steps.withColumns(
            {
                "transition_at": start,
                "transition_until": until,
                "is_current_status": F.col("_next").isNull(),
                "seconds_in_status": seconds_between(start, until),
                "seconds_in_previous_status": seconds_between(F.col("_previous"), start),
            }
        )
    ).drop(SEGMENT)
