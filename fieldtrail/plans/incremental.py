"""Rebuilding only the recent weeks of the daily history."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.operators import daily, history
from fieldtrail.plans.model import Tracker
from fieldtrail.sources.generations import Commit, Store, Table

SAFE_START = date(2010, 1, 1)


def monday(day: date) -> date:
    return day - timedelta(days=day.weekday())


def week_cut(weeks: list[date], cfg: Config) -> date:
    """The Monday from which to rebuild: the last stored week less the lookback.

    A table without weeks counts from a date before all changes.
    """
    return monday(weeks[-1] if weeks else SAFE_START) - timedelta(weeks=cfg.lookback_weeks)


def state_rows(changes: DataFrame, cfg: Config) -> DataFrame:
    """The state of each issue after ``changes``, in the form of one change row.

    Per column the last change: an aggregate that combines before its shuffle. Ids and null markers stay as stored, so
    filling goes on as if never cut. A state is a change row itself, so later changes can be added to it.
    """
    columns = ["status", "sprint", "sprint_name", *history.pivot_columns(cfg, daily=True)]
    day = F.col("valid_starting_on")
    return changes.groupBy(*history.KEYS).agg(
        F.max(day).alias("valid_starting_on"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), day)).alias(c) for c in columns],
    )


def earliest_difference(before: DataFrame, now: DataFrame) -> date | None:
    """The earliest day that an issue has in one of two calendars only, as after a late resolution or a deletion."""
    old = before.withColumnsRenamed({"first": "old_first", "last": "old_last"})
    both = old.join(now, history.KEYS, "full_outer")
    one_sided = F.coalesce("old_first", "first")
    day = (
        F.when(F.col("old_first").isNull() | F.col("first").isNull(), one_sided)
        .when(F.col("old_first") != F.col("first"), F.least("old_first", "first"))
        # The day after the earlier end; that end itself is no longer, or not yet, the last day.
        .when(F.col("old_last") != F.col("last"), F.least("old_last", "last"))
    )
    return both.agg(F.min(day)).first()[0]


def daily_from(tracker: Tracker, intervals: DataFrame, cut: date | None) -> DataFrame:
    """Daily rows of the weeks from ``cut`` on (None: of all)."""
    if cut is not None:
        intervals = intervals.filter(F.col("to_day") >= F.lit(cut)).withColumn(
            "from_day", F.greatest("from_day", F.lit(cut))
        )
    return daily.explode_days(daily.labelled_intervals(intervals, tracker.staged, tracker.cfg))


DAILY, CHANGES, STATE, CALENDAR = "daily_issue_field_history", "daily_changes", "issue_state", "issue_calendar"


def read_daily(spark: SparkSession, path: str) -> DataFrame | None:
    """The daily history that was last committed below ``path``; None before the first run."""
    store = Store(spark, path)
    table = store.current().tables.get(DAILY)
    return None if table is None else store.read(table, DAILY)


def state_at(store: Store, before: Commit, cut: date, cfg: Config) -> Table:
    """The state of all issues just before ``cut``: the stored one with the stored changes that have come between.

    Only if the cut has moved back, as with a longer lookback, all earlier changes are read again.
    """
    at = date.fromisoformat(before.notes["state_cut"]) if STATE in before.tables else None
    changes = before.tables[CHANGES]
    if at == cut:
        return before.tables[STATE]
    if at is None or at > cut:
        rows = store.read(changes, CHANGES, until=cut).drop("valid_starting_at_week", "issue_day_id")
    else:
        rows = store.read(changes, CHANGES, since=at, until=cut).drop("valid_starting_at_week", "issue_day_id")
        rows = store.read(before.tables[STATE], STATE).unionByName(rows)
    return store.write(state_rows(rows, cfg), STATE)


def update_daily(tracker: Tracker, path: str) -> DataFrame:
    """Bring the stored daily history up to date and return it.

    The first run builds everything. Later runs read the change logs of the last weeks, the state of each issue before
    them (one row per issue) and no older changes, and replace the weeks from the cut on. When the calendar of an issue
    has changed further back (it was resolved, reopened, deleted or added without a recent change), the run goes back to
    there and reads the stored changes before that week once. A change that arrives in the logs later than the lookback
    needs a full build.

    All tables change with one commit; a run that fails leaves what was there before (see ``sources.generations``).
    """
    store, cfg = Store(tracker.spark, path), tracker.cfg
    before = store.current()
    weeks = before.weeks(DAILY)
    cut = week_cut(weeks, cfg) if weeks else None
    since = F.lit(True) if cut is None else F.col("updated_at") >= F.lit(cut).cast("timestamp")
    s = tracker.staged
    fresh = history.daily_changes(
        s["issue_field_history"].filter(since),
        s["issue_multiselect_history"].filter(since),
        s["field"],
        tracker.sprint,
        cfg,
    )
    changes = store.write(fresh, CHANGES, "valid_starting_at_week")
    tables, notes = {}, {}
    if cut is not None:
        tables[STATE], notes["state_cut"] = state_at(store, before, cut, cfg), cut.isoformat()
        changes = Table(changes.schema, changes.week, before.tables[CHANGES].before(cut) | changes.folders)
    tables[CHANGES] = changes

    def intervals(start: date | None) -> DataFrame:
        rows = store.read(changes, CHANGES, since=start).drop("valid_starting_at_week", "issue_day_id")
        if start is not None:
            if start == cut:
                state = store.read(tables[STATE], STATE)
            else:
                state = state_rows(store.read(changes, CHANGES, until=start), cfg)
            rows = state.unionByName(rows)
        return daily.day_intervals(history.fill_daily(rows, cfg), s["issue"], cfg)

    tables[CALENDAR] = store.write(daily.calendar_ends(intervals(cut)), CALENDAR)
    start = cut
    if cut is not None:
        now = store.read(tables[CALENDAR], CALENDAR)
        changed = earliest_difference(store.read(before.tables[CALENDAR], CALENDAR), now)
        start = min(cut, monday(changed)) if changed else cut
    made = store.write(daily_from(tracker, intervals(start), start), DAILY, "date_week")
    older = before.tables[DAILY].before(start) if start is not None else {}
    tables[DAILY] = Table(made.schema, made.week, older | made.folders)
    after = store.commit(before, tables, notes)
    store.clean()
    return store.read(after.tables[DAILY], DAILY)
