"""All tables of a tracker as lazy DataFrames, each built from the ones before."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.functions.dates import require_utc
from fieldtrail.operators import daily, flows, history, instants, issues, metrics, quality, sprints
from fieldtrail.operators.timeline import find_hot, with_segments
from fieldtrail.sources.generations import Commit, Store
from fieldtrail.sources.staging import stage_all
from fieldtrail.sources.tables import read_written, write_table, write_weeks


class Tracker:
    """The tables of one or more issue trackers.

    ``raw`` has the raw tables by name (see ``sources.schemas``). Every attribute is a
    DataFrame that nothing has run yet. :meth:`build` writes the result tables and
    reads shared ones back instead of computing them again.
    """

    #: Result tables and the week column of those stored by week.
    TABLES: dict[str, str | None] = {
        "daily_issue_field_history": "date_week",
        "timestamp_issue_field_history": None,
        "issue_status_transitions": None,
        "issue_enhanced": None,
        "project_enhanced": None,
        "user_enhanced": None,
        "daily_sprint_issue_history": "date_week",
        "sprint_enhanced": None,
    }

    def __init__(self, raw: Mapping[str, DataFrame], cfg: Config | None = None) -> None:
        self.cfg = cfg or Config()
        self.raw = raw
        self.spark = require_utc(raw["issue"].sparkSession)

    # --- staged tables and change logs

    @cached_property
    def staged(self) -> Mapping[str, DataFrame]:
        return stage_all(self.raw, self.cfg)

    @property
    def sprint(self) -> DataFrame | None:
        return self.staged.get("sprint")

    @cached_property
    def single_history(self) -> DataFrame:
        return history.with_field_name(self.staged["issue_field_history"], self.staged["field"])

    @cached_property
    def multi_history(self) -> DataFrame:
        return history.with_field_name(self.staged["issue_multiselect_history"], self.staged["field"])

    def _logs(self):
        s = self.staged
        return s["issue_field_history"], s["issue_multiselect_history"], s["field"], self.sprint

    # --- daily history

    @cached_property
    def daily_changes(self) -> DataFrame:
        return history.daily_changes(*self._logs(), self.cfg)

    @cached_property
    def daily_scd(self) -> DataFrame:
        return history.fill_daily(self.daily_changes, self.cfg)

    @cached_property
    def day_intervals(self) -> DataFrame:
        """Labelled: the compact form of the daily history."""
        intervals = daily.day_intervals(self.daily_scd, self.staged["issue"], self.cfg)
        return daily.labelled_intervals(intervals, self.staged, self.cfg)

    @cached_property
    def daily_issue_field_history(self) -> DataFrame:
        return daily.explode_days(self.day_intervals)

    @cached_property
    def issue_calendar_spine(self) -> DataFrame:
        return daily.issue_calendar_spine(self.daily_changes, self.staged["issue"], self.cfg)

    # --- history by instant

    #: Where to cut the timelines that are too long for one task; set by :meth:`split_long_timelines`.
    hot_issues: DataFrame | None = None

    def split_long_timelines(self, path: str) -> Tracker:
        """Find issues with ``hot_rows`` changes or more and cut their timelines, for what is asked for afterwards.

        An action over the keys of the logs; its result is stored below ``path``. :meth:`build` does it.
        """
        keys = [*history.KEYS, "updated_at"]
        logs = [log.select(*keys) for log in (self.single_history, self.multi_history)]
        self.hot_issues = find_hot(logs[0].unionByName(logs[1]), history.KEYS, "updated_at", self.cfg, path)
        return self

    @cached_property
    def timestamp_changes(self) -> DataFrame:
        changes = history.timestamp_changes(*self._logs(), self.cfg)
        return with_segments(changes, self.hot_issues, history.KEYS, "updated_at")

    @cached_property
    def timestamp_scd(self) -> DataFrame:
        return history.fill_timestamp(self.timestamp_changes, self.cfg)

    @cached_property
    def _timestamp_history(self) -> DataFrame:
        return instants.timestamp_issue_field_history(self.timestamp_changes, self.staged, self.cfg)

    @cached_property
    def timestamp_issue_field_history(self) -> DataFrame:
        return history.drop_segment(self._timestamp_history)

    @cached_property
    def issue_status_transitions(self) -> DataFrame:
        return instants.issue_status_transitions(self._timestamp_history, self.cfg)

    # --- issues

    @cached_property
    def issue_epic(self) -> DataFrame:
        return issues.issue_epic(self.single_history)

    @cached_property
    def issue_type_parents(self) -> DataFrame:
        return issues.issue_type_parents(self.staged["issue"], self.staged["issue_type"], self.issue_epic)

    @cached_property
    def issue_users(self) -> DataFrame:
        return issues.issue_users(self.issue_type_parents, self.staged["user"])

    @cached_property
    def issue_parts(self) -> dict[str, DataFrame]:
        s, cfg = self.staged, self.cfg
        parts = {"assign_resolution": issues.issue_assign_resolution(self.single_history)}
        if cfg.using_versions:
            parts["versions"] = issues.issue_versions(self.multi_history, s["version"])
        if cfg.using_sprints:
            parts["sprint"] = issues.issue_sprint(self.multi_history, s["sprint"])
        if cfg.include_comments:
            parts["comments"] = issues.issue_comments(s["comment"], s["user"], cfg)
        return parts

    @cached_property
    def issue_join(self) -> DataFrame:
        """Each log is read once for all that an issue shows of it."""
        s, cfg = self.staged, self.cfg
        typed = issues.issue_type_parents(s["issue"], s["issue_type"], issues.issue_log_facts(self.single_history))
        parts = {}
        if cfg.using_sprints or cfg.using_versions:
            parts["multi"] = issues.issue_multi_facts(
                self.multi_history,
                s["sprint"] if cfg.using_sprints else None,
                s["version"] if cfg.using_versions else None,
            )
        if cfg.include_comments:
            parts["comments"] = self.issue_parts["comments"]
        return issues.issue_join(issues.issue_users(typed, s["user"]), parts, s, cfg)

    @cached_property
    def issue_enhanced(self) -> DataFrame:
        latest = self.day_intervals.filter("is_latest")
        return issues.issue_enhanced(self.issue_join, latest, self.cfg)

    # --- projects and users

    @cached_property
    def issue_labels(self) -> DataFrame:
        return issues.issue_labels(self.staged["issue"], self.staged)

    @cached_property
    def issue_measures(self) -> DataFrame:
        return issues.issue_measures(self.issue_labels, self.issue_parts["assign_resolution"], self.cfg)

    @cached_property
    def project_measures(self) -> DataFrame:
        return metrics.group_measures(self.issue_measures, users=False)

    @cached_property
    def user_measures(self) -> DataFrame:
        return metrics.group_measures(self.issue_measures, projects=False)

    @cached_property
    def project_metrics(self) -> DataFrame:
        return metrics.project_metrics(self.project_measures)

    @cached_property
    def project_enhanced(self) -> DataFrame:
        return metrics.project_enhanced(self.issue_labels, self.project_metrics, self.staged, self.cfg)

    @cached_property
    def user_metrics(self) -> DataFrame:
        return metrics.user_metrics(self.user_measures)

    @cached_property
    def user_enhanced(self) -> DataFrame:
        return metrics.user_enhanced(self.issue_labels, self.user_metrics, self.staged["user"])

    # --- sprints

    @cached_property
    def assigned_issue(self) -> DataFrame:
        names = self.staged["user"].select(
            "source_relation",
            F.col("user_id").alias("assignee_user_id"),
            F.col("user_display_name").alias("assignee_name"),
        )
        return self.staged["issue"].join(names, ["source_relation", "assignee_user_id"], "left")

    @cached_property
    def daily_sprint_issue_history(self) -> DataFrame:
        return sprints.daily_sprint_issue_history(
            self.day_intervals, self.assigned_issue, self.staged["sprint"], self.cfg
        )

    @cached_property
    def sprint_facts(self) -> DataFrame:
        return sprints.sprint_issue_facts(self.daily_sprint_issue_history, self.cfg)

    @cached_property
    def sprint_enhanced(self) -> DataFrame:
        return sprints.sprint_enhanced(self.sprint_facts, self.cfg)

    # --- analyses

    @cached_property
    def daily_status_category(self) -> DataFrame:
        return flows.daily_status_category(self.day_intervals, self.staged)

    @cached_property
    def cumulative_flow(self) -> DataFrame:
        return flows.cumulative_flow(self._timestamp_history)

    # --- writing

    def build(self, path: str) -> dict[str, DataFrame]:
        """Write all result tables below ``path`` and return them as read back.

        Tables that others need are stored first and stand in for their plans. What was below ``path`` is replaced; the
        daily history and what ``plans.incremental`` continues it from change with one commit.
        """
        path = path.rstrip("/")
        quality.require_unique_ids(self.staged)
        self.split_long_timelines(f"{path}/_shared/timelines")
        store = Store(self.spark, path)
        before = store.current()
        kept = {"daily_changes": store.write(self.daily_changes, "daily_changes", "valid_starting_at_week")}
        self.__dict__["daily_changes"] = store.read(kept["daily_changes"], "daily_changes")
        for name in ("day_intervals", "_timestamp_history"):
            target = f"{path}/_shared/{name.lstrip('_')}"
            write_table(getattr(self, name), target)
            self.__dict__[name] = read_written(getattr(self, name), target)
        kept["issue_calendar"] = store.write(daily.calendar_ends(self.day_intervals), "issue_calendar")
        kept["daily_issue_field_history"] = store.write(self.daily_issue_field_history, "daily_issue_field_history", "date_week")
        # Without a state, the next incremental run makes one of the changes before its cut.
        store.commit(Commit(before.number), kept)
        store.clean()
        written = {}
        for name, week in self.TABLES.items():
            if name in ("daily_sprint_issue_history", "sprint_enhanced") and not self.cfg.using_sprints:
                continue
            df = getattr(self, name)
            if name in kept:
                written[name] = self.__dict__[name] = store.read(kept[name], name)
                continue
            if week:
                write_weeks(df, f"{path}/{name}", week)
            else:
                write_table(df, f"{path}/{name}")
            written[name] = self.__dict__[name] = read_written(df, f"{path}/{name}")
            if name == "issue_enhanced":
                for shared in ("issue_labels", "issue_measures", "assigned_issue"):
                    self.__dict__[shared] = written[name]
                # Projects and users read their numbers from one table, so that issues are read once for both.
                target = f"{path}/_shared/group_measures"
                measures = metrics.group_measures(self.issue_measures)
                write_table(measures, target)
                for shared in ("project_measures", "user_measures"):
                    self.__dict__[shared] = read_written(measures, target)
        return written
