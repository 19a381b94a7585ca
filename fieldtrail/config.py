"""Settings of a run: which fields to track, which source tables exist, and "now"."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def _utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


@dataclass(frozen=True)
class Config:
    #: Names of the fields to turn into history columns, besides status and sprint.
    history_columns: tuple[str, ...] = ()
    #: What counts as "the same field": ``field_id`` or ``field_name``.
    field_grain: str = "field_id"
    #: Months of daily rows kept after the last change of a resolved issue.
    history_buffer_months: int = 1
    #: Weeks rebuilt by an incremental run to catch late changes.
    lookback_weeks: int = 1

    using_sprints: bool = True
    using_components: bool = True
    using_versions: bool = True
    using_priorities: bool = True
    using_teams: bool = True
    include_comments: bool = True
    include_conversations: bool = True
    #: Longer conversations show a fixed sentence instead of their text; by default none does.
    conversation_char_limit: int | None = None
    #: One row per sprint and team; otherwise one per sprint.
    sprint_include_teams: bool = True
    #: Keep the letter case of source names in ``source_relation``.
    preserve_source_case: bool = False
    #: Raw column name -> name this library expects (for example another
    #: replication tool's name of ``_deleted``).
    column_aliases: Mapping[str, str] = field(default_factory=dict)

    #: The instant every "now" refers to, as UTC text; fixed when the run starts.
    as_of: str = field(default_factory=_utc_now)

    #: An issue with at least this many changes is split over several tasks.
    hot_rows: int = 5_000_000

    def __post_init__(self) -> None:
        if self.field_grain not in ("field_id", "field_name"):
            raise ValueError(f"field_grain must be field_id or field_name, not {self.field_grain!r}")
        object.__setattr__(self, "history_columns", tuple(self.history_columns))

    def now(self) -> Column:
        return F.lit(self.as_of).cast("timestamp")

    def today(self) -> Column:
        return self.now().cast("date")

    def with_(self, **changes) -> "Config":
        return replace(self, **changes)

    def tracks(self, name: str) -> bool:
        return name in {c.lower() for c in self.history_columns}
