"""Columns of the raw tables and their names after staging."""

from __future__ import annotations

from dataclasses import dataclass

# The columns a replicated issue tracker delivers.
RAW_COLUMNS: dict[str, str] = {
    "comment": "_synced timestamp, author_id string, body string, created timestamp, id long, "
    "is_public boolean, issue_id long, update_author_id string, updated timestamp",
    "component": "_synced timestamp, description string, id long, name string, project_id long",
    "field": "_synced timestamp, id string, is_array boolean, is_custom boolean, name string",
    "field_option": "_synced timestamp, id long, parent_id long, name string",
    "issue": "_deleted boolean, _synced timestamp, _original_estimate double, "
    "_remaining_estimate double, _time_spent double, assignee string, created timestamp, "
    "creator string, description string, due_date date, environment string, id long, "
    "issue_type long, work_type long, key string, original_estimate double, parent_id long, "
    "priority long, project long, remaining_estimate double, reporter string, resolution long, "
    "resolved timestamp, status long, status_category_changed timestamp, summary string, "
    "time_spent double, updated timestamp, work_ratio double",
    "issue_field_history": "_synced timestamp, field_id string, issue_id long, value string, "
    "is_active boolean, author_id string, time timestamp",
    "issue_link": "_synced timestamp, issue_id long, related_issue_id long, relationship string",
    "issue_multiselect_history": "_row_id string, _synced timestamp, field_id string, "
    "issue_id long, value string, is_active boolean, author_id string, time timestamp",
    "issue_type": "_synced timestamp, description string, id long, name string, subtask boolean",
    "priority": "_synced timestamp, description string, id long, name string",
    "project": "_synced timestamp, description string, id long, key string, lead_id string, "
    "name string, permission_scheme_id long, project_category_id long",
    "resolution": "_synced timestamp, description string, id long, name string",
    "sprint": "_deleted boolean, _synced timestamp, board_id long, complete_date timestamp, "
    "end_date timestamp, id long, name string, start_date timestamp",
    "status": "_synced timestamp, description string, id long, name string, status_category_id long",
    "status_category": "_synced timestamp, id long, name string",
    "team": "_synced timestamp, id string, is_shared boolean, is_visible boolean, name string, title string",
    "user": "_synced timestamp, email string, id string, locale string, name string, "
    "time_zone string, username string, is_active boolean",
    "version": "_synced timestamp, archived boolean, description string, id long, name string, "
    "overdue boolean, project_id long, release_date date, released boolean, start_date date",
}


@dataclass(frozen=True)
class Staged:
    """How a raw table becomes a staged one. Columns not named keep their name."""

    rename: dict[str, str]
    drop: tuple[str, ...] = ()
    #: staged column -> raw columns, first non-null wins
    fallback: tuple[tuple[str, tuple[str, ...]], ...] = ()
    #: raw column -> type, where the staged type differs
    cast: tuple[tuple[str, str], ...] = ()


#: The names that staged columns have by definition.
STAGED: dict[str, Staged] = {
    "comment": Staged(
        {"author_id": "author_user_id", "created": "created_at", "id": "comment_id",
         "update_author_id": "last_update_user_id", "updated": "last_updated_at"}
    ),
    "component": Staged({"description": "component_description", "id": "component_id", "name": "component_name"}),
    "field": Staged({"id": "field_id", "name": "field_name"}),
    "field_option": Staged(
        {"id": "field_id", "parent_id": "parent_field_id", "name": "field_option_name"}, drop=("_synced",)
    ),
    "issue": Staged(
        {"assignee": "assignee_user_id", "created": "created_at", "resolved": "resolved_at",
         "creator": "creator_user_id", "description": "issue_description", "id": "issue_id",
         "key": "issue_key", "parent_id": "parent_issue_id", "priority": "priority_id",
         "project": "project_id", "reporter": "reporter_user_id", "resolution": "resolution_id",
         "status": "status_id", "status_category_changed": "status_changed_at",
         "summary": "issue_name", "updated": "updated_at"},
        drop=("_deleted",),
        fallback=(
            ("original_estimate_seconds", ("original_estimate", "_original_estimate")),
            ("remaining_estimate_seconds", ("remaining_estimate", "_remaining_estimate")),
            ("time_spent_seconds", ("time_spent", "_time_spent")),
            ("issue_type_id", ("work_type", "issue_type")),
        ),
    ),
    "issue_field_history": Staged({"time": "updated_at", "value": "field_value"}),
    "issue_link": Staged({}),
    "issue_multiselect_history": Staged({"time": "updated_at", "value": "field_value"}),
    "issue_type": Staged({"id": "issue_type_id", "name": "issue_type_name", "subtask": "is_subtask"}),
    "priority": Staged({"description": "priority_description", "id": "priority_id", "name": "priority_name"}),
    "project": Staged(
        {"description": "project_description", "id": "project_id", "key": "project_key",
         "lead_id": "project_lead_user_id", "name": "project_name"}
    ),
    "resolution": Staged(
        {"description": "resolution_description", "id": "resolution_id", "name": "resolution_name"}
    ),
    "sprint": Staged(
        {"id": "sprint_id", "name": "sprint_name", "complete_date": "completed_at",
         "end_date": "ended_at", "start_date": "started_at"},
        drop=("_deleted",),
    ),
    "status": Staged({"description": "status_description", "id": "status_id", "name": "status_name"}),
    "status_category": Staged(
        {"id": "status_category_id", "name": "status_category_name"}, drop=("_synced",)
    ),
    "team": Staged(
        {"id": "team_id", "is_shared": "is_shared_team", "is_visible": "is_visible_team",
         "name": "team_name", "title": "team_title"}
    ),
    "user": Staged({"id": "user_id", "name": "user_display_name"}),
    "version": Staged(
        {"archived": "is_archived", "id": "version_id", "name": "version_name",
         "overdue": "is_overdue", "released": "is_released"},
        drop=("_synced",),
        cast=(("release_date", "timestamp"), ("start_date", "timestamp")),
    ),
}

#: Tables a site may lack, and the setting that says so.
OPTIONAL_TABLES: dict[str, str] = {
    "component": "using_components",
    "priority": "using_priorities",
    "sprint": "using_sprints",
    "team": "using_teams",
    "version": "using_versions",
    "comment": "include_comments",
}
