"""The expected results as DuckDB SQL, written from the definitions.

Deliberately different from the Spark side: range join for the calendar, batch
numbers for filling forward, one row per day wherever days matter.
"""

from __future__ import annotations

import re

from fixtures.views import AS_OF, RAW_VIEWS

NOW = f"timestamp '{AS_OF}'"
TODAY = f"date '{AS_OF[:10]}'"

#: Column -> field name of the tracked fields in the test configuration.
TRACKED = {
    "team": "team",
    "assignee": "assignee",
    "components": "components",
    "project": "project",
    "quarter": "quarter",
    "story_points": "story points",
}
VALUES = ["sprint", "sprint_name", *TRACKED]

# The names of raw, staged and result columns, and the texts in results, are those of the interface.
CTES: dict[str, str] = {f"raw_{name}": sql for name, sql in RAW_VIEWS.items()}

# --- staging -----------------------------------------------------------------

_NO_SYNC = "cast(null as timestamp) as _synced"
CTES |= {
    "stg_issue": """select '' as source_relation,
        coalesce(original_estimate, _original_estimate) as original_estimate_seconds,
        coalesce(remaining_estimate, _remaining_estimate) as remaining_estimate_seconds,
        coalesce(time_spent, _time_spent) as time_spent_seconds, assignee as assignee_user_id,
        created as created_at, resolved as resolved_at, creator as creator_user_id,
        description as issue_description, due_date, environment, id as issue_id,
        cast(coalesce(work_type, issue_type) as bigint) as issue_type_id, key as issue_key,
        parent_id as parent_issue_id, priority as priority_id, project as project_id,
        reporter as reporter_user_id, cast(resolution as bigint) as resolution_id, status as status_id,
        status_category_changed as status_changed_at, summary as issue_name, updated as updated_at,
        work_ratio, _synced from raw_issue where not _deleted""",
    "stg_issue_field_history": """select '' as source_relation, field_id, issue_id, time as updated_at,
        value as field_value, author_id, is_active, _synced from raw_issue_field_history""",
    "stg_issue_multiselect_history": """select '' as source_relation, _row_id, field_id, issue_id,
        time as updated_at, value as field_value, author_id, is_active, _synced
        from raw_issue_multiselect_history""",
    "stg_field": f"""select '' as source_relation, id as field_id, is_array, is_custom, name as field_name,
        {_NO_SYNC} from raw_field""",
    "stg_field_option": """select '' as source_relation, cast(id as bigint) as field_id,
        cast(null as bigint) as parent_field_id, name as field_option_name from raw_field_option""",
    "stg_status": f"""select '' as source_relation, description as status_description,
        cast(id as bigint) as status_id, name as status_name,
        cast(status_category_id as bigint) as status_category_id, {_NO_SYNC} from raw_status""",
    "stg_status_category": """select '' as source_relation, cast(id as bigint) as status_category_id,
        name as status_category_name from raw_status_category""",
    "stg_issue_type": f"""select '' as source_relation, cast(null as varchar) as description,
        cast(id as bigint) as issue_type_id, name as issue_type_name, subtask as is_subtask, {_NO_SYNC}
        from raw_issue_type""",
    "stg_priority": f"""select '' as source_relation, cast(null as varchar) as priority_description,
        cast(id as bigint) as priority_id, name as priority_name, {_NO_SYNC} from raw_priority""",
    "stg_resolution": f"""select '' as source_relation, description as resolution_description,
        cast(id as bigint) as resolution_id, name as resolution_name, {_NO_SYNC} from raw_resolution""",
    "stg_project": f"""select '' as source_relation, description as project_description,
        cast(id as bigint) as project_id, key as project_key, lead_id as project_lead_user_id,
        name as project_name, cast(project_category_id as bigint) as project_category_id,
        cast(null as bigint) as permission_scheme_id, {_NO_SYNC} from raw_project""",
    "stg_team": f"""select '' as source_relation, id as team_id, is_shared as is_shared_team,
        is_visible as is_visible_team, name as team_name, title as team_title, {_NO_SYNC} from raw_team""",
    "stg_component": f"""select '' as source_relation, description as component_description,
        id as component_id, name as component_name, project_id, {_NO_SYNC} from raw_component""",
    "stg_version": """select '' as source_relation, archived as is_archived, description,
        id as version_id, name as version_name, cast(null as boolean) as is_overdue, project_id,
        cast(release_date as timestamp) as release_date, released as is_released,
        cast(start_date as timestamp) as start_date from raw_version""",
    "stg_user": f"""select '' as source_relation, email, id as user_id, locale, name as user_display_name,
        time_zone, username, is_active, {_NO_SYNC} from raw_user""",
    "stg_sprint": f"""select '' as source_relation, cast(id as bigint) as sprint_id, name as sprint_name,
        cast(board_id as bigint) as board_id, complete_date as completed_at, end_date as ended_at,
        start_date as started_at, {_NO_SYNC} from raw_sprint where not _deleted""",
    "stg_comment": f"""select '' as source_relation, author_id as author_user_id, body,
        created as created_at, id as comment_id, issue_id, is_public,
        update_author_id as last_update_user_id, updated as last_updated_at, {_NO_SYNC} from raw_comment""",
    "stg_issue_link": f"""select '' as source_relation, issue_id, related_issue_id, relationship, {_NO_SYNC}
        from raw_issue_link""",
}

# --- history -----------------------------------------------------------------


def _pivot_list(tracked: dict[str, str]) -> str:
    fields = {"sprint": "sprint", "sprint_name": "sprint_name", **tracked}
    return ", ".join(
        f"max(case when field_name = '{f}' then field_value end) as {c}" for c, f in fields.items()
    )


def _filled(source: str, columns: list[str], order: str, keep: str) -> str:
    """The last value of each column up to a row."""
    so_far = f"over (partition by source_relation, issue_id order by {order} rows unbounded preceding)"
    values = ", ".join(f"last_value({c} ignore nulls) {so_far} as f_{c}" for c in columns)
    return f"select {keep}, {values} from {source}"


_RELEVANT = "lower(field_id) = 'status' or field_name in ('sprint', 'sprint_name', {})"


def _in_list(tracked: dict[str, str]) -> str:
    return ", ".join(f"'{f}'" for f in tracked.values())


def _history(prefix: str, tracked: dict[str, str], grain: str = "field_id", sprints: bool = True) -> dict[str, str]:
    """The chain from change log to daily history for one configuration."""
    values = ["sprint", "sprint_name", *tracked]
    named = (
        """ union all select 'sprint_field', 'sprint_name', m.issue_id, m.source_relation, m.updated_at,
            m.author_id, coalesce(s.sprint_name, m.field_value)
        from x_multi m left join stg_sprint s
            on cast(s.sprint_id as varchar) = m.field_value and s.source_relation = m.source_relation
        where m.field_name = 'sprint'"""
        if sprints
        else ""
    )
    ctes = {
        f"{prefix}_multi_all": "select field_id, field_name, issue_id, source_relation, updated_at, author_id,"
        f" field_value from x_multi{named}",
        f"{prefix}_batch_day": f"""select field_id, field_name, issue_id, source_relation, updated_at,
            string_agg(field_value, ', ' order by field_value) as field_value
            from {prefix}_multi_all group by all""",
        f"{prefix}_long_day": f"""select field_id, field_name, issue_id, source_relation, updated_at, field_value
            from x_single union all
            select field_id, field_name, issue_id, source_relation, updated_at, field_value
            from {prefix}_batch_day""",
        f"{prefix}_relevant_day": f"select * from {prefix}_long_day where {_RELEVANT.format(_in_list(tracked))}",
        f"{prefix}_last_day": f"""select *, cast(updated_at as date) as valid_starting_on from (
            select *, row_number() over (partition by source_relation, issue_id, {grain}, cast(updated_at as date)
                order by updated_at desc, field_id desc, field_value desc nulls last) as rn
            from {prefix}_relevant_day) where rn = 1""",
        f"{prefix}_pivot_day": f"""select source_relation, issue_id, valid_starting_on,
            max(case when lower(field_id) = 'status' then field_value end) as status, {_pivot_list(tracked)}
            from (select * replace (coalesce(field_value, '-is_null') as field_value) from {prefix}_last_day)
            group by all""",
        f"{prefix}_scd_day": _filled(
            f"{prefix}_pivot_day",
            ["status", *values],
            "valid_starting_on",
            "source_relation, issue_id, valid_starting_on",
        ),
        f"{prefix}_open_until": f"""select h.source_relation, h.issue_id, cast(i.created_at as date) as created_on,
            case when i.resolved_at is null then {TODAY} else h.valid_starting_on end as open_until
            from {prefix}_pivot_day h
            left join stg_issue i on i.issue_id = h.issue_id and i.source_relation = h.source_relation""",
        # Per issue its days on which it may end; then every day up to the last of them and a month.
        f"{prefix}_spine": f"""select date_day, issue_id, source_relation,
            list_min(list_filter(ends, lambda u: cast(u + interval 1 month as date) >= date_day)) as earliest
            from (select *, cast(unnest(generate_series(cast(created_on as timestamp),
                    cast(least(cast(list_max(ends) + interval 1 month as date), {TODAY}) as timestamp), interval 1 day))
                    as date) as date_day
                from (select source_relation, issue_id, created_on, list(distinct open_until) as ends
                    from {prefix}_open_until group by all))""",
        f"{prefix}_filled_day": "select date_day, issue_id, source_relation, "
        + ", ".join(
            f"last_value(f_{c} ignore nulls) over (partition by source_relation, issue_id order by date_day"
            f" rows unbounded preceding) as {c}"
            for c in ["status", *values]
        )
        + f""" from (select s.date_day, s.issue_id, s.source_relation, {', '.join('h.f_' + c for c in ['status', *values])}
            from {prefix}_spine s left join {prefix}_scd_day h on h.issue_id = s.issue_id
            and h.source_relation = s.source_relation and h.valid_starting_on = s.date_day)""",
    }
    return ctes


_LOOKUPS = {
    "components": ("stg_component", "component_id", "component_name"),
    "project": ("stg_project", "project_id", "project_name"),
    "assignee": ("stg_user", "user_id", "user_display_name"),
    "team": ("stg_team", "team_id", "team_name"),
    "quarter": ("stg_field_option", "field_id", "field_option_name"),
    "story_points": ("stg_field_option", "field_id", "field_option_name"),
}


def _lookups(columns: list[str], rows: str) -> tuple[str, str]:
    """Select list and joins that turn the ids of ``columns`` into labels."""
    selects, joins = [], []
    for c in columns:
        if c not in _LOOKUPS:
            selects.append(f"nullif({rows}.{c}, '-is_null') as {c}")
            continue
        table, key, label = _LOOKUPS[c]
        selects.append(f"coalesce(l_{c}.{label}, nullif({rows}.{c}, '-is_null')) as {c}")
        joins.append(
            f"left join {table} l_{c} on cast(l_{c}.{key} as varchar) = {rows}.{c}"
            f" and l_{c}.source_relation = {rows}.source_relation"
        )
    return ", ".join(selects), " ".join(joins)


def _daily(prefix: str, columns: list[str]) -> str:
    selects, joins = _lookups(columns, "d")
    return f"""select d.date_day, cast(date_trunc('week', d.date_day) as date) as date_week, d.issue_id,
        d.source_relation, s.status_name as status, nullif(d.status, '-is_null') as status_id, {selects},
        md5(concat_ws('-', cast(d.date_day as varchar), d.issue_id, d.source_relation)) as issue_day_id
        from {prefix}_filled_day d
        left join stg_status s on cast(s.status_id as varchar) = d.status and s.source_relation = d.source_relation
        {joins}"""


def _named_log(log: str) -> str:
    return f"""select h.*, lower(f.field_name) as field_name,
        cast(date_trunc('week', h.updated_at) as date) as updated_at_week
        from {log} h join stg_field f on f.field_id = h.field_id and f.source_relation = h.source_relation"""


CTES["x_single"] = _named_log("stg_issue_field_history")
CTES["x_multi"] = _named_log("stg_issue_multiselect_history")
CTES |= _history("x", TRACKED)
CTES["x_daily"] = _daily("x", VALUES)

# The same with optional tables switched off and fields told apart by name.
_FEW = {"assignee": "assignee", "components": "components", "quarter": "quarter"}
CTES |= _history("o", _FEW, grain="field_name", sprints=False)
CTES["o_daily"] = _daily("o", ["sprint", "sprint_name", "assignee", "quarter"])

CTES |= {
    "x_batch_t": """select field_id, field_name, issue_id, source_relation, updated_at, author_id,
        string_agg(field_value, ', ' order by field_value) as field_value from x_multi_all group by all""",
    "x_long_t": """select field_id, field_name, issue_id, source_relation, updated_at, author_id, field_value
        from x_single union all
        select field_id, field_name, issue_id, source_relation, updated_at, author_id, field_value from x_batch_t""",
    "x_pivot_t": f"""select source_relation, issue_id, updated_at, author_id,
        cast(date_trunc('week', updated_at) as date) as updated_at_week,
        max(case when lower(field_id) = 'status' then field_value end) as status, {_pivot_list(TRACKED)}
        from (select * replace (coalesce(field_value, '-is_null') as field_value) from x_long_t
            where {_RELEVANT.format(_in_list(TRACKED))}) group by all""",
    "x_scd_t": _filled(
        "x_pivot_t",
        ["status", *VALUES],
        "updated_at, author_id nulls first",
        "source_relation, issue_id, updated_at, updated_at_week, author_id",
    ),
    "x_valid_t": "select source_relation, issue_id, updated_at as valid_from, updated_at_week, author_id, "
    + ", ".join(f"f_{c} as {c}" for c in ["status", *VALUES])
    + """, lead(updated_at) over (partition by source_relation, issue_id
        order by updated_at, author_id nulls first) as next_at from x_scd_t""",
}
_sel, _joins = _lookups([c for c in VALUES if c != "story_points"], "v")
CTES |= {
    "x_states": f"""select v.valid_from, coalesce(v.next_at, {NOW}) as valid_until, v.updated_at_week, v.issue_id,
        v.source_relation, v.status as status_id, s.status_name as status, c.status_category_name, v.author_id,
        {_sel}, nullif(v.story_points, '-is_null') as story_points, v.next_at is null as is_current_record,
        md5(concat_ws('-', strftime(v.valid_from, '%Y-%m-%d %H:%M:%S.%f'), v.issue_id, v.source_relation))
            as issue_timestamp_id
        from x_valid_t v
        left join stg_status s on cast(s.status_id as varchar) = v.status and s.source_relation = v.source_relation
        left join stg_status_category c on c.status_category_id = s.status_category_id
            and c.source_relation = s.source_relation
        {_joins}""",
}

# --- transitions -------------------------------------------------------------

_BY_TIME = "over (partition by source_relation, issue_id order by valid_from, author_id nulls first)"


def _place(category: str) -> str:
    """Where a category stands in the workflow, null if it has no place there."""
    return f"nullif(list_position(['To Do', 'In Progress', 'Done'], {category}), 0)"


CTES |= {
    "x_moves": f"""select * from (select source_relation, issue_id, status, status_category_name, valid_from, author_id,
        lag(status) {_BY_TIME} as previous_status from x_states)
        where previous_status is null or previous_status <> status""",
    "x_periods": f"""select *, coalesce(lead(valid_from) {_BY_TIME}, {NOW}) as valid_until,
        lead(valid_from) {_BY_TIME} is null as is_current_status,
        cast(date_diff('second', valid_from, coalesce(lead(valid_from) {_BY_TIME}, {NOW})) as bigint) as seconds_in_status
        from x_moves""",
    "x_steps": f"""select source_relation, issue_id, status, status_category_name, previous_status, author_id,
        valid_from as transition_at, valid_until as transition_until, is_current_status, seconds_in_status,
        row_number() {_BY_TIME} as status_sequence,
        lag(status_category_name) {_BY_TIME} as previous_status_category_name,
        lag(valid_from) {_BY_TIME} as previous_transition_at,
        lag(seconds_in_status) {_BY_TIME} as seconds_in_previous_status from x_periods""",
    "x_transitions": f"""select source_relation, issue_id, status, status_category_name, previous_status,
        previous_status_category_name, transition_at, transition_until, status_sequence, is_current_status,
        cast(round(cast(seconds_in_status as decimal(28, 6)) / 60, 2) as double) as minutes_in_status,
        cast(round(cast(seconds_in_previous_status as decimal(28, 6)) / 60, 2) as double) as minutes_in_previous_status,
        case when previous_status_category_name is null then 'new'
            when previous_status_category_name = status_category_name then 'lateral'
            else coalesce(case sign({_place('status_category_name')} - {_place('previous_status_category_name')})
                when 1 then 'forward' when -1 then 'backward' end, 'other') end as transition_direction
        from x_steps""",
}

# --- issues ------------------------------------------------------------------

CTES |= {
    "x_epic": """select source_relation, issue_id, field_value as epic_issue_id from (
        select *, row_number() over (partition by source_relation, issue_id
            order by updated_at desc, field_id desc, field_value desc nulls last) as rn
        from x_single where field_name like 'epic%link') where rn = 1""",
    "x_typed": """select i.*, coalesce(cast(i.parent_issue_id as varchar), e.epic_issue_id) as revised_parent_issue_id,
        t.issue_type_name as issue_type from stg_issue i
        left join x_epic e on e.issue_id = i.issue_id and e.source_relation = i.source_relation
        left join stg_issue_type t on t.issue_type_id = i.issue_type_id and t.source_relation = i.source_relation""",
    "x_parents": """select i.*, p.issue_type as parent_issue_type, p.issue_name as parent_issue_name,
        p.issue_key as parent_issue_key, lower(coalesce(p.issue_type, '')) = 'epic' as is_parent_epic
        from x_typed i left join x_typed p on i.revised_parent_issue_id = cast(p.issue_id as varchar)
            and i.source_relation = p.source_relation""",
    "x_users": """select i.* exclude (revised_parent_issue_id, parent_issue_id),
        coalesce(i.revised_parent_issue_id, cast(i.parent_issue_id as varchar)) as parent_issue_id,
        a.user_display_name as assignee_name, a.time_zone as assignee_timezone, a.email as assignee_email,
        r.user_display_name as reporter_name, r.time_zone as reporter_timezone, r.email as reporter_email
        from x_parents i
        left join stg_user a on a.user_id = i.assignee_user_id and a.source_relation = i.source_relation
        left join stg_user r on r.user_id = i.reporter_user_id and r.source_relation = i.source_relation""",
    "x_comments": """select c.source_relation, c.issue_id, count(c.comment_id) as count_comments,
        string_agg(strftime(c.created_at, '%Y-%m-%d %H:%M:%S') || '  -  ' || u.user_display_name || ':  ' || c.body, chr(10)
            order by c.created_at, c.comment_id) as conversation
        from stg_comment c join stg_user u on u.user_id = c.author_user_id and u.source_relation = c.source_relation
        group by 1, 2""",
    "x_assign": """select source_relation, issue_id,
        min(case when field_id = 'assignee' then updated_at end) as first_assigned_at,
        max(case when field_id = 'assignee' then updated_at end) as last_assigned_at,
        min(case when field_id = 'resolutiondate' then updated_at end) as first_resolved_at
        from stg_issue_field_history
        where field_id in ('assignee', 'resolutiondate') and field_value is not null group by 1, 2""",
    "x_issue_sprint": """select source_relation, issue_id, last.id as current_sprint_id,
        last.name as current_sprint_name, last.board as board_id, last.started as sprint_started_at,
        last.ended as sprint_ended_at, last.completed as sprint_completed_at, count_sprint_changes
        from (select m.source_relation, m.issue_id, count(distinct m.field_value) as count_sprint_changes,
            arg_max({'id': m.field_value, 'name': s.sprint_name, 'board': s.board_id, 'started': s.started_at,
                     'ended': s.ended_at, 'completed': s.completed_at},
                (m.updated_at, coalesce(s.started_at, timestamp '0001-01-01'), coalesce(m.field_value, ''))) as last
            from x_multi m left join stg_sprint s on cast(s.sprint_id as varchar) = m.field_value
                and s.source_relation = m.source_relation
            where m.field_name = 'sprint' group by m.source_relation, m.issue_id)""",
    "x_versions": """select source_relation, issue_id,
        string_agg(version_name, ', ' order by version_name) filter (field_id = 'versions') as affects_versions,
        string_agg(version_name, ', ' order by version_name) filter (field_id = 'fixVersions') as fixes_versions
        from x_multi
        join (select source_relation, issue_id, field_id, max(updated_at) as updated_at from x_multi
            where field_id in ('versions', 'fixVersions') group by all) using (source_relation, issue_id, field_id, updated_at)
        join (select source_relation, cast(version_id as varchar) as field_value, version_name from stg_version)
            using (source_relation, field_value)
        group by source_relation, issue_id""",
    "x_issue_join": f"""select i.*, p.project_name, s.status_name as current_status,
        c.status_category_name as current_status_category, r.resolution_name as resolution_type,
        q.priority_name as current_priority, sp.current_sprint_id, sp.current_sprint_name,
        coalesce(sp.count_sprint_changes, 0) as count_sprint_changes, sp.sprint_started_at, sp.sprint_ended_at,
        sp.sprint_completed_at, coalesce(sp.sprint_started_at <= {NOW}
            and coalesce(sp.sprint_completed_at, {NOW}) >= {NOW}, false) as is_active_sprint,
        a.first_assigned_at, a.last_assigned_at, a.first_resolved_at, v.fixes_versions, v.affects_versions,
        m.conversation, coalesce(m.count_comments, 0) as count_comments
        from x_users i
        left join stg_project p on p.project_id = i.project_id and p.source_relation = i.source_relation
        left join stg_status s on s.status_id = i.status_id and s.source_relation = i.source_relation
        left join stg_status_category c on c.status_category_id = s.status_category_id
            and c.source_relation = s.source_relation
        left join stg_resolution r on r.resolution_id = i.resolution_id and r.source_relation = i.source_relation
        left join stg_priority q on q.priority_id = i.priority_id and q.source_relation = i.source_relation
        left join x_assign a on a.issue_id = i.issue_id and a.source_relation = i.source_relation
        left join x_versions v on v.issue_id = i.issue_id and v.source_relation = i.source_relation
        left join x_issue_sprint sp on sp.issue_id = i.issue_id and sp.source_relation = i.source_relation
        left join x_comments m on m.issue_id = i.issue_id and m.source_relation = i.source_relation""",
    "x_latest_day": """select * exclude (rn) from (select *, row_number() over (
        partition by source_relation, issue_id order by date_day desc) as rn from x_daily) where rn = 1""",
    "x_issue_enhanced": f"""select i.*,
        cast(date_diff('second', created_at, coalesce(resolved_at, {NOW})) as bigint) as open_duration_seconds,
        cast(date_diff('second', first_assigned_at, coalesce(resolved_at, {NOW})) as bigint) as any_assignment_duration_seconds,
        cast(date_diff('second', last_assigned_at, coalesce(resolved_at, {NOW})) as bigint) as last_assignment_duration_seconds,
        d.status, {', '.join('d.' + c for c in VALUES)}
        from x_issue_join i
        left join x_latest_day d on d.issue_id = i.issue_id and d.source_relation = i.source_relation""",
}

# --- sprints -----------------------------------------------------------------

_POINTS = "try_cast(nullif(regexp_extract(replace({}, ',', ''), '-?\\d+(\\.\\d+)?'), '') as decimal(28, 6))"
_SPRINT = "sprint_name, sprint_started_at, sprint_ended_at, sprint_completed_at, board_id"
_ESTIMATES = "original_estimate_seconds, remaining_estimate_seconds, time_spent_seconds"
_ISSUES = "sprint_issues, sprint_assignees, open_sprint_issues, resolved_sprint_issues"


def _sprint_sums(group: str) -> str:
    """Totals of a sprint from its issues; a sum is null if no issue was there that day."""
    return f"""select {group}, {_SPRINT}, sum(planned) as original_estimate_seconds,
        sum(remaining) as remaining_estimate_seconds, sum(spent) as time_spent_seconds,
        count(*) as sprint_issues, count(distinct person) as sprint_assignees,
        count(*) filter (was_open) as open_sprint_issues, count(*) filter (was_solved) as resolved_sprint_issues,
        nullif(count(first_points), 0) as issues_committed,
        cast(sum(first_points) as double) as story_points_committed,
        cast(sum(last_points) as double) as story_points_end,
        cast(sum(done_points) as double) as story_points_completed
        from x_sprint_issue group by {group}, {_SPRINT}"""


CTES |= {
    "x_split": f"""select issue_id, source_relation, date_day, date_week, status, team,
        {_POINTS.format('story_points')} as story_points, unnest(string_split(sprint, ', ')) as sprint_id
        from x_daily where sprint is not null""",
    "x_sprint_days": """select d.*, s.sprint_name, s.started_at as sprint_started_at, s.ended_at as sprint_ended_at,
        s.completed_at as sprint_completed_at, s.board_id, i.created_at as issue_created_at,
        i.resolved_at as issue_resolved_at, i.issue_key, i.assignee_user_id, i.assignee_name,
        i.original_estimate_seconds, i.remaining_estimate_seconds, i.time_spent_seconds,
        date_day >= cast(s.started_at as date)
            and (s.ended_at is null or date_day <= cast(s.ended_at as date)) as is_sprint_active,
        s.completed_at is not null and date_day >= cast(s.completed_at as date) as is_sprint_completed,
        date_day >= cast(i.created_at as date) and i.resolved_at is null as is_issue_open,
        coalesce(date_day >= cast(i.resolved_at as date) and i.resolved_at <= s.ended_at, false)
            as is_issue_resolved_in_sprint,
        case when date_day >= cast(s.started_at as date) and date_day <= cast(s.ended_at as date)
            then cast(date_diff('day', date_day, cast(s.ended_at as date)) as integer) end as days_left_in_sprint,
        md5(concat_ws('-', cast(date_day as varchar), d.sprint_id, d.issue_id, d.source_relation)) as sprint_issue_day_id
        from x_split d
        join x_users i on i.issue_id = d.issue_id and i.source_relation = d.source_relation
        join stg_sprint s on cast(s.sprint_id as varchar) = d.sprint_id and s.source_relation = d.source_relation
        where date_day >= cast(s.started_at as date) and (s.ended_at is null or date_day <= cast(s.ended_at as date))""",
    # One row per sprint and issue: what it was on the sprint's first and last day, and whether it was ever open or
    # resolved in between. The team is the last one known.
    "x_sprint_issue": """select source_relation, sprint_id, issue_id, arg_max(team, date_day) as team,
        any_value(sprint_name) as sprint_name, any_value(sprint_started_at) as sprint_started_at,
        any_value(sprint_ended_at) as sprint_ended_at, any_value(sprint_completed_at) as sprint_completed_at,
        any_value(board_id) as board_id, any_value(assignee_user_id) as person,
        coalesce(any_value(original_estimate_seconds), 0) as planned,
        coalesce(any_value(remaining_estimate_seconds), 0) as remaining,
        coalesce(any_value(time_spent_seconds), 0) as spent,
        bool_or(is_sprint_active and is_issue_open) as was_open, bool_or(is_issue_resolved_in_sprint) as was_solved,
        sum(coalesce(story_points, 0)) filter (date_day = cast(sprint_started_at as date)) as first_points,
        sum(coalesce(story_points, 0)) filter (date_day = cast(sprint_ended_at as date)) as last_points,
        sum(if(is_issue_resolved_in_sprint, story_points, 0)) filter (date_day = cast(sprint_ended_at as date)) as done_points
        from x_sprint_days group by source_relation, sprint_id, issue_id""",
    "x_team": "select source_relation, sprint_id, issue_id, team from x_sprint_issue",
    "x_by_team": _sprint_sums("source_relation, sprint_id, team"),
    "x_by_sprint": _sprint_sums("source_relation, sprint_id"),
    "x_estimates": f"select source_relation, sprint_id, team, {_SPRINT}, {_ESTIMATES} from x_by_team",
    "x_sprint_counts": f"select source_relation, sprint_id, team, {_ISSUES} from x_by_team",
    "x_sprint_start": "select source_relation, sprint_id, team, story_points_committed, issues_committed"
    " from x_by_team where issues_committed is not null",
    "x_sprint_end": "select source_relation, sprint_id, team, story_points_end, story_points_completed"
    " from x_by_team where story_points_end is not null",
    "x_sprint_enhanced": "select * from x_by_team",
    "x_sprint_no_team": "select * from x_by_sprint",
}

# --- projects and users ------------------------------------------------------


def _whole(value: str) -> str:
    return f"cast(round(cast({value} as decimal(28, 6)), 0) as double)"


def _of(numbers: str, fact: str) -> str:
    return f"map_extract({numbers}, '{fact}')[1]"


def _count(fact: str) -> str:
    return f"cast(coalesce({_of('totals', fact)}, 0) as bigint)"


def _median(fact: str) -> str:
    return _whole(_of("middles", fact))


def _average(fact: str, count: str, others: str | None = None) -> str:
    """Where there are ``others``, an empty total is a zero."""
    total = _of("totals", fact)
    if others:
        total = f"coalesce({total}, if({_count(others)} > 0, 0, null))"
    return f"case when {_count(count)} = 0 then 0 else {_whole(f'cast({total} as double) / {_count(count)}')} end"


def _facts(group: str, key: str) -> str:
    """Per group two maps: fact -> total, and fact -> middle value."""
    return f"""select {key}, source_relation, map(list(fact), list(total)) as totals, map(list(fact), list(middle)) as middles
        from (select {group} as {key}, source_relation, fact, sum(number) as total, quantile_cont(number, 0.5) as middle
            from x_facts where {group} is not null group by all) group by all"""


_AVG = ["avg_close_time", "avg_assigned_close_time", "avg_age_currently_open", "avg_age_currently_open_assigned"]
_MED = [
    "median_close_time",
    "median_age_currently_open",
    "median_assigned_close_time",
    "median_age_currently_open_assigned",
]
_USER = ["avg_close_time", "avg_age_currently_open", "median_close_time", "median_age_currently_open"]


def _days(metrics: list[str]) -> str:
    return ", ".join(f"{_whole(f'{m}_seconds / 86400.0')} as {m}_days" for m in metrics)


CTES |= {
    # One row per issue and fact.
    "x_facts": """select source_relation, project_id, assignee_user_id,
            if(resolved_at is null, 'open ', 'closed ') || fact.name as fact, fact.number as number
        from (select *, unnest([
            {'name': 'issues', 'number': cast(1 as bigint)},
            {'name': 'assigned', 'number': cast(assignee_user_id is not null as bigint)},
            {'name': 'age', 'number': open_duration_seconds},
            {'name': 'since first assignment', 'number': any_assignment_duration_seconds},
            {'name': 'since last assignment', 'number': last_assignment_duration_seconds}]) as fact
            from x_issue_enhanced)""",
    "x_project_facts": _facts("project_id", "project_id"),
    "x_user_facts": _facts("assignee_user_id", "user_id"),
    "x_project_medians": f"""select project_id, source_relation,
        {_median('closed age')} as median_close_time_seconds,
        {_median('open age')} as median_age_currently_open_seconds,
        {_median('closed since first assignment')} as median_assigned_close_time_seconds,
        {_median('open since first assignment')} as median_age_currently_open_assigned_seconds
        from x_project_facts""",
    "x_project_averages": f"""select project_id, source_relation, {_count('closed issues')} as count_closed_issues,
        {_count('open issues')} as count_open_issues, {_count('open assigned')} as count_open_assigned_issues,
        {_average('closed age', 'closed issues', 'open issues')} as avg_close_time_seconds,
        {_average('closed since first assignment', 'closed assigned', 'open issues')} as avg_assigned_close_time_seconds,
        {_average('open age', 'open issues', 'closed issues')} as avg_age_currently_open_seconds,
        {_average('open since first assignment', 'open assigned', 'closed issues')} as avg_age_currently_open_assigned_seconds
        from x_project_facts""",
    "x_project_metrics": f"""select *, {_days(_AVG + _MED)}
        from x_project_averages left join x_project_medians using (project_id, source_relation)""",
    "x_project_enhanced": f"""select p.*, u.user_display_name as project_lead_user_name,
        u.email as project_lead_email, e.epics, c.components,
        coalesce(m.count_closed_issues, 0) as count_closed_issues,
        coalesce(m.count_open_issues, 0) as count_open_issues,
        coalesce(m.count_open_assigned_issues, 0) as count_open_assigned_issues,
        {', '.join(f'm.{n}_seconds, m.{n}_days' for n in _AVG + _MED)}
        from stg_project p
        left join x_project_metrics m on m.project_id = p.project_id and m.source_relation = p.source_relation
        left join stg_user u on u.user_id = p.project_lead_user_id and u.source_relation = p.source_relation
        left join (select project_id, source_relation, string_agg(issue_name, ', ' order by issue_name) as epics
            from x_issue_enhanced where lower(issue_type) = 'epic' group by 1, 2) e
            on e.project_id = p.project_id and e.source_relation = p.source_relation
        left join (select project_id, source_relation, string_agg(component_name, ', ' order by component_name) as components
            from stg_component group by 1, 2) c
            on c.project_id = p.project_id and c.source_relation = p.source_relation""",
    "x_user_metrics": f"""select *, {_days(_USER)} from (
        select user_id, source_relation, {_count('closed issues')} as count_closed_issues,
            {_count('open issues')} as count_open_issues,
            {_average('closed since last assignment', 'closed issues')} as avg_close_time_seconds,
            {_average('open since last assignment', 'open issues')} as avg_age_currently_open_seconds,
            {_median('closed since last assignment')} as median_close_time_seconds,
            {_median('open since last assignment')} as median_age_currently_open_seconds
        from x_user_facts)""",
    "x_user_enhanced": f"""select u.*, p.projects, coalesce(m.count_closed_issues, 0) as count_closed_issues,
        coalesce(m.count_open_issues, 0) as count_open_issues,
        {', '.join(f'm.{n}_seconds, m.{n}_days' for n in _USER)}
        from stg_user u
        left join x_user_metrics m on m.user_id = u.user_id and m.source_relation = u.source_relation
        left join (select assignee_user_id, source_relation, string_agg(project_name, ', ' order by project_name) as projects
            from (select distinct assignee_user_id, source_relation, project_name from x_issue_enhanced) group by 1, 2) p
            on p.assignee_user_id = u.user_id and p.source_relation = u.source_relation""",
}

# --- analyses and checks -----------------------------------------------------

CTES |= {
    "x_daily_counts": """select source_relation, report_date, project, team, status_category, count(distinct issue_id) as issues_in_status
        from (select d.source_relation, d.date_day as report_date, d.project, d.team, d.issue_id,
            case when m.status_name is null then null else m.category end as status_category
            from x_daily d left join (select s.status_name, s.source_relation,
                case lower(c.status_category_name) when 'to do' then 'To Do' when 'in progress' then 'In Progress'
                    when 'done' then 'Done' else 'Other' end as category
                from stg_status s left join stg_status_category c on c.status_category_id = s.status_category_id
                    and c.source_relation = s.source_relation) m
            on lower(m.status_name) = lower(d.status) and m.source_relation = d.source_relation)
        group by 1, 2, 3, 4, 5""",
    "x_flow": """select *, cast(sum(issues_in_new_status_category) over (partition by source_relation, project, team, status_category
            order by status_category_transition_date rows unbounded preceding) as bigint)
            as cumulative_issues_in_status_category
        from (select t.source_relation, cast(t.transition_at as date) as status_category_transition_date, h.project, h.team,
            t.status_category_name as status_category, count(distinct t.issue_id) as issues_in_new_status_category
            from x_transitions t join x_states h on h.issue_id = t.issue_id and h.valid_from = t.transition_at
                and h.source_relation = t.source_relation
            group by 1, 2, 3, 4, 5)""",
    "x_first_logged": """select source_relation, issue_id, cast(sprint_id as varchar) as sprint_id,
            min(updated_date) as first_date_source
        from (select m.source_relation, m.issue_id, try_cast(m.field_value as bigint) as sprint_id, l.updated_date
            from x_multi m join (select source_relation, issue_id, cast(updated_at as date) as updated_date,
                    max(updated_at) as last_at from x_multi where field_name = 'sprint' group by 1, 2, 3) l
                on l.source_relation = m.source_relation and l.issue_id = m.issue_id and l.last_at = m.updated_at
            where m.field_name = 'sprint' and m.field_value is not null)
        group by 1, 2, 3""",
}

_NAMES = re.compile("|".join(rf"\b{n}\b" for n in sorted(CTES, key=len, reverse=True)))


def with_ctes(final: str, views: dict[str, str] | None = None, as_of: str = AS_OF) -> str:
    """Put the CTEs that ``final`` needs, and those they need, in front of it.

    ``views`` are the raw views to use instead of the usual ones, ``as_of`` their "now".
    """
    ctes = CTES | {f"raw_{name}": sql for name, sql in (views or {}).items()}
    needed: list[str] = []

    def need(sql: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(sql)):
            if name not in needed:
                need(ctes[name])
                needed.append(name)

    need(final)
    if not needed:
        return final
    text = "with " + ",\n".join(f"{n} as materialized ({ctes[n]})" for n in needed) + "\n" + final
    return text.replace(f"'{AS_OF}'", f"'{as_of}'").replace(f"'{AS_OF[:10]}'", f"'{as_of[:10]}'")
