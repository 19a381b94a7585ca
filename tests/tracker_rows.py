"""A tiny tracker from hand-written rows."""

from __future__ import annotations

from fieldtrail.sources.schemas import RAW_COLUMNS

# Columns given by position; the others are null.
_COLUMNS = {
    "issue": "id, created, resolved, assignee, project, issue_type, status, parent_id, key, summary",
    "issue_field_history": "issue_id, field_id, time, value, author_id",
    "issue_multiselect_history": "issue_id, field_id, time, value, author_id",
    "field": "id, name",
    "field_option": "id, name",
    "status": "id, name, status_category_id",
    "status_category": "id, name",
    "issue_type": "id, name",
    "priority": "id, name",
    "resolution": "id, name",
    "project": "id, name, lead_id",
    "team": "id, name",
    "component": "id, name, project_id",
    "version": "id, name",
    "user": "id, name, email",
    "sprint": "id, name, start_date, end_date, complete_date, _deleted",
    "comment": "id, issue_id, author_id, created, body",
    "issue_link": "issue_id, related_issue_id, relationship",
}
_DEFAULT = {
    "field": [
        ("status", "Status"),
        ("f_sprint", "Sprint"),
        ("f_team", "Team"),
        ("assignee", "Assignee"),
        ("f_points", "Story Points"),
        ("resolutiondate", "Resolved"),
        ("fixVersions", "Fix versions"),
        ("f_epic", "Epic Link"),
    ],
    "status": [(1, "Open", 1), (2, "Doing", 2), (3, "Closed", 3)],
    "status_category": [(1, "To Do"), (2, "In Progress"), (3, "Done")],
    "user": [("u1", "Ada", "a@example.org"), ("u2", "Bo", "b@example.org")],
    "team": [("t1", "Red"), ("t2", "Blue")],
    "issue_type": [(1, "Epic"), (2, "Story")],
    "project": [(1, "Apollo", "u1")],
    "sprint": [(1, "S1", "2024-01-02", "2024-01-05", None, False), (2, "S2", "2024-01-02", "2024-01-05", None, True)],
    "version": [(1, "v1"), (2, "v2")],
}


def raw_tables(spark, **rows):
    """Raw tables with the given rows; small default dimensions for the rest."""
    tables = {}
    for table, names in _COLUMNS.items():
        names = names.split(", ")
        types = dict(c.split() for c in RAW_COLUMNS[table].split(","))
        data = [
            tuple(None if v is None else str(v) for v in (*row, *[None] * (len(names) - len(row))))
            for row in rows.get(table, _DEFAULT.get(table, []))
        ]
        df = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))
        tables[table] = df.selectExpr(*[f"cast(`{n}` as {types[n]}) as `{n}`" for n in names])
    return tables
