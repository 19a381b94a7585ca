"""Ids in history columns -> labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from fieldtrail.config import Config

# History column -> (table, id column, label column).
_LABELS = {
    "components": ("component", "component_id", "component_name"),
    "issue_type": ("issue_type", "issue_type_id", "issue_type_name"),
    "project": ("project", "project_id", "project_name"),
    "assignee": ("user", "user_id", "user_display_name"),
    "team": ("team", "team_id", "team_name"),
}
_OTHER = ("field_option", "field_id", "field_option_name")


def lookup_label(df: DataFrame, column: str, labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    """Replace the id in ``column`` by its label; an unknown id stays as it is.

    A plain left join: Spark broadcasts ``labels`` if its size allows it, and
    otherwise sorts and merges, with large values split by adaptive execution.
    """
    labels = labels.selectExpr(
        "source_relation", f"cast(`{id_column}` as string) as `{column}`", f"`{label_column}` as _label"
    )
    return df.join(labels, ["source_relation", column], "left").selectExpr(
        *[f"coalesce(_label, `{c}`) as `{c}`" if c == column else f"`{c}`" for c in df.columns]
    )


def resolve_labels(
    df: DataFrame, columns: Iterable[str], staged: Mapping[str, DataFrame], cfg: Config
) -> DataFrame:
    """Look up each of ``columns`` in the table its name belongs to, else among the field options."""
    for column in columns:
        table, id_column, label_column = _LABELS.get(column, _OTHER)
        if table in staged:
            df = lookup_label(df, column, staged[table], id_column, label_column)
    return df


def with_status(df: DataFrame, staged: Mapping[str, DataFrame], *, category: bool = False) -> DataFrame:
    """Add the name of ``status_id`` and, if asked, of the status' category."""
    status = staged["status"].selectExpr(
        "source_relation", "cast(status_id as string) as status_id", "status_name as status", "status_category_id"
    )
    df = df.join(status, ["source_relation", "status_id"], "left")
    if category:
        df = df.join(staged["status_category"], ["source_relation", "status_category_id"], "left")
    return df.drop("status_category_id")
