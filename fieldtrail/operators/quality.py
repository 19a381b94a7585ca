"""Checks on tables: freshness, keys, differences, reconciliation with the log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.operators.history import KEYS

WARN_HOURS, ERROR_HOURS = 72, 96


def freshness_check(tables: Mapping[str, DataFrame], cfg: Config, loaded_at: str = "_synced") -> DataFrame:
    """How old the newest row of each raw table is; a table that does not say when it was loaded is too old."""

    def loaded(df: DataFrame):
        known = loaded_at.lower() in map(str.lower, df.columns)
        return (F.col(loaded_at) if known else F.lit(None)).cast("timestamp")

    newest = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.max(loaded(df)).alias("max_loaded_at")).select(
                F.lit(name).alias("table_name"), "max_loaded_at"
            )
            for name, df in tables.items()
        ],
    )
    age = (F.unix_timestamp(cfg.now()) - F.unix_timestamp("max_loaded_at")) / 3600
    return newest.withColumn("age_hours", age).withColumn(
        "freshness",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > ERROR_HOURS), "error")
        .when(F.col("age_hours") > WARN_HOURS, "warn")
        .otherwise("pass"),
    )


def check_unique_not_null(table: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row with the number of repeated keys and of rows with a null in the key."""
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("_rows"))
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
            F.count_if((F.col("_rows") > 1) & ~has_null).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(has_null, F.col("_rows"))), F.lit(0)).alias("rows_with_null_key"),
        )
        .select(F.lit(table).alias("table_name"), "row_count", "repeated_keys", "rows_with_null_key")
    )


#: The ids of the tables that others look up; a repeated one would multiply their rows.
DIMENSIONS: dict[str, str] = {
    "component": "component_id",
    "field": "field_id",
    "field_option": "field_id",
    "issue": "issue_id",
    "issue_type": "issue_type_id",
    "priority": "priority_id",
    "project": "project_id",
    "resolution": "resolution_id",
    "sprint": "sprint_id",
    "status": "status_id",
    "status_category": "status_category_id",
    "team": "team_id",
    "user": "user_id",
    "version": "version_id",
}


def check_dimensions(staged: Mapping[str, DataFrame]) -> DataFrame:
    """:func:`check_unique_not_null` of the ids of all dimension tables in use."""
    checks = [
        check_unique_not_null(table, staged[table], ["source_relation", key])
        for table, key in DIMENSIONS.items()
        if table in staged
    ]
    return reduce(DataFrame.unionByName, checks)


def require_unique_ids(staged: Mapping[str, DataFrame]) -> None:
    """Raise if a dimension has an id twice, or a null one; an action over the ids."""
    wrong = check_dimensions(staged).filter("repeated_keys > 0 or rows_with_null_key > 0").collect()
    if wrong:
        raise ValueError(f"ids are repeated or null in {', '.join(sorted(r['table_name'] for r in wrong))}")


#: Parts into which :func:`diff_tables` deals the rows: the most rows that it broadcasts.
DIFF_PARTS = 16_384


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row. Nulls are hashed as flags, since they leave a hash as it is."""
    of_row = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(seed), *of_row) for seed in (1, 2)]


def _part(columns: Sequence[str]) -> Column:
    return F.pmod(_row_hashes(columns)[0], F.lit(DIFF_PARTS)).cast("int").alias("_part")


def differing_parts(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_part``: where the rows of two tables, dealt by hash to ``DIFF_PARTS``, may differ; ``both`` has them with a
    flag ``_before``.

    Sums of 32-bit halves of two hashes and numbers of rows are compared, so the order of rows does not matter, no sum
    overflows, and what is shuffled does not grow with the rows. Parts that hold the same rows as often are left out.
    """
    halves = [half for h in _row_hashes(columns) for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    sign = F.when(F.col("_before"), F.lit(1)).otherwise(F.lit(-1)).cast("long")
    sums = [F.sum(half * sign).alias(f"_sum{i}") for i, half in enumerate([*halves, F.lit(1)])]
    totals = both.groupBy(_part(columns)).agg(*sums)
    return totals.filter(" or ".join(f"_sum{i} <> 0" for i in range(len(sums)))).select("_part")


def diff_tables(
    before: DataFrame, after: DataFrame, ignore: Sequence[str] = (), names: tuple[str, str] = ("prod", "dev")
) -> DataFrame:
    """Distinct rows that only one of two tables has, and which one.

    Digests of parts are compared first, so of equal tables no row is shuffled; the rows of the parts that differ are
    then compared themselves, in one aggregation over both tables. Tables are read twice, and should be stored ones.
    """
    columns = [c for c in before.columns if c in set(after.columns) - set(ignore)]
    both = before.select(*columns, F.lit(True).alias("_before")).unionByName(
        after.select(*columns, F.lit(False).alias("_before"))
    )
    compared = (
        both.withColumn("_part", _part(columns))
        .join(F.broadcast(differing_parts(both, columns)), "_part", "left_semi")
        .groupBy(*columns)
        .agg(F.bool_or("_before").alias("_in_before"), F.bool_or(~F.col("_before")).alias("_in_after"))
    )
    return compared.filter(F.col("_in_before") != F.col("_in_after")).select(
        *columns,
        F.when(F.col("_in_before"), f"from {names[0]}").otherwise(f"from {names[1]}").alias("source"),
    )


def _sprint_changes(multi: DataFrame, field: DataFrame) -> DataFrame:
    fields = field.filter(F.lower("field_name") == "sprint").select("source_relation", "field_id")
    return multi.join(fields, ["source_relation", "field_id"])


def reconcile_first_sprint_day(daily_sprint: DataFrame, multi: DataFrame, field: DataFrame) -> DataFrame:
    """First day of an issue in a sprint: result table against the change log.

    Only the sprints set by the last change of a day count, as in the daily history.
    """
    pair = ["source_relation", "issue_id", "sprint_id"]
    shown = daily_sprint.groupBy(*pair, "sprint_started_at").agg(F.min("date_day").alias("first_date_end"))
    changes = _sprint_changes(multi, field)
    last_of_day = F.max(F.struct("updated_at", "_values"))["_values"].alias("_values")
    logged = (
        changes.groupBy(*KEYS, "updated_at")
        .agg(F.collect_set(F.col("field_value").try_cast("long")).alias("_values"))
        .groupBy(*KEYS, F.to_date("updated_at").alias("updated_date"))
        .agg(last_of_day)
        .select(*KEYS, "updated_date", F.explode("_values").alias("sprint_id"))
        .withColumn("sprint_id", F.col("sprint_id").cast("string"))
        .groupBy(*pair)
        .agg(F.min("updated_date").alias("first_date_source"))
    )
    return (
        shown.join(logged, pair, "full_outer")
        .filter(
            ~F.col("first_date_source").eqNullSafe(F.col("first_date_end"))
            & F.coalesce(F.col("first_date_source") >= F.to_date("sprint_started_at"), F.lit(True))
        )
        .select(*pair, "first_date_source", "first_date_end")
    )


def reconcile_sprint_issue_count(
    sprint_totals: DataFrame, multi: DataFrame, field: DataFrame, sprint: DataFrame, issue: DataFrame
) -> DataFrame:
    """Number of issues per sprint: result table against all issues the log ever put in it.

    Teams of a sprint are added up, as an issue has one team per sprint.
    """
    key = ["source_relation", "sprint_id"]
    shown = sprint_totals.groupBy(*key).agg(F.sum("sprint_issues").alias("sprint_issues_end"))
    ids = sprint.select("source_relation", F.col("sprint_id").cast("string").alias("sprint_id"))
    logged = (
        _sprint_changes(multi, field)
        .select(*KEYS, F.col("field_value").alias("sprint_id"))
        .distinct()
        .join(issue.select(*KEYS), KEYS)
        .join(ids, key)
        .groupBy(*key)
        .agg(F.count("*").alias("sprint_issues_source"))
    )
    return (
        shown.join(logged, key, "full_outer")
        .filter(~F.col("sprint_issues_source").eqNullSafe(F.col("sprint_issues_end")))
        .select(*key, "sprint_issues_source", "sprint_issues_end")
    )
