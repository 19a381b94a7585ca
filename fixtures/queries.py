"""Every operator as a query over the test tables, with its expected result in SQL."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtrail import Config, Tracker
from fieldtrail.operators import daily, history, instants, metrics, quality, sprints
from fieldtrail.plans.incremental import update_daily
from fieldtrail.sources.schemas import RAW_COLUMNS, STAGED
from fieldtrail.sources.staging import conform, stage, union_sources
from fieldtrail.sources.tables import read_table, shared_folder, write_weeks
from fixtures.oracle import NOW, with_ctes
from fixtures.views import AS_OF, ORDER_AS_OF, ORDER_VIEWS, RAW_VIEWS, raw_tables

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = Config(
    history_columns=("team", "assignee", "components", "project", "quarter", "Story Points"), as_of=AS_OF
)
#: Optional tables off, fields told apart by name.
FEW = Config(
    history_columns=("assignee", "components", "quarter"),
    field_grain="field_name",
    using_sprints=False,
    using_components=False,
    using_versions=False,
    using_priorities=False,
    using_teams=False,
    include_comments=False,
    as_of=AS_OF,
)
#: When the first of two incremental runs takes place.
EARLIER = "2024-01-24 12:00:00"

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def tracker(spark: SparkSession, folder: str, cfg: Config = CONFIG) -> Tracker:
    return Tracker(raw_tables(spark, folder), cfg)


def split(t: Tracker) -> Tracker:
    """The tracker with its long timelines cut; a session without a shared folder, as in tests, gets one here."""
    ready(t.spark)
    return t.split_long_timelines(shared_folder(t.spark, "timelines"))


def ready(spark: SparkSession) -> None:
    """Only a session on one machine, as in tests, is given a folder of its own."""
    if spark.sparkContext.master.startswith("local") and not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fieldtrail-"))


def _plain_numbers(df: DataFrame) -> DataFrame:
    decimals = [c for c, t in df.dtypes if t.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


def query(expected: str | None = None, name: str | None = None, cfg: Config = CONFIG):
    """Register a function of a tracker as a query."""

    def register(function: Callable[[Tracker], DataFrame]):
        key = name or function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            ready(spark)
            return _plain_numbers(function(tracker(spark, folder, cfg)))

        QUERIES[key] = run
        if expected:
            EXPECTED[key] = expected if expected.startswith("with ") else with_ctes(expected)
        return function

    return register


# --- sources -----------------------------------------------------------------


@query(
    """select 'alpha' as source_relation, issue_id, field_id, time, value, author_id from raw_issue_field_history
    union all select 'beta', issue_id, field_id, time, value, null from raw_issue_field_history""",
    name="union_sources",
)
def two_sources(t: Tracker) -> DataFrame:
    log = t.raw["issue_field_history"].select(
        "issue_id", "field_id", F.col("time").cast("timestamp").alias("time"), "value", "author_id"
    )
    return union_sources({"Alpha": log, "Beta": log.drop("author_id")})


@query(
    """select cast(null as timestamp) as _synced, author_id, body, created, id, is_public, issue_id,
    update_author_id, updated from raw_comment"""
)
def conform_schema(t: Tracker) -> DataFrame:
    return conform(t.raw["comment"].withColumn("extra", F.lit(1)), RAW_COLUMNS["comment"])


def _stage_query(table: str) -> None:
    @query(f"select * from stg_{table}", name=f"stage_{table}")
    def staged(t: Tracker) -> DataFrame:
        return t.staged[table]


for _table in STAGED:
    _stage_query(_table)


def _staged_columns(table: str) -> list[str]:
    """The columns that a staged table has, by the fixed names of its specification."""
    spec = STAGED[table]
    merged = {c for _, columns in spec.fallback for c in columns}
    raw = [c.split()[0] for c in RAW_COLUMNS[table].split(",")]
    plain = [spec.rename.get(c, c) for c in raw if c not in spec.drop and c not in merged]
    return [*plain, *(name for name, _ in spec.fallback)]


def _filled_sql(table: str) -> str:
    counts = " + ".join(f"count({c})" for c in _staged_columns(table))
    return f"select '{table}' as table_name, count(*) as row_count, {counts} as filled_cells from stg_{table}"


@query(" union all ".join(map(_filled_sql, STAGED)))
def stage_rename_cast(t: Tracker) -> DataFrame:
    """Rows and filled cells of every staged table, under its new column names."""
    tables = [
        t.staged[table].agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("row_count"),
            reduce(lambda a, b: a + b, [F.count(c) for c in _staged_columns(table)]).alias("filled_cells"),
        )
        for table in STAGED
    ]
    return reduce(DataFrame.unionByName, tables)


@query(
    " union all ".join(
        f"select '{name} {flag}' as table_name, id from raw_{name} where not coalesce(_deleted, false)"
        for name in ("issue", "sprint")
        for flag in ("_deleted", "_DELETED")
    )
)
def soft_delete_filter(t: Tracker) -> DataFrame:
    """Rows that stay, whatever the case of the flag's name."""
    kept = []
    for name in ("issue", "sprint"):
        for flag in ("_deleted", "_DELETED"):
            staged = stage(name, t.raw[name].withColumnRenamed("_deleted", flag), t.cfg)
            kept.append(staged.select(F.lit(f"{name} {flag}").alias("table_name"), F.col(f"{name}_id").alias("id")))
    return reduce(DataFrame.unionByName, kept)


@query(
    """select id as issue_id, coalesce(original_estimate, _original_estimate) as original_estimate_seconds,
    coalesce(remaining_estimate, _remaining_estimate) as remaining_estimate_seconds,
    coalesce(time_spent, _time_spent) as time_spent_seconds,
    cast(coalesce(work_type, issue_type) as bigint) as issue_type_id from raw_issue where not _deleted"""
)
def coalesce_fallback(t: Tracker) -> DataFrame:
    return t.staged["issue"].select(
        "issue_id", "original_estimate_seconds", "remaining_estimate_seconds", "time_spent_seconds", "issue_type_id"
    )


@query("select * from o_daily")
def optional_table(t: Tracker) -> DataFrame:
    return Tracker(t.raw, FEW).daily_issue_field_history


@query("select * from x_daily")
def write_week_partitions(t: Tracker) -> DataFrame:
    path = shared_folder(t.spark, "weeks")
    write_weeks(t.daily_issue_field_history, path, "date_week")
    return read_table(t.spark, path)


def _loaded_sql(table: str) -> str:
    when = "max(_synced)" if re.search(r"\b_synced\b", RAW_VIEWS[table]) else "cast(null as timestamp)"
    return f"select '{table}' as table_name, {when} as max_loaded_at from raw_{table}"


@query(
    f"""select table_name, max_loaded_at, date_diff('second', max_loaded_at, {NOW}) / 3600.0 as age_hours,
    case when max_loaded_at is null or date_diff('second', max_loaded_at, {NOW}) > 96 * 3600 then 'error'
        when date_diff('second', max_loaded_at, {NOW}) > 72 * 3600 then 'warn' else 'pass' end as freshness
    from ({' union all '.join(map(_loaded_sql, RAW_VIEWS))}) group by all"""
)
def freshness_check(t: Tracker) -> DataFrame:
    return quality.freshness_check({n: t.raw[n] for n in RAW_VIEWS}, t.cfg)


# --- history -----------------------------------------------------------------


@query(
    """select 'single' as log, issue_id, source_relation, updated_at, field_id, field_name, field_value,
    updated_at_week from x_single
    union all select 'multi', issue_id, source_relation, updated_at, field_id, field_name, field_value,
    updated_at_week from x_multi"""
)
def history_with_field_name(t: Tracker) -> DataFrame:
    columns = [*history.KEYS, "updated_at", "field_id", "field_name", "field_value", "updated_at_week"]
    single = t.single_history.select(F.lit("single").alias("log"), *columns)
    return single.unionByName(t.multi_history.select(F.lit("multi").alias("log"), *columns))


@query("select * from x_multi_all where field_name = 'sprint_name'")
def sprint_name_rows(t: Tracker) -> DataFrame:
    columns = ["field_id", "field_name", *history.KEYS, "updated_at", "author_id", "field_value"]
    named = history.with_sprint_names(t.multi_history, t.sprint)
    return named.filter("field_name = 'sprint_name'").select(*columns)


@query("select * from x_batch_t")
def multiselect_batch(t: Tracker) -> DataFrame:
    return history.multiselect_batches(history.with_sprint_names(t.multi_history, t.sprint), "author_id")


@query("select * from x_long_t")
def combine_histories(t: Tracker) -> DataFrame:
    return history.combined_history(t.single_history, t.multi_history, t.sprint, "author_id")


def _long_by_day(t: Tracker) -> DataFrame:
    return history.combined_history(t.single_history, t.multi_history, t.sprint)


@query(
    """select field_id, field_name, issue_id, source_relation, field_value, updated_at as valid_starting_at,
    lead(updated_at) over (partition by source_relation, issue_id, field_id
        order by updated_at, field_value nulls first) as valid_ending_at from x_long_day"""
)
def value_validity(t: Tracker) -> DataFrame:
    return history.value_validity(_long_by_day(t), t.cfg, split(t).hot_issues)


@query("select * from x_relevant_day")
def relevant_fields(t: Tracker) -> DataFrame:
    return history.relevant_fields(_long_by_day(t), t.cfg, daily=True)


@query(
    """select source_relation, issue_id, valid_starting_on, updated_at, field_id, field_name, field_value
    from x_last_day"""
)
def last_value_per_day(t: Tracker) -> DataFrame:
    relevant = history.relevant_fields(_long_by_day(t), t.cfg, daily=True)
    return history.last_value_per_day(relevant, t.cfg)


@query(
    """select source_relation, issue_id, field_id, updated_at, coalesce(field_value, '-is_null') as marked,
    field_value as restored from x_single"""
)
def null_sentinel(t: Tracker) -> DataFrame:
    marked = history.with_null_marker(t.single_history)
    return marked.select(
        *history.KEYS,
        "field_id",
        "updated_at",
        F.col("field_value").alias("marked"),
        history.without_null_marker("field_value").alias("restored"),
    )


@query(
    """select *, cast(date_trunc('week', valid_starting_on) as date) as valid_starting_at_week,
    md5(concat_ws('-', cast(valid_starting_on as varchar), issue_id, source_relation)) as issue_day_id
    from x_pivot_day"""
)
def pivot_daily(t: Tracker) -> DataFrame:
    return t.daily_changes


@query("select * from x_pivot_t")
def pivot_timestamp(t: Tracker) -> DataFrame:
    return history.drop_segment(split(t).timestamp_changes)


_FILLED = ["sprint", "sprint_name", "team", "assignee", "components", "project", "quarter", "story_points"]
_FILLED_SQL = ", ".join(f"f_{c} as {c}" for c in _FILLED)


@query(
    f"""select source_relation, issue_id, valid_starting_on, f_status as status_id, {_FILLED_SQL} from x_scd_day"""
)
def ffill_daily_scd(t: Tracker) -> DataFrame:
    return t.daily_scd.drop("issue_day_id", "valid_starting_at_week")


@query(
    f"""select source_relation, issue_id, updated_at, updated_at_week, author_id, f_status as status, {_FILLED_SQL}
    from x_scd_t"""
)
def ffill_timestamp_scd(t: Tracker) -> DataFrame:
    return history.drop_segment(split(t).timestamp_scd)


@query(
    """select date_day, issue_id, source_relation, earliest as earliest_open_until_date,
    cast(date_trunc('week', earliest) as date) as earliest_open_until_week,
    md5(concat_ws('-', cast(date_day as varchar), issue_id, source_relation)) as issue_day_id from x_spine"""
)
def issue_calendar_spine(t: Tracker) -> DataFrame:
    return t.issue_calendar_spine


@query("select * from x_daily")
def daily_issue_field_history(t: Tracker) -> DataFrame:
    return t.daily_issue_field_history


@query("select * from x_states")
def timestamp_issue_field_history(t: Tracker) -> DataFrame:
    return split(t).timestamp_issue_field_history


@query(
    """select h.source_relation, h.issue_id, h.field_id, h.updated_at,
    coalesce(u.user_display_name, h.field_value) as field_value from x_single h
    left join stg_user u on u.user_id = h.field_value and u.source_relation = h.source_relation"""
)
def label_lookup(t: Tracker) -> DataFrame:
    from fieldtrail.operators.lookups import lookup_label

    rows = t.single_history.select(*history.KEYS, "field_id", "updated_at", "field_value")
    return lookup_label(rows, "field_value", t.staged["user"], "user_id", "user_display_name")


@query("select * from x_latest_day")
def latest_history_row(t: Tracker) -> DataFrame:
    return daily.latest_history_row(t.daily_issue_field_history)


@query("select * from x_daily")
def incremental_lookback(t: Tracker) -> DataFrame:
    """A run at an earlier time, then one now; the result must be that of a full build."""
    path = shared_folder(t.spark, "incremental")
    then = t.cfg.with_(as_of=EARLIER)
    known = dict(t.raw)
    for log in ("issue_field_history", "issue_multiselect_history"):
        known[log] = known[log].filter(F.col("time") <= then.now())
    known["issue"] = (
        known["issue"].filter(F.col("created") <= then.now())
        .withColumn("resolved", F.when(F.col("resolved") <= then.now(), F.col("resolved")))
    )
    update_daily(Tracker(known, then), path)
    return update_daily(t, path)


@query(
    with_ctes("select * from x_daily", {"issue": RAW_VIEWS["issue"].replace(
        "case when user_id % 3 = 0 then max(ts) end as resolved",
        "case when user_id % 2 = 0 then timestamp '2024-04-20 00:00:00' end as resolved")}, "2024-05-15 00:00:00")
)
def incremental_resolved_later(t: Tracker) -> DataFrame:
    """Three runs over four months. Half of the issues are resolved in the third, which no change log shows."""
    path = shared_folder(t.spark, "incremental")
    later = F.when(F.col("id") % 2 == 0, F.lit("2024-04-20").cast("timestamp"))
    for as_of, resolved in (
        (AS_OF, F.lit(None).cast("timestamp")),
        ("2024-03-20 00:00:00", F.lit(None).cast("timestamp")),
        ("2024-05-15 00:00:00", later),
    ):
        raw = dict(t.raw) | {"issue": t.raw["issue"].withColumn("resolved", resolved)}
        made = update_daily(Tracker(raw, t.cfg.with_(as_of=as_of)), path)
    return made


# --- transitions -------------------------------------------------------------


@query("select * exclude (author_id) from x_moves")
def status_changes_only(t: Tracker) -> DataFrame:
    return history.drop_segment(instants.status_changes_only(split(t)._timestamp_history)).drop("author_id")


@query("select * exclude (author_id) from x_periods")
def status_periods(t: Tracker) -> DataFrame:
    changes = instants.status_changes_only(split(t)._timestamp_history)
    return history.drop_segment(instants.status_periods(changes, t.cfg)).drop("author_id")


@query("select * exclude (author_id) from x_steps")
def status_transitions(t: Tracker) -> DataFrame:
    changes = instants.status_changes_only(split(t)._timestamp_history)
    return history.drop_segment(instants.status_transitions(instants.status_periods(changes, t.cfg))).drop("author_id")


@query("select * from x_transitions")
def transition_direction(t: Tracker) -> DataFrame:
    return split(t).issue_status_transitions


#: So few rows make an issue hot that most test issues are split.
HOT = CONFIG.with_(hot_rows=60)


@query("select * from x_states", cfg=HOT)
def hot_timestamp_history(t: Tracker) -> DataFrame:
    return split(t).timestamp_issue_field_history


@query("select * from x_transitions", cfg=HOT)
def hot_status_transitions(t: Tracker) -> DataFrame:
    return split(t).issue_status_transitions


@query("select * from x_flow", cfg=HOT)
def hot_cumulative_flow(t: Tracker) -> DataFrame:
    return split(t).cumulative_flow


# --- issues ------------------------------------------------------------------


@query("select * from x_epic")
def issue_epic(t: Tracker) -> DataFrame:
    return t.issue_epic


@query("select * from x_parents")
def issue_type_parents(t: Tracker) -> DataFrame:
    return t.issue_type_parents


@query("select * from x_users")
def issue_users(t: Tracker) -> DataFrame:
    return t.issue_users


@query("select * from x_comments")
def issue_comments(t: Tracker) -> DataFrame:
    return t.issue_parts["comments"]


@query("select * from x_assign")
def issue_assign_resolution(t: Tracker) -> DataFrame:
    return t.issue_parts["assign_resolution"]


@query("select * from x_issue_sprint")
def issue_sprint(t: Tracker) -> DataFrame:
    return t.issue_parts["sprint"]


@query("select * from x_versions")
def issue_versions(t: Tracker) -> DataFrame:
    return t.issue_parts["versions"]


@query("select * from x_issue_join")
def issue_join(t: Tracker) -> DataFrame:
    return t.issue_join


@query("select * from x_issue_enhanced")
def issue_enhanced(t: Tracker) -> DataFrame:
    return t.issue_enhanced


# --- sprints -----------------------------------------------------------------


@query("select * replace (cast(story_points as double) as story_points) from x_split")
def split_sprint_ids(t: Tracker) -> DataFrame:
    return sprints.split_sprint_ids(t.daily_issue_field_history, t.cfg)


@query(
    r"""select source_relation, issue_id, updated_at, field_value,
    cast(try_cast(nullif(regexp_extract(replace(field_value, ',', ''), '-?\d+(\.\d+)?'), '') as decimal(28, 6)) as double)
        as number from x_single where field_name = 'story points'"""
)
def string_to_numeric(t: Tracker) -> DataFrame:
    from fieldtrail.functions.text import string_to_numeric

    points = t.single_history.filter("field_name = 'story points'")
    return points.select(
        *history.KEYS, "updated_at", "field_value", string_to_numeric(F.col("field_value")).alias("number")
    )


@query("select * replace (cast(story_points as double) as story_points) from x_sprint_days")
def daily_sprint_issue_history(t: Tracker) -> DataFrame:
    return t.daily_sprint_issue_history


@query("select * from x_team")
def resolve_sprint_team(t: Tracker) -> DataFrame:
    return sprints.resolve_sprint_team(t.daily_sprint_issue_history)


@query("select * from x_estimates")
def sprint_estimates(t: Tracker) -> DataFrame:
    return sprints.sprint_estimates(t.sprint_facts, t.cfg)


@query("select * from x_sprint_counts")
def sprint_issue_metrics(t: Tracker) -> DataFrame:
    return sprints.sprint_issue_metrics(t.sprint_facts, t.cfg)


@query("select * from x_sprint_start")
def sprint_start_metrics(t: Tracker) -> DataFrame:
    return sprints.sprint_start_metrics(t.sprint_facts, t.cfg)


@query("select * from x_sprint_end")
def sprint_end_metrics(t: Tracker) -> DataFrame:
    return sprints.sprint_end_metrics(t.sprint_facts, t.cfg)


@query("select * from x_sprint_enhanced")
def sprint_enhanced(t: Tracker) -> DataFrame:
    return t.sprint_enhanced


@query("select * from x_sprint_no_team")
def sprint_enhanced_without_teams(t: Tracker) -> DataFrame:
    return Tracker(t.raw, t.cfg.with_(sprint_include_teams=False)).sprint_enhanced


# --- projects and users ------------------------------------------------------


@query("select * from x_project_medians")
def project_medians(t: Tracker) -> DataFrame:
    return metrics.project_medians(t.project_measures)


@query("select * from x_project_averages")
def project_averages(t: Tracker) -> DataFrame:
    return metrics.project_averages(t.project_measures)


@query("select * from x_project_metrics")
def project_metrics(t: Tracker) -> DataFrame:
    return t.project_metrics


@query("select * from x_project_enhanced")
def project_enhanced(t: Tracker) -> DataFrame:
    return t.project_enhanced


@query("select * from x_user_metrics")
def user_metrics(t: Tracker) -> DataFrame:
    return t.user_metrics


@query("select * from x_user_enhanced")
def user_enhanced(t: Tracker) -> DataFrame:
    return t.user_enhanced


# --- analyses ----------------------------------------------------------------


@query("select * from x_daily_counts")
def daily_status_category(t: Tracker) -> DataFrame:
    return t.daily_status_category


@query("select * from x_flow")
def cumulative_flow(t: Tracker) -> DataFrame:
    return split(t).cumulative_flow


# --- two sources ---------------------------------------------------------------

#: Column with an issue's id, of the tables that a source has for itself; all others are the same in both.
_OF_ISSUES = {"issue": "id", "issue_field_history": "issue_id", "issue_multiselect_history": "issue_id", "comment": "issue_id"}
_PARITY = {"even": 0, "odd": 1}


def _both_sources(t: Tracker) -> Tracker:
    """Even issues in one source and odd ones in another, both numbered from 0, so that ids collide."""

    def part(name: str, parity: int) -> DataFrame:
        df = t.raw[name]
        if name not in _OF_ISSUES:
            return df
        id_ = _OF_ISSUES[name]
        return df.filter(F.col(id_) % 2 == parity).withColumn(id_, F.expr(f"{id_} div 2"))

    raw = {name: union_sources({s: part(name, p) for s, p in _PARITY.items()}) for name in RAW_VIEWS}
    return Tracker(raw, t.cfg)


def _both_sql(relation: str, drop: str = "source_relation") -> str:
    """The results of each source alone, one below the other; keys that depend on the source's name are left out."""
    parts = []
    for source, parity in _PARITY.items():
        views = {
            name: f"select * replace ({id_} // 2 as {id_}) from ({RAW_VIEWS[name]}) where {id_} % 2 = {parity}"
            for name, id_ in _OF_ISSUES.items()
        }
        alone = with_ctes(f"select * exclude ({drop}) from {relation}", views)
        parts.append(f"{source} as (select *, '{source}' as source_relation from ({alone}))")
    return f"with {', '.join(parts)} select * from even union all by name select * from odd"


@query(_both_sql("x_daily", "source_relation, issue_day_id"))
def sources_daily_history(t: Tracker) -> DataFrame:
    return _both_sources(t).daily_issue_field_history.drop("issue_day_id")


@query(_both_sql("x_transitions"))
def sources_status_transitions(t: Tracker) -> DataFrame:
    return split(_both_sources(t)).issue_status_transitions


@query(_both_sql("x_project_enhanced"))
def sources_project_enhanced(t: Tracker) -> DataFrame:
    return _both_sources(t).project_enhanced


@query(_both_sql("x_flow"))
def sources_cumulative_flow(t: Tracker) -> DataFrame:
    return split(_both_sources(t)).cumulative_flow


# --- a large log ---------------------------------------------------------------


def _order_query(expected: str | None):
    def register(function: Callable[[Tracker], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            raw = raw_tables(spark, folder, orders=True)
            return _plain_numbers(function(Tracker(raw, CONFIG.with_(as_of=ORDER_AS_OF))))

        QUERIES[function.__name__] = run
        if expected:
            EXPECTED[function.__name__] = with_ctes(expected, ORDER_VIEWS, ORDER_AS_OF)
        return function

    return register


@_order_query("select * from x_transitions")
def order_status_transitions(t: Tracker) -> DataFrame:
    return split(t).issue_status_transitions


@_order_query(
    f"""select source_relation, issue_id, valid_starting_on, f_status as status_id, {_FILLED_SQL} from x_scd_day"""
)
def order_ffill_daily_scd(t: Tracker) -> DataFrame:
    return t.daily_scd.drop("issue_day_id", "valid_starting_at_week")


# --- checks ------------------------------------------------------------------


def _check_sql(table: str, relation: str, key: str) -> str:
    has_null = " or ".join(f"{c} is null" for c in key.split(", "))
    return f"""select '{table}' as table_name, cast(coalesce(sum(n), 0) as bigint) as row_count,
        count(*) filter (n > 1 and not ({has_null})) as repeated_keys,
        cast(coalesce(sum(n) filter ({has_null}), 0) as bigint) as rows_with_null_key
        from (select {key}, count(*) as n from {relation} group by {key})"""


#: Result table, its relation in SQL, its key; the last two are no keys, so that the check has something to find.
_KEYS = [
    ("daily_issue_field_history", "x_daily", "issue_day_id"),
    ("timestamp_issue_field_history", "x_states", "issue_timestamp_id"),
    ("issue_status_transitions", "x_transitions", "source_relation, issue_id, status_sequence"),
    ("issue_enhanced", "x_issue_enhanced", "issue_id, source_relation"),
    ("project_enhanced", "x_project_enhanced", "project_id, source_relation"),
    ("user_enhanced", "x_user_enhanced", "user_id, source_relation"),
    ("daily_sprint_issue_history", "x_sprint_days", "sprint_issue_day_id"),
    ("sprint_enhanced", "x_sprint_enhanced", "sprint_id, source_relation, team"),
    ("issue_field_history", "stg_issue_field_history", "issue_id, field_id"),
    ("issue_multiselect_history", "stg_issue_multiselect_history", "field_value"),
]


@query(
    " union all ".join(
        [_check_sql(*key) for key in _KEYS]
        + [_check_sql(table, f"stg_{table}", f"source_relation, {key}") for table, key in quality.DIMENSIONS.items()]
    )
)
def check_unique_not_null(t: Tracker) -> DataFrame:
    """All result tables, all dimensions, and two logs."""
    split(t)
    results = [
        quality.check_unique_not_null(table, t.staged[table] if table in t.staged else getattr(t, table), key.split(", "))
        for table, _, key in _KEYS
    ]
    return reduce(DataFrame.unionByName, results).unionByName(quality.check_dimensions(t.staged))


_PROD = "select * exclude (sprint, sprint_name) from x_daily"
_DEV = """select * exclude (sprint, sprint_name)
    replace (case when status = 'ASIA' then 'EUROPE' else status end as status) from x_daily"""


@query(
    f"""select *, 'from prod' as source from ({_PROD} except {_DEV})
    union all select *, 'from dev' as source from ({_DEV} except {_PROD})"""
)
def diff_tables(t: Tracker) -> DataFrame:
    prod = t.daily_issue_field_history
    dev = prod.withColumn("status", F.when(F.col("status") == "ASIA", F.lit("EUROPE")).otherwise(F.col("status")))
    return quality.diff_tables(prod, dev, ignore=["sprint", "sprint_name"])


def _first_day_sql(build: str, day: str) -> str:
    return f"""select '{build}' as build, source_relation, issue_id, sprint_id, first_date_source, first_date_end
        from (select source_relation, issue_id, sprint_id, sprint_started_at, min({day}) as first_date_end
            from x_sprint_days group by 1, 2, 3, 4)
        full outer join x_first_logged using (source_relation, issue_id, sprint_id)
        where first_date_source is distinct from first_date_end
            and coalesce(first_date_source >= cast(sprint_started_at as date), true)"""


@query(_first_day_sql("right", "date_day") + " union all " + _first_day_sql("a day late", "date_day + 1"))
def reconcile_first_sprint_day(t: Tracker) -> DataFrame:
    """The table as built has no differences; one that is a day late has many."""
    log = (t.staged["issue_multiselect_history"], t.staged["field"])
    right = t.daily_sprint_issue_history
    late = right.withColumn("date_day", F.date_add("date_day", 1))
    checks = [
        quality.reconcile_first_sprint_day(df, *log).withColumn("build", F.lit(build))
        for build, df in (("right", right), ("a day late", late))
    ]
    return checks[0].unionByName(checks[1])


@query(
    """select source_relation, sprint_id, sprint_issues_source, sprint_issues_end
    from (select source_relation, sprint_id, cast(sum(sprint_issues) as bigint) as sprint_issues_end
        from x_sprint_enhanced group by 1, 2)
    full outer join (select s.source_relation, cast(s.sprint_id as varchar) as sprint_id,
            count(distinct m.issue_id) as sprint_issues_source
        from x_multi m
        join stg_issue i on i.issue_id = m.issue_id and i.source_relation = m.source_relation
        join stg_sprint s on cast(s.sprint_id as varchar) = m.field_value and s.source_relation = m.source_relation
        where m.field_name = 'sprint' group by 1, 2) using (source_relation, sprint_id)
    where sprint_issues_source is distinct from sprint_issues_end"""
)
def reconcile_sprint_issue_count(t: Tracker) -> DataFrame:
    s = t.staged
    return quality.reconcile_sprint_issue_count(
        t.sprint_enhanced, s["issue_multiselect_history"], s["field"], s["sprint"], s["issue"]
    )
