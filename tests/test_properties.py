"""Properties: splitting, incremental runs and medians change nothing."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldtrail import Config, Tracker
from fieldtrail.functions.median import grouped_median, grouped_numbers
from fieldtrail.operators import history, metrics
from fieldtrail.operators.timeline import SEGMENT, along, find_hot, with_segments
from fieldtrail.plans.incremental import update_daily, week_cut
from fieldtrail.sources.tables import read_table, shared_folder, stored_weeks, write_weeks
from fixtures.queries import CONFIG, FEW, tracker


def rows(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(*columns).collect()))


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    found, expected = rows(a), rows(b)
    assert len(found) == len(expected)
    assert found == expected


@pytest.fixture(scope="module")
def timeline(spark):
    """500 rows: entity 1 has most of them, all values thin, some instants shared."""
    return spark.range(500).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 5).cast("long").alias("key"),
        F.timestamp_seconds(F.lit(1704067200) + F.expr("(id * 7919) % 331")).alias("at"),
        F.col("id").alias("tie"),
        F.when(F.col("id") % 6 == 0, F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") % 41 == 3, F.concat(F.lit("b"), F.col("id"))).alias("b"),
    )


@pytest.mark.parametrize("hot_rows", [20, 150])
def test_split_timeline_equals_whole_timeline(spark, timeline, hot_rows):
    cfg = Config(hot_rows=hot_rows)
    hot = find_hot(timeline, ["key"], "at", cfg, shared_folder(spark, "test"))
    assert hot.select("key").distinct().count() == timeline.groupBy("key").count().filter(f"count >= {hot_rows}").count()
    split = with_segments(timeline, hot, ["key"], "at")
    assert split.filter(F.col(SEGMENT) > 0).count() > 0
    options = dict(fill=["a", "b"], lead={"next_at": "at", "next_b": "b"}, lag={"last_a": "a"}, number="n")
    whole = along(timeline, ["key"], ["at", "tie"], **options)
    same(along(split, ["key"], ["at", "tie"], **options).drop(SEGMENT), whole)


def test_ordinary_entities_are_not_split(spark, timeline):
    assert find_hot(timeline, ["key"], "at", Config(hot_rows=10_000), shared_folder(spark, "test")) is None


def test_one_fill_equals_two_step_fill(timeline):
    window = Window.partitionBy("key").orderBy("at", "tie").rowsBetween(Window.unboundedPreceding, 0)
    batch = Window.partitionBy("key", "batch").orderBy("at", "tie")
    two_step = timeline.withColumn("batch", F.count("a").over(window)).withColumn("a", F.first("a").over(batch))
    same(along(timeline, ["key"], ["at", "tie"], fill=["a"]), two_step.drop("batch"))


def test_hot_issues_change_no_result(spark, small):
    plain = tracker(spark, small)
    split = tracker(spark, small, CONFIG.with_(hot_rows=60)).split_long_timelines(shared_folder(spark, "test"))
    assert plain.hot_issues is None and split.hot_issues.select("issue_id").distinct().count() > 2
    same(split.timestamp_issue_field_history, plain.timestamp_issue_field_history)
    same(split.issue_status_transitions, plain.issue_status_transitions)
    same(split.cumulative_flow, plain.cumulative_flow)
    long = history.combined_history(plain.single_history, plain.multi_history, plain.sprint)
    same(history.value_validity(long, split.cfg, split.hot_issues), history.value_validity(long, plain.cfg))


def test_periods_of_an_issue_abut(spark, small):
    order = Window.partitionBy("source_relation", "issue_id").orderBy("valid_from", "author_id")
    periods = tracker(spark, small).timestamp_issue_field_history.withColumn("next", F.lead("valid_from").over(order))
    assert periods.filter("next is not null and valid_until <> next").count() == 0
    assert periods.filter("(next is null) <> is_current_record").count() == 0


def test_medians(spark):
    values = {"a": [5], "b": [3, 10], "c": [-70000, 200000, 65536, 65535, 7], "d": [1, 1, 1, 9] * 25, "e": []}
    data = [(k, v) for k, vs in values.items() for v in [*vs, None]]
    df = spark.createDataFrame(data, "k string, v long")
    got = {r.k: r.median for r in grouped_median(df, ["k"], "v").collect()}
    assert got == {k: statistics.median(vs) for k, vs in values.items() if vs}


def test_numbers_of_groups(spark):
    """Null keys are groups, a group of nulls has a row, equal values in one bin and across bins."""
    rng = random.Random(5)
    data = [
        (rng.choice([None, 1, 2]), rng.choice([None, "x"]), rng.choice([None, 0, 7, 65536, rng.randrange(-300000, 300000)]))
        for _ in range(400)
    ] + [(9, None, None), (9, None, None)]
    df = spark.createDataFrame(data, "a long, b string, v long")
    found = grouped_numbers(df, ["a", "b"], "v")
    got = {(r.a, r.b): (r["rows"], r.total, r.median) for r in found.collect()}
    expected = {}
    for key in {row[:2] for row in data}:
        values = [v for a, b, v in data if (a, b) == key]
        real = [v for v in values if v is not None]
        middle, total = (statistics.median(real), sum(real)) if real else (None, None)
        expected[key] = (len(values), total, middle)
    assert got == expected


def test_measures_of_projects_and_users(spark):
    """An empty total is zero beside issues in the other state, and null without them; a count of zero gives zero."""
    made, none = dt.datetime(2024, 1, 1), None
    rows = [
        (1, "u", made, 100, none, none),  # the only issue of its project, assigned but never by a change
        (2, "u", made, 100, none, 7),
        (2, none, none, 50, 30, none),
        (none, "v", none, 10, 10, 10),
        (none, none, made, 10, 10, 10),
    ]
    durations = [f"{d}_duration_seconds" for d in ("open", "any_assignment", "last_assignment")]
    schema = "project_id long, assignee_user_id string, resolved_at timestamp, " + ", ".join(f"{d} long" for d in durations)
    issue = spark.createDataFrame(rows, schema).withColumn("source_relation", F.lit(""))
    measures = metrics.group_measures(issue)
    projects = {r.project_id: r for r in metrics.project_metrics(measures).collect()}
    assert set(projects) == {1, 2}
    assert projects[1].avg_assigned_close_time_seconds is None
    assert projects[2].avg_assigned_close_time_seconds == 0
    assert projects[1].avg_close_time_seconds == 100 and projects[1].avg_age_currently_open_seconds == 0
    assert projects[2].median_age_currently_open_assigned_seconds == 30
    assert projects[2].avg_age_currently_open_assigned_seconds == 0 and projects[2].count_open_assigned_issues == 0
    users = {r.user_id: r for r in metrics.user_metrics(measures).collect()}
    assert set(users) == {"u", "v"}
    assert (users["u"].count_closed_issues, users["u"].avg_close_time_seconds) == (2, 4)
    assert users["u"].median_age_currently_open_seconds is None and users["v"].avg_age_currently_open_seconds == 10


def test_week_cut(spark):
    cfg, path = Config(lookback_weeks=1), shared_folder(spark, "test")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 22)), (1, dt.date(2024, 1, 8)), (1, None)], "v int, w date")
    assert stored_weeks(spark, path, "w") == []
    write_weeks(df, path, "w")
    assert stored_weeks(spark, path, "w") == [dt.date(2024, 1, 8), dt.date(2024, 1, 22)]
    assert week_cut(stored_weeks(spark, path, "w"), cfg) == dt.date(2024, 1, 15)
    assert week_cut([], cfg).weekday() == 0


@pytest.mark.parametrize("late", [False, True])
def test_incremental_equals_full(spark, small, late):
    """Also with changes that arrive late, but within the lookback."""
    now = tracker(spark, small)
    path = shared_folder(spark, "test")
    then = CONFIG.with_(as_of="2024-01-24 12:00:00")
    known = dict(now.raw)
    for log in ("issue_field_history", "issue_multiselect_history"):
        seen = F.col("time") <= then.now()
        if late:
            seen = seen & ((F.col("time") < F.lit("2024-01-16").cast("timestamp")) | (F.hash("time") % 3 != 0))
        known[log] = known[log].filter(seen)
    known["issue"] = known["issue"].filter(F.col("created") <= then.now()).withColumn(
        "resolved", F.when(F.col("resolved") <= then.now(), F.col("resolved"))
    )
    first = update_daily(Tracker(known, then), path)
    same(first, Tracker(known, then).daily_issue_field_history)
    full = now.daily_issue_field_history
    same(update_daily(now, path), full)
    # Nothing new: another run keeps the table as it is.
    same(update_daily(now, path), full)


def test_weeks_not_written_stay(spark):
    path = shared_folder(spark, "test")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-08")], "v long, w string").withColumn(
        "w", F.col("w").cast("date")
    )
    write_weeks(df, path, "w")
    write_weeks(df.filter("v = 2").withColumn("v", F.lit(20).cast("long")), path, "w", whole=False)
    assert sorted(r.v for r in read_table(spark, path).collect()) == [1, 20]
    assert read_table(spark, path + "-missing") is None


def test_build_writes_what_the_lazy_tables_show(spark, small):
    lazy = tracker(spark, small)
    written = tracker(spark, small).build(shared_folder(spark, "test"))
    assert set(written) == set(Tracker.TABLES)
    for name in ("daily_issue_field_history", "issue_enhanced", "user_enhanced", "sprint_enhanced"):
        same(written[name], getattr(lazy, name))


@pytest.mark.parametrize(
    ("off", "gone"),
    [
        ("using_priorities", "current_priority"),
        ("using_sprints", "current_sprint_name"),
        ("using_versions", "fixes_versions"),
        ("include_comments", "count_comments"),
        ("using_components", "components"),
        ("using_teams", "team"),
    ],
)
def test_optional_tables(spark, small, off, gone):
    t = tracker(spark, small, CONFIG.with_(**{off: False}))
    assert gone not in t.issue_enhanced.columns
    assert gone in tracker(spark, small).issue_enhanced.columns


def test_few_tables(spark, small):
    t = tracker(spark, small, FEW)
    needed = {k: v for k, v in t.raw.items() if k not in ("sprint", "component", "version", "priority", "team", "comment")}
    bare = Tracker(needed, FEW)
    same(bare.daily_issue_field_history, t.daily_issue_field_history)
    assert bare.issue_enhanced.count() == t.staged["issue"].count()
    assert bare.project_enhanced.count() == 25


def test_second_full_build_leaves_nothing_behind(spark, small):
    path = shared_folder(spark, "test")
    tracker(spark, small).build(path)
    fewer = tracker(spark, small)
    raw = dict(fewer.raw) | {"issue": fewer.raw["issue"].filter("id < 3")}
    written = Tracker(raw, CONFIG).build(path)
    fresh = Tracker(raw, CONFIG)
    same(written["daily_issue_field_history"], fresh.daily_issue_field_history)
    same(written["daily_sprint_issue_history"], fresh.daily_sprint_issue_history)


def test_build_of_a_site_without_sprint_days_or_changes(spark, small):
    whole = tracker(spark, small)
    for gone in ({"issue_multiselect_history"}, {"issue_multiselect_history", "issue_field_history"}):
        raw = dict(whole.raw) | {name: whole.raw[name].filter("false") for name in gone}
        written = Tracker(raw, CONFIG).build(shared_folder(spark, "test"))
        assert written["daily_sprint_issue_history"].count() == 0
        assert written["issue_enhanced"].count() == whole.staged["issue"].count()
        path = shared_folder(spark, "test")
        assert update_daily(Tracker(raw, CONFIG), path).count() == Tracker(raw, CONFIG).daily_issue_field_history.count()
        if "issue_field_history" in gone:  # nothing was stored; otherwise old changes would be late ones
            same(update_daily(whole, path), whole.daily_issue_field_history)


def test_incremental_follows_resolutions_deletions_and_new_issues(spark, small):
    """Four runs over five months; what happens to issues leaves no trace in the change logs."""
    base = tracker(spark, small)
    day = lambda text: F.lit(text).cast("timestamp")
    issue = base.raw["issue"].withColumn("resolved", F.lit(None).cast("timestamp"))
    path = shared_folder(spark, "test")
    states = [
        ("2024-02-05 00:00:00", issue.filter("id <> 4")),
        ("2024-04-10 00:00:00", issue),
        ("2024-06-20 00:00:00", issue.withColumn("resolved", F.when(F.col("id") % 2 == 0, day("2024-06-01")))),
        ("2024-06-21 00:00:00", issue.withColumn("_deleted", F.col("id") == 3)),
    ]
    for as_of, rows_then in states:
        t = Tracker(dict(base.raw) | {"issue": rows_then}, CONFIG.with_(as_of=as_of))
        same(update_daily(t, path), t.daily_issue_field_history)


@pytest.mark.parametrize("flag", ["_deleted", "_DELETED", "_Deleted"])
def test_deleted_rows_go_in_any_case_of_the_flag(spark, small, flag):
    t = tracker(spark, small)
    raw = dict(t.raw) | {"issue": t.raw["issue"].withColumnRenamed("_deleted", flag)}
    assert Tracker(raw, CONFIG).staged["issue"].count() == t.staged["issue"].count()
    assert t.raw["issue"].count() > 0
