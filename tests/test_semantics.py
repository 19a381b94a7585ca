"""Hand-computed cases for the less obvious rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from tracker_rows import raw_tables

from fieldtrail import Config, Tracker
from fieldtrail.functions.text import slugify, string_to_numeric, surrogate_key
from fieldtrail.operators import history, instants, issues, quality
from fieldtrail.sources.staging import stage, union_sources

NOW = "2024-01-10 00:00:00"


def tracker(spark, cfg=None, **rows):
    return Tracker(raw_tables(spark, **rows), cfg or Config(as_of=NOW, history_columns=("Story Points",)))


def days(df, column):
    return {r["date_day"].day: r[column] for r in df.collect()}


OPEN_ISSUE = [(1, "2024-01-01 08:00:00", None, "u1", 1, 2, 1, None, "K-1", "One")]


def test_slugify():
    assert slugify("Story Points") == "story_points"
    assert slugify("Sub-task (old)") == "sub_task_old"
    assert slugify("3rd party") == "_3rd_party"


def test_numbers_in_text(spark):
    rows = [("1,234.5",), ("n/a",), ("",), ("about -3 or 4",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(string_to_numeric(F.col("t")).cast("double")).collect()
    assert [r[0] for r in got] == [1234.5, None, None, -3.0, None]


def test_key_tells_null_from_empty(spark):
    row = spark.sql("select cast(null as string) a, '' b").select(
        surrogate_key(F.col("a")).alias("x"), surrogate_key(F.col("b")).alias("y")
    ).first()
    assert row.x != row.y


def test_last_change_of_a_day_wins_and_null_is_a_value(spark):
    t = tracker(
        spark,
        issue=OPEN_ISSUE,
        issue_field_history=[
            (1, "status", "2024-01-02 09:00:00", "1"),
            (1, "status", "2024-01-02 17:00:00", "2"),
            (1, "f_team", "2024-01-02 10:00:00", "t1"),
            (1, "f_team", "2024-01-04 10:00:00", None),
            (1, "f_team", "2024-01-06 10:00:00", "t9"),
        ],
    )
    daily = t.daily_issue_field_history
    assert days(daily, "status") == {1: None, **{d: "Doing" for d in range(2, 11)}}
    team = days(daily, "team")
    assert [team[d] for d in (1, 2, 3, 4, 5, 6, 10)] == [None, "Red", "Red", None, None, "t9", "t9"]


def test_same_instant_is_ordered_by_field_and_value(spark):
    t = tracker(
        spark,
        issue=OPEN_ISSUE,
        issue_field_history=[
            (1, "status", "2024-01-02 09:00:00", "1"),
            (1, "status", "2024-01-02 09:00:00", "3"),
            (1, "status", "2024-01-02 09:00:00", None),
        ],
    )
    assert days(t.daily_issue_field_history, "status")[2] == "Closed"


def test_deleted_and_unchanged_issues_have_no_days(spark):
    t = tracker(
        spark,
        issue=[*OPEN_ISSUE, (2, "2024-01-01 08:00:00", None, None, 1, 2, 1, None, "K-2", "No change")],
        issue_field_history=[
            (1, "status", "2024-01-02 09:00:00", "1"),
            (77, "status", "2024-01-02 09:00:00", "1"),
        ],
    )
    assert {r.issue_id for r in t.daily_issue_field_history.select("issue_id").distinct().collect()} == {1}
    enhanced = {r.issue_id: r.status for r in t.issue_enhanced.collect()}
    assert enhanced == {1: "Open", 2: None}


def test_resolved_issue_stays_for_the_buffer(spark):
    cfg = Config(as_of="2024-04-01 00:00:00")
    issue = [(1, "2024-01-01", "2024-01-20", None, 1, 2, 1, None, "K-1", "One")]
    t = tracker(spark, cfg, issue=issue, issue_field_history=[(1, "status", "2024-01-31 09:00:00", "3")])
    found = [r.date_day for r in t.daily_issue_field_history.orderBy("date_day").collect()]
    # A month after 31 January is the last of February.
    assert (found[0], found[-1], len(found)) == (dt.date(2024, 1, 1), dt.date(2024, 2, 29), 60)


def test_change_before_creation_shows_with_the_next_one(spark):
    t = tracker(
        spark,
        issue=[(1, "2024-01-05", None, None, 1, 2, 1, None, "K-1", "One")],
        issue_field_history=[
            (1, "status", "2024-01-02 09:00:00", "2"),
            (1, "f_team", "2024-01-08 09:00:00", "t1"),
        ],
    )
    assert days(t.daily_issue_field_history, "status") == {5: None, 6: None, 7: None, 8: "Doing", 9: "Doing", 10: "Doing"}


def test_only_changes_before_creation_leave_empty_days(spark):
    t = tracker(
        spark,
        issue=[(1, "2024-01-08", None, None, 1, 2, 1, None, "K-1", "One")],
        issue_field_history=[(1, "status", "2024-01-02 09:00:00", "2")],
    )
    assert days(t.daily_issue_field_history, "status") == {8: None, 9: None, 10: None}


def test_sprint_lists_names_and_deleted_sprints(spark):
    t = tracker(
        spark,
        issue=OPEN_ISSUE,
        issue_multiselect_history=[
            (1, "f_sprint", "2024-01-02 09:00:00", "2", "u1"),
            (1, "f_sprint", "2024-01-02 09:00:00", "1", "u1"),
            (1, "f_sprint", "2024-01-07 09:00:00", None, "u1"),
        ],
    )
    row = t.daily_issue_field_history.filter("date_day = '2024-01-03'").first()
    assert (row.sprint, row.sprint_name) == ("1, 2", "2, S1")
    after = t.daily_issue_field_history.filter("date_day = '2024-01-08'").first()
    assert (after.sprint, after.sprint_name) == (None, None)
    in_sprint = t.daily_sprint_issue_history.collect()
    assert {(r.sprint_id, r.date_day.day) for r in in_sprint} == {("1", d) for d in (2, 3, 4, 5)}


def test_team_and_points_of_a_sprint(spark):
    t = tracker(
        spark,
        issue=[
            *OPEN_ISSUE,
            (2, "2024-01-01", "2024-01-04 10:00:00", "u2", 1, 2, 3, None, "K-2", "Two"),
            (3, "2024-01-01", None, "u2", 1, 2, 1, None, "K-3", "Three"),
        ],
        issue_field_history=[
            (1, "f_points", "2024-01-01 09:00:00", "1,000.5"),
            (2, "f_points", "2024-01-01 09:00:00", "3"),
            (2, "f_team", "2024-01-05 09:00:00", "t2"),
        ],
        issue_multiselect_history=[
            (1, "f_sprint", "2024-01-01 09:00:00", "1", "u1"),
            (2, "f_sprint", "2024-01-01 09:00:00", "1", "u1"),
            (3, "f_sprint", "2024-01-04 09:00:00", "1", "u1"),
        ],
    )
    rows = {r.team: r for r in t.sprint_enhanced.collect()}
    assert set(rows) == {None, "Blue"}
    no_team, blue = rows[None], rows["Blue"]
    assert (no_team.sprint_issues, no_team.issues_committed, no_team.open_sprint_issues) == (2, 1, 2)
    assert (float(no_team.story_points_committed), float(no_team.story_points_completed)) == (1000.5, 0.0)
    assert (blue.sprint_issues, blue.issues_committed, blue.resolved_sprint_issues) == (1, 1, 1)
    assert (float(blue.story_points_end), float(blue.story_points_completed)) == (3.0, 3.0)


def test_unknown_status_breaks_the_chain(spark):
    t = tracker(
        spark,
        issue=OPEN_ISSUE,
        issue_field_history=[
            (1, "status", "2024-01-02 09:00:00", "1", "u1"),
            (1, "status", "2024-01-03 09:00:00", "99", "u1"),
            (1, "status", "2024-01-04 09:00:00", "2", "u1"),
            (1, "status", "2024-01-05 09:00:00", "2", "u1"),
            (1, "status", "2024-01-06 09:00:00", "1", "u1"),
        ],
    )
    rows = t.issue_status_transitions.orderBy("transition_at").collect()
    assert [(r.status, r.previous_status, r.transition_direction) for r in rows] == [
        ("Open", None, "new"),
        ("Doing", None, "forward"),
        ("Open", "Doing", "backward"),
    ]
    assert [float(r.minutes_in_status) for r in rows] == [2880.0, 2880.0, 5220.0]
    assert [r.is_current_status for r in rows] == [False, False, True]


def test_category_names_are_compared_with_their_case(spark):
    rows = [("To Do", "to do"), ("to do", "to do"), ("Done", "To Do"), ("X", "Y"), (None, "Done")]
    df = spark.createDataFrame(
        [("", 1, "s", b, "p", a, None, None, 1, True, 60, 60) for a, b in rows],
        "source_relation string, issue_id long, status string, status_category_name string, previous_status string, "
        "previous_status_category_name string, transition_at timestamp, transition_until timestamp, "
        "status_sequence long, is_current_status boolean, seconds_in_status long, seconds_in_previous_status long",
    )
    got = {
        (r.previous_status_category_name, r.status_category_name): r.transition_direction
        for r in instants.transition_direction(df).collect()
    }
    assert got == {
        ("To Do", "to do"): "other",
        ("to do", "to do"): "lateral",
        ("Done", "To Do"): "backward",
        ("X", "Y"): "other",
        (None, "Done"): "new",
    }


def test_two_authors_at_one_instant_repeat_the_key(spark):
    t = tracker(
        spark,
        issue=OPEN_ISSUE,
        issue_field_history=[
            (1, "status", "2024-01-02 09:00:00", "1", "u1"),
            (1, "f_points", "2024-01-02 09:00:00", "5", "u2"),
        ],
    )
    rows = t.timestamp_issue_field_history.orderBy("author_id").collect()
    assert [(r.author_id, r.status, r.story_points) for r in rows] == [("u1", "Open", None), ("u2", "Open", "5")]
    check = quality.check_unique_not_null("t", t.timestamp_issue_field_history, ["issue_timestamp_id"]).first()
    assert (check.row_count, check.repeated_keys) == (2, 1)


def test_flow_counts_every_state_of_an_instant(spark):
    t = tracker(
        spark,
        Config(as_of=NOW, history_columns=("team", "project")),
        issue=OPEN_ISSUE,
        issue_field_history=[
            (1, "f_team", "2024-01-02 08:00:00", "t1", "u1"),
            (1, "status", "2024-01-02 09:00:00", "2", "u1"),
            (1, "f_team", "2024-01-02 09:00:00", "t2", "u2"),
            (1, "status", "2024-01-03 09:00:00", "99", "u1"),
            (1, "status", "2024-01-03 10:00:00", "2", "u1"),
        ],
    )
    got = {
        (r.status_category_transition_date.day, r.team, r.status_category): r.cumulative_issues_in_status_category
        for r in t.cumulative_flow.collect()
    }
    # The first row has no status yet; both authors' rows of 09:00 count as entering "In Progress".
    assert got == {
        (2, "Red", None): 1,
        (2, "Red", "In Progress"): 1,
        (2, "Blue", "In Progress"): 1,
        (3, "Blue", "In Progress"): 2,
    }


def test_comments(spark):
    rows = {
        "issue": [*OPEN_ISSUE, (2, "2024-01-01", None, None, 1, 2, 1, None, "K-2", "Two")],
        "comment": [
            (2, 1, "u2", "2024-01-02 10:00:00", "second"),
            (1, 1, "u1", "2024-01-02 09:00:00", "first"),
            (3, 1, "nobody", "2024-01-02 09:00:00", "unseen"),
            (4, 1, "u1", "2024-01-03 09:00:00", None),
            (5, 2, "u1", "2024-01-03 09:00:00", "x" * 50),
        ],
    }
    text = "2024-01-02 09:00:00  -  Ada:  first\n2024-01-02 10:00:00  -  Bo:  second"
    got = {r.issue_id: (r.count_comments, r.conversation) for r in tracker(spark, **rows).issue_parts["comments"].collect()}
    assert got[1] == (3, text)
    limited = Config(as_of=NOW, conversation_char_limit=80)
    got = {r.issue_id: r.conversation for r in tracker(spark, limited, **rows).issue_parts["comments"].collect()}
    assert got == {1: text, 2: "conversation too long to render"}
    without = Config(as_of=NOW, include_conversations=False)
    assert "conversation" not in tracker(spark, without, **rows).issue_enhanced.columns


def test_versions_of_the_latest_change(spark):
    t = tracker(
        spark,
        issue=OPEN_ISSUE,
        issue_multiselect_history=[
            (1, "fixVersions", "2024-01-02", "1", "u1"),
            (1, "fixVersions", "2024-01-03", "2", "u1"),
            (1, "fixVersions", "2024-01-03", "1", "u1"),
            (1, "fixVersions", "2024-01-03", "unknown", "u1"),
        ],
    )
    row = t.issue_parts["versions"].first()
    assert (row.fixes_versions, row.affects_versions) == ("v1, v2", None)


def test_parent_from_epic_link(spark):
    t = tracker(
        spark,
        issue=[
            (1, "2024-01-01", None, None, 1, 1, 1, None, "E-1", "Epic one"),
            (2, "2024-01-01", None, None, 1, 2, 1, None, "K-2", "Two"),
            (3, "2024-01-01", None, None, 1, 2, 1, 2, "K-3", "Three"),
        ],
        issue_field_history=[
            (2, "f_epic", "2024-01-01", "9", "u1"),
            (2, "f_epic", "2024-01-02", "1", "u1"),
            (3, "f_epic", "2024-01-02", "1", "u1"),
        ],
    )
    got = {r.issue_id: (r.parent_issue_id, r.parent_issue_key, r.is_parent_epic) for r in t.issue_users.collect()}
    assert got == {1: (None, None, False), 2: ("1", "E-1", True), 3: ("2", "K-2", False)}


def test_sources_do_not_mix(spark):
    one = raw_tables(spark, issue=OPEN_ISSUE, issue_field_history=[(1, "status", "2024-01-02 09:00:00", "1", "u1")])
    two = raw_tables(
        spark,
        issue=OPEN_ISSUE,
        issue_field_history=[(1, "status", "2024-01-03 09:00:00", "2", "u1")],
        status=[(1, "Offen", 1), (2, "In Arbeit", 2)],
    )
    raw = {name: union_sources({"One": one[name], "Two": two[name]}) for name in one}
    t = Tracker(raw, Config(as_of=NOW))
    got = {(r.source_relation, r.status) for r in t.issue_status_transitions.collect()}
    assert got == {("one", "Open"), ("two", "In Arbeit")}
    assert t.issue_enhanced.count() == 2


def test_source_case_and_aliases(spark):
    cfg = Config(as_of=NOW, preserve_source_case=True, column_aliases={"_gone": "_deleted"})
    df = raw_tables(spark, issue=[*OPEN_ISSUE, (2, "2024-01-01")])["issue"].withColumn("_gone", F.col("id") == 2)
    staged = stage("issue", union_sources({"One": df}, cfg), cfg)
    assert [(r.source_relation, r.issue_id) for r in staged.collect()] == [("One", 1)]


@pytest.mark.parametrize("grain", ["field_id", "field_name"])
def test_field_grain(spark, grain):
    t = tracker(
        spark,
        Config(as_of=NOW, field_grain=grain),
        issue=OPEN_ISSUE,
        field=[("a_sprint", "Sprint"), ("b_sprint", "Sprint"), ("status", "Status")],
        issue_multiselect_history=[
            (1, "b_sprint", "2024-01-02 09:00:00", "1", "u1"),
            (1, "a_sprint", "2024-01-02 10:00:00", "0", "u1"),
        ],
    )
    # By id both fields have a last value and the greater one shows; by name the later one does.
    assert days(t.daily_issue_field_history, "sprint")[3] == ("1" if grain == "field_id" else "0")


def test_diff_tables(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "id long, v string")
    b = spark.createDataFrame([(1, "x"), (3, None)], "id long, v string")
    got = {(r.id, r.source) for r in quality.diff_tables(a, b).collect()}
    assert got == {(2, "from prod"), (3, "from dev")}


def test_diff_tables_compares_only_parts_that_differ(spark):
    rows = spark.range(0, 20_000).selectExpr("id", "if(id % 3 = 0, null, concat('v', id)) as v", "id / 7 as x")
    columns = rows.columns

    def both(a, b):
        return a.withColumn("_before", F.lit(True)).unionByName(b.withColumn("_before", F.lit(False)))

    again = rows.repartition(7, "v")
    assert quality.differing_parts(both(rows, again), columns).isEmpty()
    assert quality.diff_tables(rows, again).isEmpty()
    other = again.withColumn("v", F.when(F.col("id") == 5, F.lit("w")).otherwise(F.col("v")))
    assert quality.differing_parts(both(rows, other), columns).count() in (1, 2)
    assert {(r.id, r.v, r.source) for r in quality.diff_tables(rows, other).collect()} == {
        (5, "v5", "from prod"),
        (5, "w", "from dev"),
    }
    # The same rows, but not as often: parts differ, distinct rows do not.
    assert quality.diff_tables(rows, again.unionByName(rows.limit(10))).isEmpty()


def test_diff_tables_odd_rows(spark):
    a = spark.createDataFrame([(None, "a", 0.0), ("b", None, None)], "p string, q string, x double")
    b = spark.createDataFrame([("a", None, -0.0), ("b", None, None)], "p string, q string, x double")
    got = {(r.p, r.q, r.source) for r in quality.diff_tables(a, b).collect()}
    assert got == {(None, "a", "from prod"), ("a", None, "from dev")}
    assert quality.diff_tables(a.select("x").limit(1), b.select("x").limit(1)).isEmpty()  # zero has one value
    assert quality.diff_tables(a.limit(0), b.limit(0)).isEmpty()
    assert quality.diff_tables(a.limit(0), b).count() == 2


def test_multi_facts_against_brute_force(spark):
    rng = random.Random(11)
    log = []
    for _ in range(600):
        field = rng.choice([("f1", "Sprint"), ("f2", "SPRINT"), ("versions", "Affects"), ("fixVersions", "Fix"), ("f3", "Other")])
        # Few instants and values: ties, repeated rows and unknown ids. Issue 0 has a third of all changes.
        issue = rng.choice([0, 0, 0, *range(1, 7)])
        log.append((issue, *field, f"2024-01-0{rng.randint(1, 4)}", rng.choice([None, "1", "2", "3", "x"])))
    log += [(90, "f1", "Sprint", "2024-01-01", None), (91, "versions", "Affects", "2024-01-01", None), (92, "f3", "Other", "2024-01-01", "1")]
    starts = {"1": "2024-01-05", "2": None}
    history = spark.createDataFrame(log, "issue_id long, field_id string, field_name string, at string, field_value string").selectExpr(
        "'a' as source_relation", "issue_id", "field_id", "field_name", "cast(at as timestamp) as updated_at", "field_value"
    )
    sprint = spark.createDataFrame([(int(k), v) for k, v in starts.items()], "sprint_id long, s string").selectExpr(
        "'a' as source_relation", "sprint_id", "concat('S', sprint_id) as sprint_name", "sprint_id + 50 as board_id",
        "cast(s as timestamp) as started_at", "cast(null as timestamp) as ended_at", "cast(null as timestamp) as completed_at",
    )
    version = spark.createDataFrame([(1, "v1"), (2, "v2"), (3, "v1")], "version_id long, version_name string").selectExpr(
        "'a' as source_relation", "version_id", "version_name"
    )
    want = {}
    names = {"1": "v1", "2": "v2", "3": "v1"}
    for issue in {r[0] for r in log}:
        rows = [r for r in log if r[0] == issue]
        in_sprint = [r for r in rows if r[2].lower() == "sprint"]
        changed = [[r for r in rows if r[1] == f] for f in ("versions", "fixVersions")]
        if not in_sprint and not any(changed):
            continue
        last = max(in_sprint, key=lambda r: (r[3], starts.get(r[4]) or "", r[4] or ""), default=(None,) * 5)[4]
        shown = []
        for rows in changed:
            at = max((r[3] for r in rows), default=None)
            shown.append(", ".join(sorted(names[r[4]] for r in rows if r[3] == at and r[4] in names)) or None)
        want[issue] = (last, f"S{last}" if last in starts else None, len({r[4] for r in in_sprint} - {None}), *shown)
    got = {
        r.issue_id: (r.current_sprint_id, r.current_sprint_name, r.count_sprint_changes, r.affects_versions, r.fixes_versions)
        for r in issues.issue_multi_facts(history, sprint, version).collect()
    }
    assert got == want
    apart = {r.issue_id: (r.current_sprint_id, r.count_sprint_changes) for r in issues.issue_sprint(history, sprint).collect()}
    assert apart == {i: (w[0], w[2]) for i, w in want.items() if i != 91}
    apart = {r.issue_id: (r.affects_versions, r.fixes_versions) for r in issues.issue_versions(history, version).collect()}
    assert apart == {i: w[3:] for i, w in want.items() if w[3] or w[4]}


def test_a_field_with_most_changes_stays_in_many_tasks(spark):
    """Also if nothing is small enough to be broadcast by its size."""
    log = spark.range(0, 800, numPartitions=8).selectExpr(
        "'' as source_relation", "if(id % 100 = 0, 'f_team', if(id % 100 = 1, 'gone', 'status')) as field_id",
        "id as issue_id", "timestamp '2024-01-01' as updated_at",
    )
    field = spark.range(0, 64, numPartitions=4).selectExpr(
        "'' as source_relation",
        "case id when 0 then 'status' when 1 then 'f_team' else concat('f_', id) end as field_id",
        "case id when 0 then 'Status' when 1 then 'Team' else null end as field_name",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = history.with_field_name(log, field.groupBy("source_relation", "field_id").agg(F.max("field_name").alias("field_name")))
        placed = named.withColumn("task", F.spark_partition_id())
        rows = placed.groupBy("field_name").agg(F.count("*").alias("n"), F.count_distinct("task").alias("tasks"))
        assert {r.field_name: (r.n, r.tasks) for r in rows.collect()} == {"status": (784, 8), "team": (8, 8)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
