"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from fieldtrail import Tracker
from fieldtrail.operators import issues
from fixtures.queries import tracker

TABLES = [*Tracker.TABLES, "daily_status_category", "cumulative_flow", "issue_calendar_spine"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, small):
    return tracker(spark, small)


@pytest.mark.parametrize("name", TABLES)
def test_no_cross_joins_and_no_python(tables, name):
    text = plan(getattr(tables, name))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in text


def test_daily_history_shuffles(tables):
    """Multi-select batches, last value per day, repartition by issue, and the fixture's issue table; besides, the
    fixture derives fields (for two logs) and field options (for two columns) by aggregation."""
    text = plan(tables.daily_issue_field_history)
    assert text.count("Exchange hashpartitioning") == 4 + 4
    assert text.count("Window [") == 2


def test_day_counts_need_no_day_rows(tables):
    """The only sequence of days comes after the last aggregation."""
    text = plan(tables.daily_status_category)
    generate = [i for i in range(len(text)) if text.startswith("Generate explode(sequence", i)]
    assert len(generate) == 1
    assert generate[0] < text.index("HashAggregate")


def test_timestamp_history_uses_one_window_shuffle(tables):
    text = plan(tables.issue_status_transitions)
    # Four more are those of the fixture's own dimensions.
    assert text.count("Exchange hashpartitioning") == 3 + 4


def test_week_filter_prunes_partitions(spark, tables):
    from fieldtrail.sources.tables import read_table, shared_folder, write_weeks

    path = shared_folder(spark, "test")
    write_weeks(tables.daily_issue_field_history, path, "date_week")
    recent = read_table(spark, path).filter("date_week >= date '2024-01-22'").select("issue_id", "status")
    text = plan(recent)
    assert "PartitionFilters: [isnotnull(date_week" in text
    assert "ReadSchema: struct<issue_id:bigint,status:string>" in text


def test_log_filters_reach_the_scan(spark, tables):
    """Irrelevant fields and old changes are filtered in the scan of a stored log."""
    from fieldtrail.sources.tables import read_table, shared_folder, write_table
    from fieldtrail.sources.staging import stage

    path = shared_folder(spark, "test")
    log = tables.raw["issue_field_history"].withColumn("time", F.col("time").cast("timestamp"))
    write_table(log, path)
    staged = stage("issue_field_history", read_table(spark, path), tables.cfg)
    text = plan(staged.filter(F.col("updated_at") >= F.lit("2024-01-22").cast("timestamp")).select("issue_id"))
    assert "GreaterThanOrEqual(time" in text
    assert "ReadSchema: struct<issue_id:bigint,time:timestamp>" in text


def test_issue_join_reads_each_log_once(spark, tables):
    """One aggregation of the log of single values; two, by change and by issue, of the other one."""
    facts = issues.issue_log_facts(tables.single_history)
    fixture = plan(tables.single_history).count("Exchange")
    assert plan(facts).count("Exchange") == fixture + 1
    facts = issues.issue_multi_facts(tables.multi_history, tables.staged["sprint"], tables.staged["version"])
    fixture = sum(plan(df).count("Exchange") for df in (tables.multi_history, tables.staged["sprint"], tables.staged["version"]))
    joins = plan(facts).count("Exchange") - fixture - 2
    assert plan(facts).count("Join") == plan(tables.multi_history).count("Join") + 2
    assert joins <= 4  # what the two look-ups need: a broadcast each, or two shuffles
    assert "Window" not in plan(facts)
