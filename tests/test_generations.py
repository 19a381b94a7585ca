"""Tables that change all at once: failed runs, conflicts, and what incremental runs read."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from test_properties import same, tracker

from fieldtrail.plans import incremental
from fieldtrail.plans.incremental import read_daily, update_daily
from fieldtrail.plans.model import Tracker
from fieldtrail.sources.generations import Store
from fieldtrail.sources.tables import shared_folder

from fixtures.queries import CONFIG


def at(base, as_of, **cfg):
    t = Tracker(dict(base.raw), CONFIG.with_(as_of=as_of, **cfg))
    raw = dict(base.raw)
    for log in ("issue_field_history", "issue_multiselect_history"):
        raw[log] = raw[log].filter(F.col("time") <= t.cfg.now())
    raw["issue"] = raw["issue"].filter(F.col("created") <= t.cfg.now()).withColumn(
        "resolved", F.when(F.col("resolved") <= t.cfg.now(), F.col("resolved"))
    )
    return Tracker(raw, t.cfg)


class Stopped(Exception):
    pass


def test_a_run_that_fails_changes_nothing(spark, small, monkeypatch):
    """Each step of a run fails in turn; then it succeeds."""
    base = tracker(spark, small)
    path = shared_folder(spark, "test")
    first, second = at(base, "2024-01-24 12:00:00"), at(base, CONFIG.as_of)
    update_daily(first, path)
    before = sorted(map(tuple, read_daily(spark, path).collect()), key=str)
    commits = Store(spark, path).current().number
    write, commit = Store.write, Store.commit
    for step in range(5):
        calls = iter(range(100))

        def failing(method):
            def run(*args, **kwargs):
                if next(calls) == step:
                    raise Stopped
                return method(*args, **kwargs)

            return run

        monkeypatch.setattr(Store, "write", failing(write))
        monkeypatch.setattr(Store, "commit", failing(commit))
        with pytest.raises(Stopped):
            update_daily(second, path)
        assert Store(spark, path).current().number == commits
    assert sorted(map(tuple, read_daily(spark, path).collect()), key=str) == before
    monkeypatch.undo()
    same(update_daily(second, path), second.daily_issue_field_history)
    same(read_daily(spark, path), second.daily_issue_field_history)


def test_older_changes_are_not_read(spark, small):
    """All stored changes before the cut are made unreadable; state and recent weeks are enough."""
    base = tracker(spark, small)
    path = shared_folder(spark, "test")
    for as_of in ("2024-01-18 00:00:00", "2024-01-25 00:00:00"):
        update_daily(at(base, as_of), path)
    store = Store(spark, path)
    commit = store.current()
    cut = dt.date.fromisoformat(commit.notes["state_cut"])
    old = commit.tables["daily_changes"].before(cut)
    files = [f for week, g in old.items() for f in glob.glob(f"{path}/daily_changes/generation={g}/*={week}/*.parquet")]
    assert files
    for file in files:
        with open(file, "wb") as broken:
            broken.write(b"no table")
    last = at(base, "2024-01-26 00:00:00")
    same(update_daily(last, path), last.daily_issue_field_history)
    assert store.read(store.current().tables["issue_state"], "issue_state").count() <= last.staged["issue"].count()


def test_a_longer_lookback_goes_back(spark, small):
    base = tracker(spark, small)
    path = shared_folder(spark, "test")
    for as_of, weeks in (("2024-01-18 00:00:00", 1), ("2024-01-25 00:00:00", 1), ("2024-01-26 00:00:00", 3)):
        t = at(base, as_of, lookback_weeks=weeks)
        same(update_daily(t, path), t.daily_issue_field_history)


def test_incremental_runs_go_on_from_a_build(spark, small):
    base = tracker(spark, small)
    path = shared_folder(spark, "test")
    at(base, "2024-01-24 12:00:00").build(path)
    last = at(base, CONFIG.as_of)
    same(update_daily(last, path), last.daily_issue_field_history)


def test_commits(spark):
    store = Store(spark, shared_folder(spark, "test"))
    rows = lambda v: spark.createDataFrame([(v, dt.date(2024, 1, 1)), (v, dt.date(2024, 1, 8))], "v int, w date")
    start = store.current()
    assert start.number == 0 and store.current().tables == {}
    done = store.commit(start, {"t": store.write(rows(1), "t", "w")}, {"a": "b"})
    with pytest.raises(Exception, match="exist"):  # someone else was faster
        store.commit(start, {"t": store.write(rows(2), "t", "w")})
    assert {r.v for r in store.read(store.current().tables["t"], "t").collect()} == {1}
    for v in (3, 4, 5):
        late = store.write(rows(v).filter("w > date '2024-01-01'"), "t", "w")
        week = type(late)(late.schema, late.week, done.tables["t"].before(dt.date(2024, 1, 8)) | late.folders)
        done = store.commit(done, {"t": week})
        store.clean()
    assert sorted(r.v for r in store.read(done.tables["t"], "t").collect()) == [1, 5]
    assert [r.v for r in store.read(done.tables["t"], "t", since=dt.date(2024, 1, 8)).collect()] == [5]
    assert store.current().notes == {"a": "b"} and store.current().weeks("t") == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
    left = len(glob.glob(f"{store.root}/t/generation=*"))
    store.clean(orphans_after_hours=-1)  # also the one whose commit failed
    assert len(glob.glob(f"{store.root}/t/generation=*")) < left
    assert sorted(r.v for r in store.read(store.current().tables["t"], "t").collect()) == [1, 5]


def test_weeks_of_the_cut(spark):
    assert incremental.week_cut([], CONFIG).weekday() == 0
