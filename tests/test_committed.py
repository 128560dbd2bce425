"""Committed tables: readers see one commit, stopped writers leave no trace."""

import datetime as dt

import pytest

from hazardpanel.plans.refresh import commit_window_replace, window_replace
from hazardpanel.session import scratch_path
from hazardpanel.sources import committed

D = dt.date


def _daily(spark, rows):
    return spark.createDataFrame(rows, "wilaya_id int, date date, n long")


def _rows(df):
    return sorted((r.date, r.wilaya_id, r.n) for r in df.select("date", "wilaya_id", "n").collect())


def test_window_replace_is_one_commit(spark):
    path = scratch_path(spark, "test-committed")
    stored = _daily(spark, [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 3), 7), (1, D(2024, 1, 5), 2), (2, D(2024, 1, 6), 3), (1, D(2024, 1, 9), 4)])
    assert commit_window_replace(spark, path, stored) == 1
    reader = committed.read(spark, path)        # began before the change
    new = _daily(spark, [(1, D(2024, 1, 5), 20), (2, D(2024, 1, 7), 30)])
    want = _rows(window_replace(stored, new, period_start=D(2024, 1, 2)))
    for version in (2, 3):                      # idempotent
        assert commit_window_replace(spark, path, new, period_start=D(2024, 1, 2)) == version
        assert _rows(committed.read(spark, path)) == want
    assert _rows(reader) == _rows(stored) == _rows(committed.read(spark, path, 1))
    assert commit_window_replace(spark, path, _daily(spark, [])) == 3
    # a window without any new row is emptied by name only
    assert commit_window_replace(spark, path, _daily(spark, []), window_start=D(2024, 1, 7)) == 4
    assert _rows(committed.read(spark, path)) == [r for r in want if r[0] < D(2024, 1, 7)]
    gone = committed.vacuum(spark, path, keep=1)
    assert len(gone) >= 1 and committed.versions(spark, path) == [4]
    assert _rows(committed.read(spark, path)) == [r for r in want if r[0] < D(2024, 1, 7)]


def test_stop_before_the_commit_leaves_the_table(spark, monkeypatch):
    path = scratch_path(spark, "test-committed")
    stored, new = _daily(spark, [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 5), 2)]), _daily(spark, [(1, D(2024, 1, 5), 50)])
    commit_window_replace(spark, path, stored)
    with monkeypatch.context() as m:            # the days are written, the job ends before the rename
        m.setattr(committed, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            commit_window_replace(spark, path, new)
    assert _rows(committed.read(spark, path)) == _rows(stored)
    commit_window_replace(spark, path, new)     # the retry
    assert _rows(committed.read(spark, path)) == [(D(2024, 1, 1), 1, 1), (D(2024, 1, 5), 1, 50)]
    assert len(committed.vacuum(spark, path)) == 1          # what the stopped job left


def test_two_writers_and_other_columns(spark):
    path = scratch_path(spark, "test-committed")
    commit_window_replace(spark, path, _daily(spark, [(1, D(2024, 1, 1), 1)]))
    with pytest.raises(RuntimeError, match="another writer"):
        committed.publish(spark, path, 0, {"live": {}, "note": None})
    with pytest.raises(ValueError, match="differ"):
        committed.replace(spark, path, spark.createDataFrame([(D(2024, 1, 1), 1)], "date date, m int"), "date")
    with pytest.raises(ValueError, match="no commit"):
        committed.read(spark, scratch_path(spark, "none"))
    assert _rows(committed.read(spark, path)) == [(D(2024, 1, 1), 1, 1)]


def test_job_refreshes_a_committed_table_in_place(spark):
    from hazardpanel import jobs
    path = scratch_path(spark, "test-committed")
    commit_window_replace(spark, path, _daily(spark, [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 5), 2)]))
    assert _rows(jobs.stored_table(spark, path)) == [(D(2024, 1, 1), 1, 1), (D(2024, 1, 5), 1, 2)]
    jobs.replace_in_place(spark, path, _daily(spark, [(1, D(2024, 1, 5), 9)]))
    assert _rows(jobs.stored_table(spark, path)) == [(D(2024, 1, 1), 1, 1), (D(2024, 1, 5), 1, 9)]
