"""The incremental spot list equals the list computed from all raw rows."""

import datetime as dt
import random

import pytest

from hazardpanel.operators.persistence import recurring_spot_table
from hazardpanel.plans import spots as S
from hazardpanel.session import scratch_path
from hazardpanel.sources import committed

SCHEMA = "latitude double, longitude double, acq_date date, type int"


def _feed(rng, n):
    day = lambda: dt.date(1969, 11, 20) + dt.timedelta(days=rng.randint(0, 140))
    rows = [(round(rng.randint(0, 5) / 100 + 36, 2), 3.0, day(), rng.choice([0, 0, None, 2])) for _ in range(n)]
    return rows + [(None, None, day(), 0) for _ in range(8)] + [(36.0, 3.0, None, 0), (36.0, 3.0, dt.date(2024, 2, 29), 0)]


def _list(df):
    return sorted(map(str, (tuple(r) for r in df.select("lat_grid", "lon_grid", "n_days_detected").collect())))


def test_equal_after_every_feed(spark):
    rng, store, held = random.Random(2), scratch_path(spark, "test-spots"), {}
    # a feed sent again with fewer rows, and one sent again empty
    for name, rows in [("a", _feed(rng, 60)), ("b", _feed(rng, 60)), ("c", _feed(rng, 5)), ("a", _feed(rng, 10)), ("b", [])]:
        held[name] = rows
        S.update_spot_list(spark, store, name, spark.createDataFrame(rows, SCHEMA), threshold=6)
        want = recurring_spot_table(spark.createDataFrame([r for f in held.values() for r in f], SCHEMA), 6)
        assert _list(S.read_spot_list(spark, store)) == _list(want), name
    assert _list(S.read_spot_list(spark, store, 2)) != _list(S.read_spot_list(spark, store))


def test_list_recovers_from_a_stop_between_its_two_commits(spark, monkeypatch):
    rng, store = random.Random(3), scratch_path(spark, "test-spots")
    a, b, c = _feed(rng, 60), _feed(rng, 60), _feed(rng, 3)
    S.update_spot_list(spark, store, "a", spark.createDataFrame(a, SCHEMA), threshold=6)
    whole = committed.replace

    def stops(spark, path, *args, **kw):
        if path.endswith("/spots"):
            raise KeyboardInterrupt
        return whole(spark, path, *args, **kw)
    with monkeypatch.context() as m:
        m.setattr(committed, "replace", stops)
        with pytest.raises(KeyboardInterrupt):
            S.update_spot_list(spark, store, "b", spark.createDataFrame(b, SCHEMA), threshold=6)
    assert _list(S.read_spot_list(spark, store)) == _list(recurring_spot_table(spark.createDataFrame(a, SCHEMA), 6))
    S.update_spot_list(spark, store, "c", spark.createDataFrame(c, SCHEMA), threshold=6)       # another feed is next
    assert _list(S.read_spot_list(spark, store)) == _list(recurring_spot_table(spark.createDataFrame(a + b + c, SCHEMA), 6))


def test_untouched_cells_are_not_counted_again(spark, monkeypatch):
    store, day = scratch_path(spark, "test-spots"), dt.date(2024, 1, 1)
    far = [(10.0, 1.0, day + dt.timedelta(days=i), 0) for i in range(9)]
    S.update_spot_list(spark, store, "a", spark.createDataFrame(far, SCHEMA), threshold=6)
    counted = []
    count = S.days_per_cell
    monkeypatch.setattr(S, "days_per_cell", lambda rows: counted.append(rows.count()) or count(rows))
    S.update_spot_list(spark, store, "b", spark.createDataFrame([(20.0, 1.0, day, 0)], SCHEMA), threshold=6)
    assert counted == [1] and len(_list(S.read_spot_list(spark, store))) == 1
