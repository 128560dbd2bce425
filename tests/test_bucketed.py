"""Bucketed panel storage: the join of two tables stored alike moves no row."""

from hazardpanel.session import scratch_path
from hazardpanel.sources import sinks

KEYS = ["wilaya_id", "date"]


def _store(spark, df, name, mode="overwrite", at=None):
    path = at or scratch_path(spark, f"test-bucketed-{name}")
    return sinks.write_bucketed(df, path.rpartition("/")[2].replace("-", "_"), path, KEYS, 4, mode), path


def test_join_without_exchange_also_after_an_append(spark):
    grid = spark.range(400).selectExpr("cast(id % 5 as int) wilaya_id", "date_add(DATE'2024-01-01', cast(id / 5 as int)) date")
    daily = grid.filter("day(date) % 3 = 0").selectExpr("*", "wilaya_id * day(date) AS n")
    left, _ = _store(spark, grid, "grid")
    right, path = _store(spark, daily.filter("date < '2024-02-10'"), "daily")
    for part in (daily.filter("date < '2024-02-10'"), daily):
        out = sinks.join_bucketed(left, right, KEYS)
        rows = sorted(map(str, map(tuple, out.select("wilaya_id", "date", "n").collect())))
        assert rows == sorted(map(str, map(tuple, grid.join(part, KEYS, "left").select("wilaya_id", "date", "n").collect())))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan, plan
        right, _ = _store(spark, daily.filter("date >= '2024-02-10'"), "daily", "append", path) if part is not daily else (right, path)
