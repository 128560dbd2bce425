import datetime as dt

from pyspark.sql import functions as F

from hazardpanel.plans.refresh import rolling_archive, window_replace, write_window_replace
from hazardpanel.session import scratch_path

D = dt.date


def _daily(spark, rows):
    return spark.createDataFrame(rows, "wilaya_id int, date date, n long")


def test_window_replace_semantics_and_idempotence(spark):
    stored = _daily(spark, [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 5), 2), (2, D(2024, 1, 6), 3),
                            (1, D(2024, 1, 9), 4)])
    new = _daily(spark, [(1, D(2024, 1, 5), 20), (2, D(2024, 1, 7), 30)])
    out = window_replace(stored, new, period_start=D(2024, 1, 2))
    got = sorted(tuple(r) for r in out.collect())
    # day 1 dropped (before period), 1-5 replaced, 1-6 and 1-9 gone (on/after window start), new kept
    assert got == [(1, D(2024, 1, 5), 20), (2, D(2024, 1, 7), 30)]
    again = window_replace(out, new, period_start=D(2024, 1, 2))
    assert sorted(tuple(r) for r in again.collect()) == got


def test_empty_refresh_leaves_table_unchanged(spark):
    stored = _daily(spark, [(1, D(2024, 1, 1), 1)])
    empty = _daily(spark, [])
    assert window_replace(stored, empty).collect() == stored.collect()


def test_partitioned_window_replace(spark):
    path = scratch_path(spark, "test-window-replace")
    stored = _daily(spark, [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 5), 2), (1, D(2024, 1, 6), 3)])
    stored.write.partitionBy("date").parquet(path)
    new = _daily(spark, [(1, D(2024, 1, 5), 50)])
    for _ in range(2):  # idempotent
        write_window_replace(spark, path, new)
        got = sorted((r.date, r.n) for r in spark.read.parquet(path).collect())
        assert got == [(D(2024, 1, 1), 1), (D(2024, 1, 5), 50)]


def test_rolling_archive_keeps_last_and_retention(spark):
    log = spark.createDataFrame([
        (D(2024, 3, 1), D(2024, 3, 2), 1, 10.0, 1), (D(2024, 3, 1), D(2024, 3, 2), 1, 11.0, 2),
        (D(2023, 12, 1), D(2023, 12, 2), 1, 5.0, 3)],
        "issued_date date, target_date date, wilaya_id int, temperature_2m_max double, arrival long")
    out = rolling_archive(log, None, D(2024, 3, 1), 60).collect()
    assert [(r.temperature_2m_max, r.arrival) for r in out] == [(11.0, 2)]


def test_partitioned_rolling_archive(spark):
    from hazardpanel.plans.refresh import write_rolling_archive
    schema = "issued_date date, target_date date, wilaya_id int, temperature_2m_max double, arrival long"
    path = scratch_path(spark, "test-archive")
    day1 = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 2), 1, 10.0, 1)], schema)
    write_rolling_archive(spark, path, day1, D(2024, 1, 1), 60)
    reissue = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 2), 1, 12.0, 2),
                                     (D(2024, 3, 5), D(2024, 3, 6), 1, 20.0, 3)], schema)
    for _ in range(2):  # idempotent
        write_rolling_archive(spark, path, reissue, D(2024, 3, 5), 60)
        got = sorted((r.issued_date, r.temperature_2m_max) for r in spark.read.parquet(path).collect())
        assert got == [(D(2024, 3, 5), 20.0)]          # Jan 1 expired after the 60-day retention
    write_rolling_archive(spark, path, reissue.filter("arrival = 2"), D(2024, 1, 10), 60)
    got = sorted((r.issued_date, r.temperature_2m_max) for r in spark.read.parquet(path).collect())
    assert got == [(D(2024, 1, 1), 12.0), (D(2024, 3, 5), 20.0)]


def test_year_partition_pruning_on_split(spark):
    """Era filter / temporal split on a year-partitioned panel prunes partitions."""
    from hazardpanel.operators.features import temporal_split
    from hazardpanel.sources import sinks
    rows = [(1, D(2010 + y, 6, 1), float(y)) for y in range(12)]
    path = scratch_path(spark, "test-pruning")
    sinks.write_parquet_by_year(spark.createDataFrame(rows, "wilaya_id int, date date, v double"), path)
    panel = spark.read.parquet(path)
    split = temporal_split(panel.filter(F.col("year") >= 2015), "2015-01-01", "2019-12-31", None)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert sorted(r.split for r in split.collect()).count("train") == 5


def test_lookback_request_starts(spark):
    from hazardpanel.functions.dates import lookback_starts
    df = spark.createDataFrame([(D(2024, 7, 20),)], "today date")
    got = df.select(lookback_starts(F.col("today")).alias("s")).first().s
    assert got == [D(2024, 7, 6), D(2024, 7, 11), D(2024, 7, 16)]


def test_archive_of_another_layout_is_not_overwritten(spark):
    import datetime as dt

    import pytest
    from hazardpanel.plans.refresh import write_rolling_archive
    from hazardpanel.session import scratch_path
    path = scratch_path(spark, "test-archive-layout")
    day = dt.date(2024, 1, 1)
    rows = [(day, day, r, 1.0, 1) for r in (1, 2)]
    schema = "issued_date date, target_date date, wilaya_id int, temperature_2m_max double, arrival long"
    write_rolling_archive(spark, path, spark.createDataFrame(rows, schema), day)
    fewer = spark.createDataFrame([r[:3] + r[4:] for r in rows[:1]], "issued_date date, target_date date, wilaya_id int, arrival long")
    with pytest.raises(ValueError):
        write_rolling_archive(spark, path, fewer, day)
    assert spark.read.parquet(path).count() == 2
    again = spark.createDataFrame([(day, day, 1, 5.0, 2)], schema)
    for _ in range(2):                                   # a second run changes nothing
        write_rolling_archive(spark, path, again, day)
        assert sorted((r.wilaya_id, r.temperature_2m_max) for r in spark.read.parquet(path).collect()) == [(1, 5.0), (2, 1.0)]
