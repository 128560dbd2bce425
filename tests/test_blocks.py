"""Windows in blocks against windows over whole series."""

import datetime as dt
import random

import pytest

from hazardpanel.operators.blocks import dryness_in_blocks, row_places, with_blocks
from hazardpanel.operators.windows import dryness_features

SCHEMA = "wilaya_id int, date date, precipitation_sum double, temperature_2m_max double, et0_fao_evapotranspiration double"


def _panel(spark, lengths, wet=0.02, seed=3):
    rng = random.Random(seed)
    some = lambda v: None if rng.random() < 0.2 else round(v, 2)
    rows = [(s, dt.date(1990, 1, 1) + dt.timedelta(days=i * (2 if i > 50 else 1)),
             some(rng.random() * 0.9 + (rng.random() < wet) * 5), some(rng.uniform(-5, 45)), some(rng.random() * 9))
            for s, n in lengths.items() for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("block_rows,n_ranges", [(30, 7), (97, 3), (5000, None)])
def test_equal_windows_over_whole_series(spark, block_rows, n_ranges):
    panel = _panel(spark, {1: 900, 2: 400, 3: 1, None: 130})
    assert _rows(dryness_in_blocks(panel, block_rows=block_rows, n_ranges=n_ranges)) == _rows(dryness_features(panel))


def test_an_event_is_carried_over_many_blocks(spark):
    panel = _panel(spark, {1: 300}, wet=0)
    wet = panel.selectExpr("wilaya_id", "date", "if(date = '1990-01-05', 3D, 0D) AS precipitation_sum",
                           "temperature_2m_max", "et0_fao_evapotranspiration")
    got = dryness_in_blocks(wet, cap=1000, block_rows=30, n_ranges=4)
    assert [r[0] for r in got.orderBy("date").select("days_since_rain").collect()] == [*range(5), *range(295)]


def test_a_long_series_is_many_windows(spark):
    blocked = with_blocks(row_places(_panel(spark, {1: 1000}), "wilaya_id", "date", 4), 30, 50)
    sizes = {r[0]: r[1] for r in blocked.groupBy("_block").count().collect()}
    assert len(sizes) == 21 and max(sizes.values()) == 80       # the last holds only a halo
    assert sorted(r[0] for r in blocked.filter("not _halo").select("_place").collect()) == list(range(1, 1001))


def test_empty_table_and_halo_longer_than_a_block(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dryness_in_blocks(empty).columns == dryness_features(empty).columns and dryness_in_blocks(empty).count() == 0
    with pytest.raises(ValueError):
        dryness_in_blocks(empty, block_rows=29)
