import numpy as np
from pyspark.sql import functions as F

from hazardpanel.functions.scalar import round_half_even
from hazardpanel.operators.dedup import dedup_keep_first, dedup_keep_last
from hazardpanel.operators.dims import map_or_fail

import pytest


def test_round_half_even_equals_numpy(spark):
    vals = [x / 1000 for x in range(-3000, 3000, 5)] + [2.675, 1.005, 0.125, 0.135, 36.785, -8.675]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


def test_dedup_keep_first_priority_and_idempotent(spark):
    rows = [(1, 0, "a", 10), (1, 1, "a", 5), (2, 1, "b", 1), (2, 0, "b", 9), (3, 0, None, 2)]
    df = spark.createDataFrame(rows, "k int, pri int, s string, id int")
    out = dedup_keep_first(df, ["k", "s"], ["pri", "id"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, 0, "a", 10), (2, 0, "b", 9), (3, 0, None, 2)]
    again = dedup_keep_first(out, ["k", "s"], ["pri", "id"])
    assert sorted(tuple(r) for r in again.collect()) == got
    last = dedup_keep_last(df, ["k"], ["id"])
    assert sorted(tuple(r) for r in last.collect()) == [(1, 0, "a", 10), (2, 0, "b", 9), (3, 0, None, 2)]


def test_map_or_fail_raises_on_unmapped(spark):
    names = spark.createDataFrame([("A",), ("B",), ("Z",)], "name string")
    mapping = spark.createDataFrame([("A", "01"), ("B", "02")], "name string, code string")
    ok = map_or_fail(names.filter("name != 'Z'"), "name", mapping, "name", "code")
    assert sorted(r.code for r in ok.collect()) == ["01", "02"]
    with pytest.raises(Exception) as e:
        map_or_fail(names, "name", mapping, "name", "code").collect()
    assert "unmapped name: Z" in str(e.value)


def test_scale_conf_widths():
    from hazardpanel.session import scale_conf
    c = scale_conf(8000, 100 << 40)          # 1000 executors x 8 cores, 100 TB
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(scale_conf(8, 1 << 20)["spark.sql.shuffle.partitions"]) == 32


def test_official_mapping_and_default_flag(spark):
    from hazardpanel.operators.dims import flag_not_in, official_code_mapping
    mapping = official_code_mapping(spark)
    assert mapping.count() == 58 and mapping.select("code").distinct().count() == 58
    names = mapping.select(F.col("name").alias("wilaya_name"))
    flagged = flag_not_in(names, "wilaya_name")
    assert flagged.filter("is_forest_zone").count() == 36
    coded = map_or_fail(names, "wilaya_name", mapping, "name", "code", "wilaya_code")
    assert coded.filter(F.length("wilaya_code") == 2).count() == 58


def test_surrogate_id_orders_by_the_keys_own_type_and_keeps_null(spark):
    from hazardpanel.operators.dims import surrogate_id
    codes = [None] + [f"k{i:04d}" for i in range(500)]
    keys = spark.createDataFrame([(c,) for c in codes], "code string").repartition(7)
    assert {r.code: r.surrogate_id for r in surrogate_id(keys, "code").collect()} == {c: i + 1 for i, c in enumerate(codes)}
    big = [None, -5] + [2**53 + i for i in range(40)] + [2**63 - 1]        # neighbours that doubles cannot tell apart
    ids = spark.createDataFrame([(v,) for v in reversed(big)], "k long").repartition(5)
    assert {r.k: r.surrogate_id for r in surrogate_id(ids, "k").collect()} == {v: i + 1 for i, v in enumerate(big)}


def test_exact_sum_keeps_five_places_and_any_order(spark):
    from hazardpanel.functions.scalar import exact_sum
    df = spark.range(100_000).select(F.lit(0.00004).alias("x"))
    assert df.agg(exact_sum("x").alias("s")).first().s == 4.0
    mixed = spark.createDataFrame([(0.1,), (1e9,), (0.2,), (-1e9,), (None,)], "x double")
    assert {mixed.repartition(n).agg(exact_sum("x").alias("s")).first().s for n in (1, 2, 5)} == {0.3}


def test_submitted_settings_win():
    """In a session of its own process: 4000 partitions submitted stay 4000."""
    import subprocess
    import sys
    code = ("from hazardpanel.session import get_session; s = get_session('local[1]');"
            "print('width', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.adaptive.enabled'))")
    env = {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=4000 --conf spark.sql.adaptive.enabled=false --conf spark.ui.enabled=false pyspark-shell"}
    import os
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | env, capture_output=True, text=True, timeout=120)
    assert "width 4000 false" in done.stdout, done.stderr[-2000:]


def test_no_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from hazardpanel.session import checkpoint_root
    conf = SimpleNamespace(get=lambda *a: None)
    context = lambda master: SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf)
    for master in ("yarn", "spark://h:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            checkpoint_root(SimpleNamespace(sparkContext=context(master), conf=conf))


def test_daily_agg_all_missing_frp_is_zero_like_pandas(spark):
    import datetime as dt
    from hazardpanel.operators.panel import daily_region_agg
    rows = [(1, dt.date(2024, 1, 1), None), (1, dt.date(2024, 1, 1), None), (2, dt.date(2024, 1, 1), 2.5)]
    df = spark.createDataFrame(rows, "wilaya_id int, acq_date date, frp double")
    got = {r.wilaya_id: (r.nb_detections, r.frp_total, r.frp_max)
           for r in daily_region_agg(df, ("wilaya_id",)).collect()}
    assert got == {1: (0, 0.0, None), 2: (1, 2.5, 2.5)}


def test_empty_inputs_flow_through(spark):
    from hazardpanel import fixtures as fx
    from hazardpanel.plans.rebuild import build_panel
    from tests.conftest import SF_SMALL
    det = fx.detections(spark, SF_SMALL).filter("false")
    panel = build_panel(det, fx.edges(spark, SF_SMALL), None, fx.region_dim(spark, SF_SMALL))
    assert panel.count() == 0
