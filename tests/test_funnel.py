"""The funnel from the rebuild's own pass, for both type rules."""

import pytest
from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel.constants import DETECTION_KEY
from hazardpanel.operators.dedup import dedup_keep_first
from hazardpanel.operators.funnel import stage_funnel
from hazardpanel.operators.persistence import drop_recurring, persistent_cells, with_grid
from hazardpanel.operators.spatial import assign_region
from hazardpanel.plans.rebuild import detection_chain
from tests.conftest import SF_SMALL


def by_hand(det, edges, strict, threshold):
    """Every stage as rows, counted one by one."""
    ded = dedup_keep_first(det, DETECTION_KEY, ["pri", "event_id"])
    placed = with_grid(assign_region(ded, edges))
    matched = placed.filter("wilaya_id is not null")
    typed = matched.filter("type = 0" if strict else "type = 0 or type is null")
    spots = persistent_cells(typed, threshold)
    return {"raw": det.count(), "dedup": ded.count(), "overlap_pairs": placed.agg(F.sum("n_matches")).first()[0], "matched": matched.count(),
            "type_kept": typed.count(), "recurring_spots": spots.count(), "persistence_kept": drop_recurring(typed, spots).count()}


@pytest.mark.parametrize("strict", [False, True])
def test_report_of_the_chain(spark, strict):
    det, edges, dim = fx.detections(spark, SF_SMALL), fx.edges(spark, SF_SMALL), fx.region_dim(spark, SF_SMALL)
    plain = detection_chain(det, edges, dim, strict_type=strict, threshold=5)
    told = detection_chain(det, edges, dim, strict_type=strict, threshold=5, report=True)
    want = by_hand(det, edges, strict, 5)
    assert want["type_kept"] > want["persistence_kept"] > 0 and want["recurring_spots"] > 0
    for funnel in (told.funnel, stage_funnel(det, edges, threshold=5, strict=strict)):
        rows = sorted(funnel.collect(), key=lambda r: r.step)
        assert [r.step for r in rows] == list(range(7)) and {r.stage: r.n_rows for r in rows} == want
    for name in ("deduped", "matched", "summary", "spots", "kept", "daily"):
        a, b = getattr(plain, name), getattr(told, name)
        assert sorted(a.columns) == sorted(b.columns), name
        assert a.select(*sorted(a.columns)).exceptAll(b.select(*sorted(a.columns))).count() == 0 and a.count() == b.count(), name
    # the report reads the summary table only
    plan = told.funnel._jdf.queryExecution().optimizedPlan().toString()
    assert "events" not in plan and "placed-summary" in told.funnel.inputFiles()[0]


def test_of_nothing(spark):
    det, edges = fx.detections(spark, SF_SMALL).limit(0), fx.edges(spark, SF_SMALL)
    assert {r.n_rows for r in stage_funnel(det, edges).collect()} == {0}
