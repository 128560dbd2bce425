"""Every SQL-expressible key equals its DuckDB twin (exact values) on sf0.001."""

import pandas as pd
import pytest

import __spark_entry__ as ent
from hazardpanel.constants import PANEL_COLUMNS
from tools.check_oracle import rows_of
from tests.conftest import SF_SMALL

ORACLE = ent.oracle_sql()
KEYS = sorted(k for k in ORACLE if not k.startswith("op"))


def test_every_key_has_callable():
    qs = ent.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 75


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_duckdb(spark, duck, key):
    df = ent.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())


MODEL_KEYS = {"gbt_train", "gbt_score", "model_roundtrip", "perm_importance", "variant_grid"}


def test_every_other_key_is_a_model_key():
    library = {k for k in ent.queries() if not k.startswith("op") and k != "pipeline"}     # those have their own tests
    assert library - set(ORACLE) == MODEL_KEYS


def test_model_keys_learn_the_label(spark, duck):
    """The five keys without a twin, at their full settings, on a label that can be learnt."""
    from hazardpanel.plans.training import V1_FEATURES
    run = {k: ent.queries()[k](spark, SF_SMALL) for k in sorted(MODEL_KEYS)}
    scores = [tuple(r) for r in run["gbt_score"].select("wilaya_id", "date", "label", "proba").collect()]
    assert scores and all(0 <= r[3] <= 1 for r in scores)
    duck.register("scores_in", pd.DataFrame(scores, columns=["wilaya_id", "date", "label", "proba"]))
    auc, brier = duck.execute("""
        WITH r AS (SELECT label, proba, rank() OVER (ORDER BY proba) + (count(*) OVER (PARTITION BY proba) - 1) / 2.0 AS k FROM scores_in)
        SELECT (sum(k) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * sum(1 - label)), avg(pow(proba - label, 2)) FROM r""").fetchone()
    assert auc > 0.6
    from hazardpanel.operators import metrics as M
    ours = M.rank_metrics(run["gbt_score"], "proba", "label").first()
    assert ours.roc_auc == pytest.approx(auc, abs=1e-9) and ours.brier == pytest.approx(brier, abs=1e-9)
    assert sorted(map(tuple, run["model_roundtrip"].select("wilaya_id", "date", "label", "proba").collect())) == sorted(scores)
    weight = {r.feature: r.importance for r in run["gbt_train"].collect()}
    assert set(weight) == {*V1_FEATURES, "wilaya_id"} and sum(weight.values()) == pytest.approx(1)
    drop = {r.feature: r.importance for r in run["perm_importance"].collect()}
    assert set(drop) == set(weight) and max(drop, key=drop.get) in {"temperature_2m_max", "temperature_2m_mean", "precipitation_sum", "rain_sum", "shortwave_radiation_sum"}
    grid = {r.variant: r for r in run["variant_grid"].collect()}
    assert sorted(grid) == ["A_ref", "B_dow", "C_balanced", "D_dow_balanced"]
    assert all(r.roc_auc > 0.6 and 0 < r.recall_at_8 <= 1 and 0 < r.precision_at_8 <= 1 for r in grid.values())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() == 750
    assert df.columns == PANEL_COLUMNS and len(df.columns) == 26
