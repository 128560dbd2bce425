"""Evaluation metrics as distributed aggregations.

Rank metrics group rows by distinct score first (map-side partial
aggregation), then accumulate counts in score order with the bucketed
running totals of ``prefix`` (never a single-partition window).  Integer
sums keep ROC-AUC exact; other metrics are rounded at ``digits``.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardpanel.functions.scalar import round_half_even
from hazardpanel.operators.joins import dimension
from hazardpanel.operators.prefix import running_totals
from hazardpanel.operators.quantiles import exact_quantiles
from hazardpanel.operators.windows import topk_per_group


def _score_groups(df: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score.  Rows whose score is null or
    NaN, or whose label is null, take no part in a rank metric."""
    s, y = F.col(score), F.col(label).cast("long")
    known = df.filter(s.isNotNull() & ~F.isnan(s.cast("double")) & y.isNotNull())
    return known.groupBy(s.alias("_s")).agg(F.sum(y).alias("p"), F.sum(1 - y).alias("n"))


def _ranked(df: DataFrame, score: str, label: str) -> DataFrame:
    return running_totals(_score_groups(df, score, label), "_s", ["p", "n"], descending=True)


def roc_auc(df: DataFrame, score: str = "score", label: str = "y", digits: int | None = None,
            out: str = "roc_auc") -> DataFrame:
    """Mann-Whitney form with tie halves: Σ p·(below + n/2) / (P·N)."""
    r = _ranked(df, score, label)
    agg = r.agg(F.sum("p").alias("P"), F.sum("n").alias("N"),
                F.sum(F.col("p") * (2 * F.col("cum_n") - F.col("n"))).alias("S"))
    # undefined (null) when only one class is present
    val = F.try_divide((2 * F.col("N") * F.col("P") - F.col("S")).cast("double"),
                       (2 * F.col("P") * F.col("N")).cast("double"))
    if digits is not None:
        val = round_half_even(val, digits)
    return agg.select(val.alias(out))


def average_precision(df: DataFrame, score: str = "score", label: str = "y",
                      digits: int | None = None, out: str = "avg_precision") -> DataFrame:
    """Step-wise AP over distinct scores: Σ (p/P) · tp/(tp+fp)."""
    r = _ranked(df, score, label)
    prec = F.col("cum_p").cast("double") / (F.col("cum_p") + F.col("cum_n")).cast("double")
    agg = r.agg(F.try_divide(F.sum(F.col("p") * prec), F.sum("p").cast("double")).alias("ap"))
    val = F.col("ap") if digits is None else round_half_even(F.col("ap"), digits)
    return agg.select(val.alias(out))


def brier(df: DataFrame, proba: str = "proba", label: str = "y", digits: int | None = None,
          out: str = "brier") -> DataFrame:
    val = F.avg(F.pow(F.col(proba) - F.col(label).cast("double"), 2))
    if digits is not None:
        val = round_half_even(val, digits)
    return df.agg(val.alias(out))


def base_metrics(df: DataFrame, label: str = "y") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(F.col(label).cast("long")).alias("n_positive"),
                  (F.sum(F.col(label).cast("long")).cast("double") / F.count(F.lit(1))).alias("base_rate"))


def quantile_bins(df: DataFrame, col: str, q: int = 10, out: str = "bin") -> DataFrame:
    """``qcut(x, q, labels=False, duplicates='drop')``: right-closed bins on
    exact quantile edges, duplicate edges dropped, lowest value in bin 0."""
    edges = sorted(set(exact_quantiles(df, col, [i / q for i in range(q + 1)])))
    if len(edges) < 2:  # one distinct value: no interval, every bin is missing (as in pandas)
        return df.withColumn(out, F.lit(None).cast("int"))
    interior = edges[1:-1]
    if not interior:
        return df.withColumn(out, F.lit(0).cast("int"))
    arr = F.array(*[F.lit(float(e)) for e in interior])
    x = F.col(col).cast("double")
    return df.withColumn(out, F.when(x.isNull(), F.lit(None))
                         .otherwise(F.size(F.filter(arr, lambda e: e < x))).cast("int"))


def calibration_table(df: DataFrame, proba: str = "proba", label: str = "y", q: int = 10,
                      digits: int = 4) -> DataFrame:
    """Mean predicted probability, observed rate and size per quantile bin."""
    binned = quantile_bins(df, proba, q, "decile")
    return binned.groupBy("decile").agg(
        round_half_even(F.avg(proba), digits).alias("proba_mean"),
        round_half_even(F.avg(F.col(label).cast("double")), digits).alias("observed_rate"),
        F.count(F.lit(1)).alias("n"))


def alert_budget(df: DataFrame, day: str = "day", label: str = "y", score: str = "score",
                 k: int = 8, tiebreak: str = "event_id", digits: int | None = None) -> DataFrame:
    """Daily top-k alerts: recall averaged over days with a positive,
    precision averaged over all days (hits / alerts issued that day)."""
    top = topk_per_group(df, day, score, k, tiebreak)
    hits = top.groupBy(day).agg(F.sum(F.col(label).cast("long")).alias("hits"),
                                F.count(F.lit(1)).alias("n_alerts"))
    pos = df.groupBy(day).agg(F.sum(F.col(label).cast("long")).alias("positives"))
    j = pos.join(hits, day)
    recall = F.avg(F.when(F.col("positives") > 0, F.col("hits") / F.col("positives")))
    precision = F.avg(F.col("hits") / F.col("n_alerts"))
    if digits is not None:
        recall, precision = round_half_even(recall, digits), round_half_even(precision, digits)
    return j.agg(recall.alias(f"recall_at_{k}"), precision.alias(f"precision_at_{k}"))


def balanced_weights(df: DataFrame, label: str = "y", out: str = "weight") -> DataFrame:
    """``n / (2 * n_class)`` per row, via a two-row broadcast join."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    # one row per class: a window over this tiny table is bounded
    w = counts.select(label, (F.sum("_nc").over(Window.partitionBy()).cast("double")
                              / (F.lit(2.0) * F.col("_nc"))).alias(out))
    return df.join(dimension(w), label)


def best_by(metrics: DataFrame, name_col: str, metric_col: str, tolerance: float = 0.0,
            simplicity_col: str | None = None) -> DataFrame:
    """Pick the best row by ``metric_col`` (of equal ones the first name, which is
    the listing order of the variants); with ``tolerance`` > 0, the simplest
    (smallest ``simplicity_col``) among those within ``tolerance`` of the best."""
    if tolerance <= 0 or simplicity_col is None:
        return metrics.agg(F.min_by(name_col, F.when(F.col(metric_col).isNotNull(), F.struct(-F.col(metric_col), F.col(name_col)))).alias(f"best_{name_col}"),
                           F.max(metric_col).alias(f"best_{metric_col}"))
    # metrics tables hold one row per variant: a window over them is bounded
    near = (metrics.withColumn("_m", F.max(metric_col).over(Window.partitionBy()))
                   .filter(F.col(metric_col) >= F.col("_m") - F.lit(tolerance)))
    return near.agg(F.min_by(name_col, F.struct(F.col(simplicity_col), -F.col(metric_col), F.col(name_col))).alias(f"best_{name_col}"),
                    F.max(metric_col).alias(f"best_{metric_col}"))


def rank_metrics(df: DataFrame, proba: str = "proba", label: str = "y", digits: int | None = None,
                 pr_name: str = "pr_auc") -> DataFrame:
    """ROC-AUC, average precision and Brier in one pass over the score groups.

    With the probability as score, a group of ``p`` positives and ``n``
    negatives at score ``s`` contributes ``p·(s-1)² + n·s²`` to the Brier sum.
    """
    r = _ranked(df, proba, label)
    prec = F.col("cum_p").cast("double") / (F.col("cum_p") + F.col("cum_n")).cast("double")
    s = F.col("_s").cast("double")
    agg = r.agg(F.sum("p").alias("P"), F.sum("n").alias("N"),
                F.sum(F.col("p") * (2 * F.col("cum_n") - F.col("n"))).alias("S"),
                F.sum(F.col("p") * prec).alias("AP"),
                F.sum(F.col("p") * F.pow(s - 1.0, 2) + F.col("n") * F.pow(s, 2)).alias("SQ"))
    roc = F.try_divide((2 * F.col("N") * F.col("P") - F.col("S")).cast("double"),
                       (2 * F.col("P") * F.col("N")).cast("double"))
    ap = F.try_divide(F.col("AP"), F.col("P").cast("double"))
    br = F.try_divide(F.col("SQ"), (F.col("P") + F.col("N")).cast("double"))
    if digits is not None:
        ap, br = round_half_even(ap, digits), round_half_even(br, digits)
    return agg.select(roc.alias("roc_auc"), ap.alias(pr_name), br.alias("brier"))


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Place one-row metric frames next to each other without a join.

    Each frame is unpivoted to (metric, value), the pieces are unioned, and one
    conditional aggregate turns them back into a single row (all doubles).
    """
    names: list[str] = []
    longs = None
    for df in frames:
        cols = df.columns
        names += cols
        piece = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
                  .unpivot([], cols, "metric", "value")
        longs = piece if longs is None else longs.unionByName(piece)
    return longs.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
