"""Exact quantiles by bracket refinement: no sort and no range shuffle of the values.

1. Splitters from a mergeable sketch (``percentile_approx``) cut the values into
   brackets; every splitter is a bracket of its own, so a value that holds a third of
   all rows is one bracket and resolved at once.
2. One scan counts each bracket (a partial aggregation: a row per bracket and task).
   The counts are exact, so they tell which bracket holds each wanted rank; the
   sketch only balances them.
3. A bracket with a wanted rank and more than ``LIMIT`` rows gets splitters of its own
   and is counted again; at a thousandth of the rows per round, 10^12 rows take four.
   Of the others only the values of the brackets with a wanted rank are grouped, at
   most ``LIMIT`` rows for each of the ranks.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.session import materialize

SPLITTERS, ACCURACY, LIMIT = 255, 2000, 10_000


def _placed(values: DataFrame, cuts: list[float]) -> DataFrame:
    """``values`` (x) with its bracket: 2 i for x = cut i, 2 i + 1 for x between the cuts i and i + 1."""
    splits = [-math.inf, *cuts, math.inf]
    cut = Bucketizer(splits=splits, inputCol="x", outputCol="b").transform(values).withColumn("b", F.col("b").cast("int"))
    lower = F.get(F.lit(splits), F.col("b"))
    return cut.select("x", (2 * F.col("b") + F.when(F.col("x") == lower, 0).otherwise(1)).alias("place"))


def _finite(found: Sequence[float] | None) -> set[float]:
    return {float(c) for c in found or [] if math.isfinite(c)}


def order_statistics(values: DataFrame, ranks: Sequence[int], n: int, cuts: set[float], limit: int = LIMIT) -> dict[int, float]:
    """The value at each 0-based rank of ``values`` (x, neither null nor NaN, ``n`` rows)."""
    top = sys.float_info.max
    grid = [i / (SPLITTERS + 1) for i in range(1, SPLITTERS + 1)]
    while True:
        edges = sorted(cuts | {-top, top})
        placed = _placed(values, edges)
        brackets = sorted(placed.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect(), key=lambda r: r["place"])
        before = [0]
        for r in brackets:
            before.append(before[-1] + r["n"])
        home = {k: bisect_right(before, k) - 1 for k in ranks}          # index into brackets
        wanted = {i: brackets[i] for i in set(home.values())}
        wide = [r["place"] for r in wanted.values() if r["lo"] < r["hi"] and r["n"] > limit]
        if not wide:
            break
        found = placed.filter(F.col("place").isin(wide)).groupBy("place").agg(F.percentile_approx("x", grid, ACCURACY).alias("cuts")).collect()
        # splitters within the wide brackets, and the brackets' bounds
        cuts = {c for r in found for c in _finite(r["cuts"])} | {c for r in wanted.values() for c in _finite([r["lo"], r["hi"]])}
    open_ = [r["place"] for r in wanted.values() if r["lo"] < r["hi"]]
    held: dict[int, list] = {}
    if open_:
        for r in placed.filter(F.col("place").isin(open_)).groupBy("place", "x").count().collect():
            held.setdefault(r["place"], []).append((r["x"], r["count"]))
    out = {}
    for k, i in home.items():
        at, r = before[i], brackets[i]
        for x, c in sorted(held.get(r["place"], [(r["lo"], r["n"])])):
            if k < at + c:
                out[k] = float(x)
                break
            at += c
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], limit: int = LIMIT) -> list[float]:
    """Exact linear-interpolation quantiles (the pandas/DuckDB ``quantile_cont``);
    nulls and NaN take no part, no value at all gives an empty list."""
    x = F.col(col).cast("double")
    zero = F.when(x == 0, F.lit(0.0)).otherwise(x)          # one zero, not two
    values = materialize(df.filter(x.isNotNull() & ~F.isnan(x)).select(zero.alias("x")), "quantile-values")
    grid = [i / (SPLITTERS + 1) for i in range(1, SPLITTERS + 1)]
    n, found = values.agg(F.count("x"), F.percentile_approx("x", grid, ACCURACY)).first()
    if not n:
        return []
    pos = [(n - 1) * float(q) for q in probs]
    need = sorted({int(math.floor(p)) for p in pos} | {int(math.ceil(p)) for p in pos})
    at = order_statistics(values, need, n, _finite(found), limit)
    out = []
    for p in pos:
        lo, hi = int(math.floor(p)), int(math.ceil(p))
        out.append(at[lo] if at[lo] == at[hi] else at[lo] + (at[hi] - at[lo]) * (p - lo))
    return out
