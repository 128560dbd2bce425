"""Priority-ordered de-duplication (keep first / keep last).

A plain ``dropDuplicates`` keeps an arbitrary row per key.  The panel's
rule is "first source in priority order wins", so the winner is picked by
an explicit ordering tuple.  We use ``min_by``/``max_by`` over a struct:
it is an ordinary aggregate, so Spark combines partially on the map side
and a hot key (one spot seen a million times) collapses to one row per
map task before the shuffle instead of landing whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, key: Sequence[str], order: Sequence[str], first: bool, copies: str | None = None) -> DataFrame:
    key = list(key)
    order = list(order)
    rest = [c for c in df.columns if c not in key]
    if not rest and not copies:
        return df.select(*key).distinct()
    payload = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*[F.col(c) for c in order])
    chooser = F.min_by if first else F.max_by
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    picked = df.groupBy(*key).agg(chooser(payload, ordering).alias("_kept"), *counted)
    flat = picked.select(*key, *[F.col(f"_kept.{c}").alias(c) for c in rest], *([copies] if copies else []))
    return flat.select(*df.columns, *([copies] if copies else []))


def dedup_keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str], copies: str | None = None) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` tuple; with ``copies``
    a column of that name tells how many rows it stands for.

    ``order`` must be unique within a key (e.g. source priority plus a row id)
    for the result to be deterministic.
    """
    return _pick(df, key, order, True, copies)


def dedup_keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the latest arrival (largest ``order`` tuple)."""
    return _pick(df, key, order, first=False)
