"""Region dimension operators: name→code mapping, flags, surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.constants import NON_FOREST_REGIONS, OFFICIAL_REGION_CODES
from hazardpanel.operators.prefix import row_numbers


def map_or_fail(df: DataFrame, name_col: str, mapping: DataFrame, key_col: str,
                value_col: str, out: str | None = None) -> DataFrame:
    """Look ``name_col`` up in ``mapping`` (a small table, broadcast by its size).

    An unmapped name fails the job with ``raise_error`` when the row is
    evaluated: no extra pass over the data is needed for the check.
    """
    out = out or value_col
    m = mapping.select(F.col(key_col).alias("_key"), F.col(value_col).alias("_val"))
    j = df.join(m, df[name_col] == m["_key"], "left")
    checked = F.when(F.col("_val").isNull(),
                     F.raise_error(F.concat(F.lit("unmapped name: "), F.coalesce(F.col(name_col).cast("string"),
                                                                                 F.lit("NULL"))))
                     ).otherwise(F.col("_val"))
    return j.withColumn(out, checked).drop("_key", "_val")


def official_code_mapping(spark) -> DataFrame:
    """The published name → two-digit code table (58 rows) as a DataFrame."""
    return spark.createDataFrame(OFFICIAL_REGION_CODES, "name string, code string")


def flag_not_in(df: DataFrame, col: str, names: Sequence[str] = tuple(NON_FOREST_REGIONS),
                out: str = "is_forest_zone") -> DataFrame:
    """Negative membership flag (a null name is flagged false)."""
    return df.withColumn(out, F.coalesce(~F.col(col).isin(*list(names)), F.lit(False)))


def surrogate_id(df: DataFrame, order_col: str, out: str = "surrogate_id") -> DataFrame:
    """1..n (long) in ``order_col`` order; order values must be unique, a null
    one comes first.  Numbers and strings alike are ordered by their own type,
    range by range (``row_numbers``)."""
    return row_numbers(df, order_col, out)


def semi_by_flag(facts: DataFrame, dim: DataFrame, key: str, flag_col: str) -> DataFrame:
    """Fact rows whose key is flagged in the dimension (``left_semi``)."""
    return facts.join(dim.filter(F.col(flag_col)).select(key), key, "left_semi")
