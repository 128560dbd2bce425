"""Panel storage: year-partitioned Parquet, CSV exports, frozen + current union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet_by_year(df: DataFrame, path: str, date_col: str = "date",
                          mode: str = "overwrite", sort_cols=("wilaya_id", "date")) -> str:
    """Year-partitioned Parquet, rows clustered by (region, date) inside files.

    Range partitioning on (year, region) keeps each year's files together and
    bounded in size; readers prune years from the directory layout.
    """
    out = df.withColumn("year", F.year(date_col))
    cols = [c for c in sort_cols if c in out.columns]
    (out.repartitionByRange("year", *cols[:1])
        .sortWithinPartitions(*cols)
        .write.mode(mode).partitionBy("year").parquet(path))
    return path


def read_parquet_table(spark: SparkSession, path: str, drop_partition: str | None = "year") -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop(drop_partition) if drop_partition and drop_partition in df.columns else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a declared schema (never inferred)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def union_frozen_current(frozen: DataFrame, current: DataFrame) -> DataFrame:
    """Frozen history and the current period as one table (same columns)."""
    return frozen.unionByName(current, allowMissingColumns=True)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as a table bucketed and sorted by ``keys``, one file per bucket and write.

    The one shuffle is paid here: joins and groupings by all of ``keys`` between
    tables of the same keys and number of buckets need none.  Rows appended later
    (``mode="append"``, same keys and buckets) keep that."""
    (df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.format("parquet").mode(mode)
       .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def join_bucketed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join two tables of ``write_bucketed`` bucket by bucket; the hint keeps a side
    that is small today from being copied to every task instead."""
    return left.join(right.hint("merge"), list(keys), how)
