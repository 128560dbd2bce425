"""Small join sides with a known size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazardpanel.session import materialize


def dimension(df: DataFrame, name: str = "dimension") -> DataFrame:
    """A derived small table, stored once.

    The optimizer cannot tell the size of an aggregate or a join, but it knows the
    bytes of a stored table: it broadcasts the side below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both above, and nothing
    is counted or computed twice to find out.  Tables that already are stored (the
    region dimension of the jobs) join as they are.
    """
    return materialize(df, name)
