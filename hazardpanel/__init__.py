"""hazardpanel: Spark-native region-by-day hazard panels.

Every public function takes and returns DataFrames (or a SparkSession plus
paths for sources/sinks); the heavy lifting is left to Catalyst/AQE.
"""

from hazardpanel.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
