"""gaugekeep: daily river-gauge tables kept complete and free of duplicates, on Spark.

Every public function takes and returns DataFrames (or builds a plan that a
sink runs). Nothing is collected to the driver except scalars and file
listings.
"""

from gaugekeep.session import get_spark

__all__ = ["get_spark"]
