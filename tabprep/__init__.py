"""tabprep: table preparation, model fitting and scoring on Spark DataFrames.

Every operator takes and returns DataFrames.  Fitting steps gather their
statistics in as few aggregates as possible; only statistics, category
lists, weights and metric rows ever reach the driver.
"""

from tabprep.session import get_spark, scratch_path  # noqa: F401

__all__ = ["get_spark", "scratch_path"]
