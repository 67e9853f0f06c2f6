"""scorewell: scoring and data-quality operators expressed as Spark DataFrame jobs.

Every public operator takes DataFrames plus column names / parameters and returns
DataFrames.  Only aggregates and fitted parameters ever reach the driver.
"""

from scorewell.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
