"""Gridded climate analytics on PySpark DataFrames.

Model output, reanalysis and station sets are long DataFrames with one row per
cell and time.  Operators take and return DataFrames, so they chain with
``DataFrame.transform`` and stay inside one lazy Catalyst plan.
"""

from climcube.config import Region, RunConfig

__all__ = ["Region", "RunConfig"]
