"""reviewgate: label preparation, calibration and review routing as Spark jobs.

Every public operator takes and returns DataFrames (or Columns); the work runs
on Spark executors. See README.md for the operator map.
"""

__version__ = "0.1.0"
