"""chronodiff: change events, snapshots and their integrity, computed with Spark DataFrames."""

__version__ = "0.1.0"
