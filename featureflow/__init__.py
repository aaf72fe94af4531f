"""featureflow: refresh geographic feature sources with Spark.

Sources become DataFrames of features (a VARIANT ``geometry`` plus property
columns), pass through transform steps, get a content digest that ignores row
and key order, and are diffed against the previous run's state table.
"""

from featureflow.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
