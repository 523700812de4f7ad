"""designlab: designed experiments, result checking and surrogate-model analytics on Spark.

Every public operator takes and returns DataFrames and builds a lazy plan;
nothing is collected to the driver except parameter-sized tables.
"""

from designlab.session import get_spark, checkpoint_dir, cut_lineage

__all__ = ["get_spark", "checkpoint_dir", "cut_lineage"]
