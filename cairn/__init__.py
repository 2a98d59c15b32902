"""cairn: Spark-native numeric statistics, word counting and weighted k-median clustering.

Every operator is a DataFrame transformation; the iterative clustering drives one Spark job
per round and keeps only a small, size-checked centre table on the driver.
"""

from cairn.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
