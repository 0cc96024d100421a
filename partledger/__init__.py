"""Partitioned microdata archive on Spark: delta detection, reconciliation,
content fingerprints, lineage, cataloguing and queries over the published tables.

Every operator is a function from DataFrames (or columns) to a DataFrame (or
column); nothing is computed on the driver.
"""

from partledger.spec import DATASETS, DatasetSpec

__all__ = ["DATASETS", "DatasetSpec"]
