"""Station supply-and-demand analytics on Spark DataFrames.

Subpackages: ``functions`` (column expressions), ``sources`` (readers, writers,
file listings), ``operators`` (DataFrame to DataFrame), ``plans`` (operators
chained into pipelines) and ``streaming`` (incremental snapshots).
"""

from stationflow.session import build_session

__all__ = ["build_session"]
