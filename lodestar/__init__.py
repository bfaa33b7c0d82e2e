"""lodestar: PySpark DataFrame operators for text features, trip analytics,
linear models, evaluation metrics and mixture clustering.

Every operator is a function ``DataFrame -> DataFrame`` built from Catalyst
expressions, joins, aggregates and windows so that Spark plans, partitions
and scales the work.  Iterative models keep their data in Spark and move only
parameter vectors (bounded by the vocabulary size) between iterations.
"""

from lodestar.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
