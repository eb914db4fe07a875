"""tessera: churn-style feature, quality, modelling and monitoring jobs on Spark.

Every operator takes and returns Spark DataFrames (or Spark ML stages) and
builds a lazy plan; nothing needs the table to fit on one machine.
"""

from tessera.session import get_session, checkpoint_dir, table

__all__ = ["get_session", "checkpoint_dir", "table"]
