"""valora — property-market analytics as Spark jobs.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, joins, windows and aggregates, so Catalyst plans it
and the executors run it.  Nothing in the core collects rows to the driver.
"""

from valora.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
