"""litweft: literature-mining analytics expressed as Spark plans.

Sub-packages: ``sources`` (scans and sinks), ``functions`` (column-level building blocks),
``operators`` (DataFrame -> DataFrame), ``plans`` (the query catalogue with its SQL twins),
``streaming`` (incremental forms) and the optional ``llm`` (training-data operators).
"""

from litweft.session import get_session, table

__all__ = ["get_session", "table"]
