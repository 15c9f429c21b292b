"""ordermill: retail-orders analytics as plain Spark DataFrame functions.

Every operator takes and returns a DataFrame; only the modules under
``sinks``, ``streaming`` and ``plans`` have effects (writes, streams,
catalog entries).
"""

__all__ = ["schema", "session"]
