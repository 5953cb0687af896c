"""Registered queries over the shared tables, each with the SQL it must equal.

``QUERIES`` maps a name to a function ``(spark, folder) -> DataFrame`` and
``ORACLES`` maps the same name to SQL giving the same rows.  A query without SQL
(one that no SQL can state at a sensible cost) is checked against brute force in
``tests/``.
"""

import sys

from pyspark import cloudpickle

from catalog.registry import ORACLES, QUERIES
from catalog import prepare, runlogs, scores, vocabulary  # noqa: E402,F401  (register on import)

# the stand-in generator is shipped to executors by value, like the library's functions
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES"]
