"""paritas: data-parity and declared-constraint checks as Spark DataFrame plans.

Sub-packages:
    sources    parquet / layered-lakehouse / JDBC readers, catalog tables, report sinks
    functions  type classes, value rendering, typed group keys, row hashing
    operators  pair alignment, one-pass profiles, parity checks, row diff, constraints,
               catalog operators, FK-cycle detection
    plans      check registry and suite runner, metadata-driven constraint runner,
               registered queries and their DuckDB oracles
    streaming  empty: the reference has no streaming
"""

from paritas.operators.pair import TablePair, align  # noqa: F401
from paritas.plans.constraint_suite import run_constraints  # noqa: F401
from paritas.plans.suite import run_pair, run_scope, run_suite, summarise  # noqa: F401
from paritas.sources.catalog import CatalogTables  # noqa: F401
from paritas.sources.layers import LayerLocator  # noqa: F401
