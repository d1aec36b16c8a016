"""Query bindings over the benchmark tables and their SQL oracle.

``QUERIES[name](spark, sf_dir)`` builds a registered job over a directory of
benchmark tables; ``ORACLE_SQL[name]`` is the DuckDB SQL that must return the
same rows; ``Bindings.of(spark, sf_dir)`` gives the logical operator inputs.
"""

from quarry.plans.bindings import Bindings
from quarry.plans.catalog import QUERIES
from quarry.plans.oracle import ORACLE_SQL

__all__ = ["Bindings", "ORACLE_SQL", "QUERIES"]
