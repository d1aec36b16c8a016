"""quarry — batch analytics operators on Spark DataFrames.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built from
Spark SQL built-ins (joins, aggregations, windows); nothing is collected to
the driver inside the library.  ``quarry.plans`` binds the operators to the
benchmark tables and carries the SQL oracle used for cross-checking.
"""

from quarry.session import build_session, cluster_conf, ensure_checkpoint_dir, materialize

__all__ = ["build_session", "cluster_conf", "ensure_checkpoint_dir", "materialize"]
