"""tessera: the example jobs of a small Spark cookbook, rebuilt as DataFrame,
Spark SQL, Structured Streaming and ``pyspark.ml`` operators that scale.

Every operator is a function ``DataFrame(s), params -> DataFrame``; the caller
runs the action. ``tessera.plans`` wires operators to the shared test tables.
"""

from tessera.session import build_session, shared_dir, scratch_path

__all__ = ["build_session", "shared_dir", "scratch_path"]
