"""aggrex — Spark-native exchange of aggregate health data.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; compose them with ``df.transform``.
"""

from aggrex.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
