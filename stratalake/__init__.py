"""stratalake: spec-driven bronze / silver / gold tables on Apache Spark.

Everything takes a ``SparkSession`` or ``DataFrame`` from the caller; nothing here creates a session at import time.
"""

from stratalake.operators.quality import BLOCK, QUARANTINE, WARN, Check
from stratalake.spec import DatasetSpec, MeanMart

__all__ = ["BLOCK", "QUARANTINE", "WARN", "Check", "DatasetSpec", "MeanMart"]
