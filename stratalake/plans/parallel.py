"""Independent Spark actions at the same time, so that one does not leave the cluster idle at its end."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def in_parallel(spark: SparkSession, *actions: Callable[[], None]) -> None:
    """The first failure is raised once all have ended."""
    with ThreadPoolExecutor(len(actions)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]:
            done.result()
