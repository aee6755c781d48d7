"""Independent jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")


def concurrently(
    spark: SparkSession, jobs: Mapping[str, Callable[[], Result]]
) -> dict[str, Result]:
    """Start jobs that do not depend on each other together and wait for all.

    Spark shares the executors among them, so the last tasks of one job do not
    leave the cluster idle. The first failure, in the given order, is raised.
    """
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        started = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
    return {name: job.result() for name, job in started.items()}
