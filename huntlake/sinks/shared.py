"""Folders shared by driver and executors, frames and job slots shared by several writes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"
PARALLEL_WRITES = 4


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Without the setting this is an error in every mode: a folder made up here
    would be another one after a restart.
    """
    folder = spark.conf.get(SHARED_FOLDER_SETTING, None)
    if not folder:
        raise ValueError(f"set {SHARED_FOLDER_SETTING} to a folder that the driver and all executors can reach")
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path that nothing has been written to, for results that outlive no session.

    It lies in the shared folder. Where that is unset and driver and executors
    are one process, as in tests, a temporary folder of the process stands in.
    """
    if not spark.conf.get(SHARED_FOLDER_SETTING, None) and spark.sparkContext.master.startswith("local["):
        return f"{_process_folder()}/{label}-{uuid.uuid4().hex}"
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _process_folder() -> str:
    return tempfile.mkdtemp(prefix="huntlake-")


@contextmanager
def shared(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for several actions and release it at the end, also after an error."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def filled(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """As ``shared``, and computed by one job first.

    Actions that start side by side on a frame that is not there yet each
    compute it on the executors they happen to run on.
    """
    with shared(df, level) as kept:
        kept.count()
        yield kept


def in_parallel(
    spark: SparkSession, actions: Iterable[Callable[[], object]], at_once: int = PARALLEL_WRITES
) -> None:
    """Run independent Spark actions from a few driver threads, so that small jobs overlap.

    Returns when all have ended; the first error, in the order given, is raised.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    for done in running:
        done.result()
