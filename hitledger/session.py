"""Session settings the library relies on, and where it may write scratch data."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Item = TypeVar("Item")

#: Spark jobs that ``at_once`` has under way together at most.
MOST_AT_ONCE = 16

# Calendar columns are defined on UTC days, so the zone is part of the results.
# Partition counts, memory and file system settings stay with the caller.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_LTZ",
    "spark.sql.adaptive.enabled": "true",
    # The default timestamp type of parquet files has no statistics to skip data by.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure_session(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def scoped_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Apply SQL settings for one action and restore what was there before."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster, by setting or by ``setCheckpointDir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        named = spark.sparkContext.getCheckpointDir()
        # Spark adds a folder of its own to the one that was named
        shared = named.rsplit("/", 1)[0] if named else None
    if not shared:
        raise RuntimeError(
            "no shared folder for scratch tables: set spark.checkpoint.dir when the session is"
            " built, or call sparkContext.setCheckpointDir"
        )
    return shared.rstrip("/")


def at_once(spark: SparkSession, task: Callable[[Item], None], items: Iterable[Item]) -> None:
    """Run independent Spark jobs together, so that small ones fill each other's gaps.

    They belong to the caller's job group and scheduler pool.
    """
    items = list(items)
    if not items:
        return
    inherited = inheritable_thread_target(spark)
    with ThreadPoolExecutor(min(len(items), MOST_AT_ONCE)) as pool:
        waiting = [pool.submit(inherited(partial(task, item))) for item in items]
    for done in waiting:
        done.result()
