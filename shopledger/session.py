"""Session settings the library relies on, and the folder it may write to."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A join whose skewed partition was split no longer has the hash layout that a following aggregate
# could have reused.  Splitting is worth that extra exchange when one order or customer holds a large
# share of the rows, so ask for it; the setting does nothing where no partition is skewed.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

def apply_runtime_defaults(spark: SparkSession) -> SparkSession:
    """Set the defaults above, leaving alone whatever the session already sets."""
    chosen = spark.conf.getAll
    for key, value in RUNTIME_DEFAULTS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


# Without it the files of a shuffle stay on disk until the driver happens to collect garbage, so those of a whole build pile up.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_released: Counter[str] = Counter()
_lock = threading.Lock()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries begun in this block remove the files of their shuffles when they end.

    Meant for writes, whose plans run once: a DataFrame that is run again would have to make them again. Blocks may
    overlap, in one thread or several; a session's own setting wins.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        ours = _released[session] > 0 or RELEASE not in spark.conf.getAll
        if ours:
            _released[session] += 1
            spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        with _lock:
            if ours:
                _released[session] -= 1
                if not _released[session]:
                    del _released[session]
                    spark.conf.unset(RELEASE)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without that setting uses its warehouse folder, where its tables are anyway; on a
    cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def app_dir(spark: SparkSession) -> str:
    """This application's own corner of the shared folder."""
    return f"{shared_dir(spark)}/shopledger/{spark.sparkContext.applicationId}"
