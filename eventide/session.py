"""Session settings the jobs rely on, and the shared folder they write to."""

from __future__ import annotations

import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    # Window bounds as text must not depend on the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # A malformed number fails the job instead of turning into null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # State larger than executor memory; transformWithState needs it too.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that may change at run time.

    The number of shuffle partitions belongs to the cluster and is left alone.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without it; a folder is then made for its
    context. On a cluster a missing setting is an error, because a
    machine-local folder would lose data with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if not hasattr(sc, "_eventide_folder"):
        sc._eventide_folder = tempfile.mkdtemp(prefix="eventide-")
    return sc._eventide_folder


def ship_package(spark: SparkSession) -> None:
    """Let Python workers run functions of this package where it is not installed.

    The functions a job sends are pickled with their code instead of by name,
    so it does not matter from which folder driver or workers were started.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
