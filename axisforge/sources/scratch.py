"""Tables of intermediate results in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_TABLES: dict[str, SparkSession] = {}
_LOCK = threading.RLock()

#: While an intermediate result is written: its shuffles go when it is there, and Python gets texts in small batches.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, one of our own, but only if driver and executors are one process."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            own = tempfile.mkdtemp(prefix="axisforge-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            _OWN[app] = f"file://{own}"
        place = _OWN[app]
    return place.rstrip("/")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for a while. Threads of one session take turns, as they share its settings."""
    with _LOCK:
        before = {k: spark.conf.get(k, None) for k in values}
        try:
            for k, v in values.items():
                spark.conf.set(k, v)
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and returns the table: lineage ends here, lost executors cost nothing.

    The table stays until discard(), or until the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/axisforge/{name}-{uuid.uuid4().hex}"
    _TABLES[path] = spark
    with settings(spark, WRITING):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._axisforge_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of written() that nothing will read again; other frames are left alone."""
    for t in tables:
        path = getattr(t, "_axisforge_path", None)
        if path in _TABLES:
            _delete(_TABLES.pop(path), path)


@atexit.register
def _discard_all() -> None:
    for path, spark in _TABLES.items():
        if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
            continue
        _delete(spark, path)
