"""Session helpers: table access, code shipping and shared scratch space."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Allocators that hold little: one arena, large blocks go back when they are freed, others when an operator asks for it.
_WORKERS = {"MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(8 << 20), "MALLOC_TRIM_THRESHOLD_": str(64 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}
#: Folders of intermediate tables and stores that this process has written.
_MADE: list[str] = []
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark alone (any Hadoop path works)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_code(spark: SparkSession) -> None:
    """Prepares a session for Python operators: workers on this host can import the package when it is run from a checkout
    (on a cluster it is shipped with ``--py-files`` or installed), and Arrow batches are bounded in bytes, so that rows of
    very long texts do not fill a worker. A bound that the session's owner has chosen stays. Workers give freed memory back
    early: they live on from task to task beside their executor's heap.
    """
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *have])
    if spark.conf.get(_BATCH_BYTES, "67108864b") == "67108864b":  # Spark's default
        spark.conf.set(_BATCH_BYTES, "2097152b")
    for name, value in _WORKERS.items():
        env.setdefault(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where a session on one host has none (unit tests) a temporary folder is chosen and set; on a cluster it is required.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="corpusmill-")
        sc.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, label: str) -> str:
    """The path of a new folder in the shared one, which :func:`clean` deletes."""
    path = f"{shared_dir(spark).rstrip('/')}/corpusmill-{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Delete all intermediate tables and stores of this process; to be called when no result is read any more."""
    while _MADE:
        _delete(spark, _MADE.pop())


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def drop_materialised(*frames: DataFrame) -> None:
    """Delete the files behind frames made by :func:`materialise` once nothing reads them any more."""
    for df in frames:
        folder = (df.inputFiles() or [""])[0].rpartition("/")[0]
        if folder.rpartition("/")[2].startswith("corpusmill-"):  # never anything but an intermediate table
            _delete(df.sparkSession, folder)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of frames that are gone. It acts on what the driver's collectors find,
    which in a long job on a small driver may come late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_heaps(spark: SparkSession) -> None:
    """Lets executors collect their garbage and give the heap that it took back to the machine. A heap does not shrink by
    itself, and the workers beside it in a later stage need the room. As many short tasks as there are cores reach them."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.reflect(F.lit("java.lang.System"), F.lit("gc")).alias("done")).write.format("noop").mode("overwrite").save()
