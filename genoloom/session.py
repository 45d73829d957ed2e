"""Tables, checkpoints and scratch tables of a session."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that ends shuffle files with the query that wrote them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``base``."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session may leave that unset; it takes a temporary folder. On a cluster a folder of one
    machine would be wrong, so that an unset one is an error there.
    """
    sc = spark.sparkContext
    at = sc.getCheckpointDir()
    if at is None:
        at = sc.getConf().get("spark.checkpoint.dir")
        if not at:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            at = tempfile.mkdtemp(prefix="spark-genoloom-")
        sc.setCheckpointDir(at)
        at = sc.getCheckpointDir()
    return at


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_LOCK, _INSIDE, _HAD = threading.Lock(), [0], [None]


@contextmanager
def _cleanup(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with their queries while any thread is inside; the session's own setting comes back with the last one."""
    with _LOCK:
        if not _INSIDE[0]:
            _HAD[0] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _INSIDE[0] += 1
    try:
        yield
    finally:
        with _LOCK:
            _INSIDE[0] -= 1
            if not _INSIDE[0]:
                spark.conf.unset(CLEANUP) if _HAD[0] is None else spark.conf.set(CLEANUP, _HAD[0])


class Scratch:
    """Tables written to the shared folder; each cuts lineage and survives the loss of executors.

    ``put`` writes and reads back; ``drop`` removes a table that nothing reads any more. What is not
    dropped stays for the lazy plans that read it, in a folder of its own under the shared one, until
    ``release`` is called.
    """

    #: Folders of this process that may still hold tables.
    folders: list[str] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{shared_dir(spark).rstrip('/')}/genoloom-{uuid.uuid4().hex}"
        self.n = 0
        Scratch.folders.append(self.base)

    def at(self, name: str) -> str:
        """A path of this object's folder for files written by other means."""
        return f"{self.base}/{name}"

    def put(self, df: DataFrame, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
        """(the table as written, its path). Shuffle files of the job that writes it go with the job."""
        self.n += 1
        at = f"{self.base}/{self.n}"
        with _cleanup(self.spark):
            (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(at)
        return self.spark.read.schema(df.schema).parquet(at), at

    def drop(self, *paths: str) -> None:
        jvm = self.spark._jvm
        for at in paths:
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Removes all scratch tables; to be called when the results of earlier queries are written."""
    scratch = Scratch(spark)
    scratch.drop(*Scratch.folders)
    Scratch.folders.clear()
