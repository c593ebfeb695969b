"""Session start-up and the shared folder that intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "subjectloom", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors, once per application, so that functions
    of it can run there whether or not it is installed on them."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="subjectloom-code-"), "subjectloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the cluster names none (tests, one machine) a temporary folder is made and
    remembered as the session's checkpoint folder.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="subjectloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder. For large frames that several passes
    read, where working them out again costs more than reading them."""
    path = fresh_path(df.sparkSession, name)
    for paths in _NOTES.get():
        paths.append(path)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    table = df.sparkSession.read.parquet(path)
    table.shared_path = path
    return table


_NOTES: ContextVar[tuple[list[str], ...]] = ContextVar("notes", default=())


@contextmanager
def noting() -> Iterator[list[str]]:
    """Gives a list that gets the paths of all tables ``written`` meanwhile by this thread."""
    paths: list[str] = []
    token = _NOTES.set((*_NOTES.get(), paths))
    try:
        yield paths
    finally:
        _NOTES.reset(token)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes tables that ``written`` made, once nothing reads them any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(*tables: DataFrame) -> None:
    """The same, for tables as ``written`` gave them."""
    for table in tables:
        remove(table.sparkSession, [table.shared_path])


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, so later jobs read it back.

    Used for small aggregates that several jobs need; survives losing executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
