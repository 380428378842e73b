"""Session defaults and shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar
from types import FunctionType

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_SCOPE: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def local_session(
    cores: int | str = "*", partitions: int = 8, memory: str = "8g", java_options: str = ""
) -> SparkSession:
    """A session for tests and local runs. On a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.extraJavaOptions", java_options)
        .appName("reviewrank")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="reviewrank-")
    return _LOCAL_FOLDERS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder of this application, which can be dropped when it has ended."""
    return f"{_application_folder(spark)}/{_SCOPE.get() or 'tables'}/{name}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_folder(spark)}/reviewrank-{spark.sparkContext.applicationId}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside the block are dropped at its end."""
    scope = f"scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(scope)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{_application_folder(spark)}/{scope}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def rows_handed_on(spark: SparkSession, most: int) -> Iterator[None]:
    """Inside the block, Python on executors gets at most ``most`` rows at a time: rows that hold whole texts are some KB
    each, and the JVM and Python both keep a batch in memory, next to its result."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= most:
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str, rows_at_once: int | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the scratch folder and read it back.

    It cuts the lineage, survives lost executors and, unlike a checkpointed RDD, keeps column
    pruning and filter pushdown for the readers. ``rows_at_once`` bounds what Python gets at a time while it is written;
    ``codec`` compresses large tables more than the session does.
    """
    path = scratch_path(df.sparkSession, name)
    with rows_handed_on(df.sparkSession, rows_at_once) if rows_at_once else nullcontext():
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(table: DataFrame, most: int) -> bool:
    """Whether a written table has at most ``most`` rows and may be broadcast. Spark's own check goes by bytes, and would turn
    a join with a short key into a shuffle of all claims at some size; ``most`` bounds what a task holds."""
    threshold = table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return not threshold.startswith("-") and table.count() <= most


def shipped(function: Callable) -> Callable:
    """A copy of a module's function that Spark sends to workers by value, so that they need no installed package.

    Constants of its module go along; functions of its module that it calls must be nested or passed in.
    """
    copy = FunctionType(function.__code__, function.__globals__, function.__name__, function.__defaults__, function.__closure__)
    copy.__kwdefaults__ = function.__kwdefaults__
    copy.__module__ = "__main__"
    return copy
