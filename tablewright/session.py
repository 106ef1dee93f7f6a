"""Session helpers: defaults for local work and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "tablewright", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per context, so its functions can be unpickled there."""
    context = spark.sparkContext
    if getattr(context, "_tablewright_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # The driver's own file; Spark hands it to every executor.
    archive = os.path.join(tempfile.mkdtemp(prefix="tablewright-"), "tablewright.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._tablewright_shipped = True


_local_parents: dict[str, str] = {}
_owned: list[tuple[object, object, str]] = []  # (jvm, Hadoop configuration, path)
_owned_to_the_end: dict[str, tuple[object, object, str]] = {}


def scratch_path(spark: SparkSession, stem: str) -> str:
    """A fresh path for an intermediate table.

    The parent is the folder named in ``spark.checkpoint.dir``, which every
    executor can reach. Where that is unset, a local master gets one folder of its own,
    which goes with the process; on a cluster it is an error.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local_parents:
            _local_parents[application] = tempfile.mkdtemp(prefix="tablewright-")
            atexit.register(shutil.rmtree, _local_parents[application], ignore_errors=True)
        parent = _local_parents[application]
    return f"{parent.rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def own(spark: SparkSession, path: str) -> str:
    """Have a path deleted by `discard_scratch`, at the latest when the process ends."""
    _owned.append((spark._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path))
    return path


def checkpoint_folder(spark: SparkSession) -> str:
    """This application's checkpoint folder, which is deleted when the process ends."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(scratch_path(spark, "checkpoints"))
    path = context._jsc.sc().getCheckpointDir().get()
    _owned_to_the_end[path] = (spark._jvm, context._jsc.hadoopConfiguration(), path)
    return path


def stored_table(df: DataFrame, stem: str) -> DataFrame:
    """The same rows read from a table in the scratch folder, which lasts until it is discarded."""
    spark = df.sparkSession
    path = own(spark, scratch_path(spark, stem))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(jvm, conf, path: str) -> None:
    try:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    except Exception:  # noqa: BLE001  the JVM may have ended; then nothing can be done
        pass


def discard_scratch(since: int = 0) -> None:
    """Delete what is owned, or what came after the first ``since``. Results that read it cannot be computed again."""
    while len(_owned) > since:
        _delete(*_owned.pop())


@atexit.register
def _discard_all() -> None:
    discard_scratch()
    while _owned_to_the_end:
        _delete(*_owned_to_the_end.popitem()[1])


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Intermediate tables stored inside are deleted at the end; write or collect results inside as well."""
    since = len(_owned)
    try:
        yield
    finally:
        discard_scratch(since)

