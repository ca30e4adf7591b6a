"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidemark", cpus: str | int = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A session for tests and single-node runs; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost together with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, until ``release_scratch``."""
    path = f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def scratch_mark() -> int:
    """How many scratch paths there are, for ``scratch_since``."""
    return len(_made)


def scratch_since(mark: int) -> list[str]:
    """The scratch paths named since a mark."""
    return _made[mark:]


def release_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete some scratch tables, for when every result that reads them is written; empties the list."""
    conf = spark._jsc.hadoopConfiguration()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        if name in _made:
            _made.remove(name)
    del paths[:]


def release_scratch(spark: SparkSession) -> int:
    """Delete all scratch tables of this process; returns how many.

    Deletes only what ``scratch_path`` named, so runs that share the folder don't touch each other.
    """
    made = list(_made)
    release_paths(spark, list(made))
    return len(made)


def settled(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write an intermediate result that several steps read, and continue from the table (at a new path, or a given one).

    The lineage is cut, a lost executor costs no recomputation, later reads are
    column-pruned, and the planner knows the table's size. The shuffle files behind
    the table are removed as soon as it is written.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "settled")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """As ``settled``, but keeps partitions and their row order."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
