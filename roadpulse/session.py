"""Session set-up and the shared working folder."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime options that the operators are written for. Values already set are kept.
RUNTIME_OPTIONS = {
    # transformWithState needs the RocksDB provider; it also keeps large state off the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Session windows are merged inside each map task before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def apply_runtime_options(spark: SparkSession) -> SparkSession:
    """Set the options above where the session has no explicit value."""
    explicit = dict(spark.sparkContext.getConf().getAll())
    for name, value in RUNTIME_OPTIONS.items():
        if name not in explicit:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named in ``spark.checkpoint.dir``.

    Where that is unset, a session in one process takes a folder in its warehouse. On a cluster it is an error,
    as the warehouse may be a folder of one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder; it is removed when the driver ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    system, target = _file_system(spark, path)
    system.deleteOnExit(target)
    return path


def written_out(df: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Cuts the lineage, survives lost executors and, unlike a checkpoint, computes the rows once.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return target.getFileSystem(conf), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    system, target = _file_system(spark, path)
    return system.exists(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None where there is none."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"


@contextlib.contextmanager
def plain_checkpoints(spark: SparkSession, checkpoint: str) -> Iterator[None]:
    """Streams started within write their offsets to a local checkpoint by ``FileSystem``, as they do elsewhere
    where there is no ``FileContext``.

    Both write a new file and rename it; on a local file system an offset or commit took 75 ms by ``FileContext``
    and 17 without it. A value already set is kept.
    """
    system, _ = _file_system(spark, checkpoint)
    if system.getScheme() != "file" or spark.conf.get(CHECKPOINT_FILES, None):
        yield
        return
    package = "org.apache.spark.sql.execution.streaming.checkpointing"
    spark.conf.set(CHECKPOINT_FILES, f"{package}.FileSystemBasedCheckpointFileManager")
    try:
        yield
    finally:
        spark.conf.unset(CHECKPOINT_FILES)
