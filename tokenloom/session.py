"""Where jobs keep intermediate tables."""

import atexit
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=None)
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tokenloom-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _local_root(spark.sparkContext.applicationId)
    folder = f"{root.rstrip('/')}/tokenloom-{purpose}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def with_arrow_batches(spark: SparkSession, max_bytes: int) -> SparkSession:
    """The session with all its settings once more, but for Arrow batches of about so many bytes.

    A batch lies in memory several times: in the vectors of a task, in what it writes to its Python worker, and in the worker.
    """
    own = type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(max_bytes))
    return own


#: Folders of this application. Tables may be read from them as long as it runs. Paths alone: functions that name a
#: module of the package travel with it, and a session cannot.
_made: list[str] = []


@atexit.register
def remove_intermediate() -> None:
    """Deletes the intermediate folders of this application; called when it ends, or before by its owner."""
    spark = SparkSession.getActiveSession()
    while spark and _made:
        try:
            delete(spark, _made.pop())
        except Exception:  # the JVM has gone before: nothing can be reached any more
            _made.clear()


def stored(table: DataFrame, purpose: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, cheap to count, not lost with an executor."""
    folder = shared_folder(table.sparkSession, purpose)
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where) and files.getFileStatus(where).isDirectory()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there whole or not at all: written under another name, then renamed."""
    files, where = _file_system(spark, path)
    waiting = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(waiting, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not files.rename(waiting, where):
        raise OSError(f"cannot publish {path}")


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _file_system(spark, path)
    size = files.getFileStatus(where).getLen()
    source = files.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source, size)).decode("utf-8")
    finally:
        source.close()


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    files, where = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediate data, in whatever file system it lies."""
    files, where = _file_system(spark, path)
    files.delete(where, True)
