"""Session settings and the shared folder of a job."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings every job wants unless it is told otherwise. Sizes are for a cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Many initial partitions, merged by AQE down to what the data needs.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Texts can be long: few of them in each batch that goes to Python.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Window counters of a stream live off-heap and on disk, and upload only what changed.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str) -> SparkSession:
    """The session of a job. Settings given to spark-submit win over the defaults here."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="pagetally-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


def _path(spark: SparkSession, path: str):
    """A path of any file system that Spark knows, and that file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, files = _path(spark, path)
    return files.exists(hadoop)


def children(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    hadoop, files = _path(spark, path)
    return [str(f.getPath()) for f in files.listStatus(hadoop)] if files.exists(hadoop) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Give a folder another name in the same file system, all of it at once."""
    source, files = _path(spark, old)
    target, _ = _path(spark, new)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{old} could not be renamed to {new}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file that write_new has written."""
    hadoop, files = _path(spark, path)
    stream = files.open(hadoop)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that is not there yet, all of it at once; False if it is there.

    The text goes to a name of its own first. In a mounted folder a link gives it the name, in
    other file systems a rename that replaces nothing: both fail where another writer was first.
    """
    hadoop, files = _path(spark, path)
    if files.exists(hadoop):
        return False
    folder, name = path.rsplit("/", 1)
    own, _ = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    files.mkdirs(own.getParent())
    if files.getUri().getScheme() == "file":
        return _write_linked(own.toUri().getPath(), hadoop.toUri().getPath(), text)
    stream = files.create(own, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.NONE
    try:
        fs.FileContext.getFileContext(own.toUri(), conf).rename(own, hadoop, options)
    except Py4JJavaError:
        files.delete(own, False)
        if files.exists(hadoop):
            return False
        raise
    return True


def _write_linked(own: str, path: str, text: str) -> bool:
    with open(own, "w", encoding="utf-8") as file:
        file.write(text)
    try:
        os.link(own, path)
    except FileExistsError:
        return False
    finally:
        os.remove(own)
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package has written."""
    hadoop, files = _path(spark, path)
    files.delete(hadoop, True)


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run under the shared folder."""
    return f"{shared_dir(spark)}/pagetally/{name}-{uuid.uuid4().hex}"
