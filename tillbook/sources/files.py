"""The few file operations the versioned tables need, through Spark's own Hadoop client so that any store works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop, target.getFileSystem(configuration), target, configuration


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its store and its full folder, so that the catalog and readers agree on it."""
    _, store, target, _ = _hadoop(spark, path)
    return store.makeQualified(target).toString()


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder``; none if it does not exist."""
    _, store, path, _ = _hadoop(spark, folder)
    if not store.exists(path):
        return []
    return [status.getPath().getName() for status in store.listStatus(path)]


def is_file(spark: SparkSession, path: str) -> bool:
    _, store, target, _ = _hadoop(spark, path)
    return store.exists(target) and store.getFileStatus(target).isFile()


def read_text(spark: SparkSession, file: str) -> str:
    _, store, path, _ = _hadoop(spark, file)
    stream = store.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, file: str, text: str) -> None:
    """Write ``text`` beside ``file`` and rename it into place; fails if ``file`` exists already."""
    hadoop, store, path, configuration = _hadoop(spark, file)
    draft = hadoop.fs.Path(path.getParent(), f".{path.getName()}.{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    stream.write(text.encode("utf-8"))
    stream.close()
    no_overwrite = spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 0)
    try:
        hadoop.fs.FileContext.getFileContext(path.toUri(), configuration).rename(draft, path, no_overwrite)
    except Py4JJavaError as error:
        store.delete(draft, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        raise FileExistsError(f"another writer has published {file}") from error


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it; nothing happens if it is gone already."""
    _, store, target, _ = _hadoop(spark, path)
    store.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder its final name; if that name is taken, what is there stays and ``source`` goes."""
    _, store, to, _ = _hadoop(spark, target)
    _, _, path, _ = _hadoop(spark, source)
    if store.exists(to):
        store.delete(path, True)
    elif not store.rename(path, to):
        raise OSError(f"could not move {source} to {target}")
