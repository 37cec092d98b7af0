"""The folder for intermediate and derived tables: one that every executor can reach."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def _path(spark: SparkSession, path: str):
    """A path and its file system, as Spark's own readers see them."""
    jvm = spark.sparkContext._jvm
    named = jvm.org.apache.hadoop.fs.Path(path)
    return named, named.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    named, system = _path(spark, path)
    return system.exists(named)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data that nothing reads any more."""
    named, system = _path(spark, path)
    system.delete(named, True)


def shared_folder(spark: SparkSession) -> str:
    """What the session names in ``spark.checkpoint.dir``, or has set as checkpoint folder.

    If there is none, local mode gets a temporary folder of this process; the session's own
    setting stays as it is. A cluster is refused, because a folder of one machine would not do.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    name = context.applicationId
    if name not in _own:
        _own[name] = tempfile.mkdtemp(prefix="tidefeed-")
    return _own[name]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """The name of a folder under the shared one that nothing has used yet."""
    return f"{shared_folder(spark)}/tidefeed/{purpose}-{uuid.uuid4().hex}"


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    named, system = _path(spark, path)
    if not system.exists(named):
        return []
    return [status.getPath().getName() for status in system.listStatus(named)]


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is not there."""
    named, system = _path(spark, path)
    if not system.exists(named):
        return None
    try:
        opened = system.open(named)
    except Py4JJavaError:
        if system.exists(named):
            raise
        return None
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless one of that name is there: then False.

    It is written beside and then renamed without overwriting, which a distributed file system
    decides for one writer. A local file system looks and then renames; there a hard link decides.
    """
    named, system = _path(spark, path)
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(named.toUri(), conf)
    system.mkdirs(named.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = system.create(beside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if system.exists(named):
            return False
        if system.getScheme() == "file":
            try:
                os.link(beside.toUri().getPath(), named.toUri().getPath())
            except FileExistsError:
                return False
            return True
        options = jvm.org.apache.hadoop.fs.Options.Rename
        none = spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        files.rename(beside, named, none)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception) or system.exists(named):
            return False
        raise
    finally:
        system.delete(beside, False)
