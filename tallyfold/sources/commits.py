"""Names that only one of several writers gets.

Commits are written aside and then renamed to the next free number. A rename
never replaces a folder that is there, so of two writers one gets the number and
the other starts again on what the first one left. File systems with atomic
renames (local disks, HDFS) make this safe between clusters; on object stores
without them, writers of one table need a lock of their own.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Where commits are written before they have a number.
ASIDE = "_new"
#: How often a writer starts again before it gives up.
ATTEMPTS = 50
_TAKEN = (
    "FileAlreadyExistsException",
    "DirectoryNotEmptyException",
    "Directory not empty",
    "FileNotFoundException",
    "NoSuchFileException",
)


class ConflictError(RuntimeError):
    """Other writers were faster, again and again."""


def folder_of(spark: SparkSession, path: str):
    """A folder and its file system, through the session's Hadoop settings."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = folder_of(spark, path)
    return fs.exists(folder)


def new_aside(path: str) -> str:
    return f"{path.rstrip('/')}/{ASIDE}/{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = folder_of(spark, path)
    fs.delete(folder, True)


def claim(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder that is not empty; False if the name is taken or the folder gone."""
    fs, old = folder_of(spark, source)
    _, new = folder_of(spark, target)
    fs.mkdirs(new.getParent())
    old, new = fs.makeQualified(old), fs.makeQualified(new)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    try:
        if old.toUri().getScheme() == "file":
            # a rename onto a folder with files fails in the operating system itself
            options = gateway.new_array(jvm.java.nio.file.CopyOption, 1)
            options[0] = jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
            paths = [jvm.java.nio.file.Path.of(p.toUri()) for p in (old, new)]
            jvm.java.nio.file.Files.move(*paths, options)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(old, new, gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0))
    except Py4JJavaError as e:
        if any(name in str(e.java_exception) for name in _TAKEN):
            return False
        raise
    return True


def mark(spark: SparkSession, path: str, name: str) -> None:
    """An empty file in a folder, which is made if it is not there."""
    fs, _ = folder_of(spark, path)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}"), True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    fs, folder = folder_of(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, file = folder_of(spark, path)
    stream = fs.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = folder_of(spark, path)
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
