"""Numbered commits of a folder: small texts that appear whole and in one order.

A commit is a file ``<folder>/_commits/<number>``. It is written beside its place and renamed
there without overwriting, so it appears whole or not at all and of two writers that
claim one number only one succeeds; the other reads what was committed and tries the
next number. The order of commits is the order of these renames, not of any clock.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_FOLDER = "_commits"


def file_system(spark: SparkSession, path: str):
    """(file system, path, jvm) of a path, through Hadoop."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of one small file, ``None`` if there is none."""
    fs, p, jvm = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create one small file, whole or not at all; ``False`` if it is there already."""
    fs, p, jvm = file_system(spark, path)
    fs.mkdirs(p.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    at = fs.makeQualified(p).toUri()
    try:
        if at.getScheme() == "file":      # a rename may overwrite here, a link never does
            local = [jvm.java.io.File(x.toUri().getPath()).toPath() for x in (p, draft)]
            jvm.java.nio.file.Files.createLink(*local)
            fs.delete(draft, False)
        else:
            none = spark.sparkContext._gateway.new_array(
                getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                at, spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, p, none)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The commit numbers of ``folder``, ascending."""
    fs, base, _ = file_system(spark, f"{folder.rstrip('/')}/{_FOLDER}")
    if not fs.exists(base):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(base)]
    return sorted(int(n) for n in names if n.isdigit())


def committed(spark: SparkSession, folder: str, number: int) -> str | None:
    return read_text(spark, f"{folder.rstrip('/')}/{_FOLDER}/{number:012d}")


def committed_at(spark: SparkSession, folder: str, number: int) -> float:
    """When a commit was made, in seconds, by the file system's clock."""
    fs, p, _ = file_system(spark, f"{folder.rstrip('/')}/{_FOLDER}/{number:012d}")
    return fs.getFileStatus(p).getModificationTime() / 1000


def newest(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """The highest commit number (0: none) and its text."""
    for number in reversed(numbers(spark, folder)):
        text = committed(spark, folder, number)
        if text is not None:            # else pruned since it was listed
            return number, text
    return 0, None


def commit(spark: SparkSession, folder: str, text: Callable[[str | None], str]) -> int:
    """Commit ``text(newest text)``; called again on a newer text if another writer was faster.
    Returns the commit's number."""
    while True:
        number, before = newest(spark, folder)
        if create_text(spark, f"{folder.rstrip('/')}/{_FOLDER}/{number + 1:012d}", text(before)):
            return number + 1


def forget(spark: SparkSession, folder: str, number: int) -> None:
    fs, p, _ = file_system(spark, f"{folder.rstrip('/')}/{_FOLDER}/{number:012d}")
    fs.delete(p, False)
