"""A log of numbered commits, in order whatever the clocks say.

Each commit is a small file named by its number. It is written under another name first and then put
in its place only if there is none yet, so of two writers that try the same number one wins, and
the other tries the next. A commit is whole or not there, and its number says what came later.
"""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

SUFFIX = ".json"
#: Names of files that are not in place yet; readers pass over them.
PENDING = "_pending-"


def _files(spark: SparkSession, path: str):
    """A path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _files(spark, path)
    return files.exists(where)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file as a whole, unless there is one of that name; says whether it did.

    Relies on a rename that fails if its target exists, which HDFS does in one step; on a local disk
    a hard link does the same.
    """
    target, files = _files(spark, path)
    pending = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), PENDING + uuid4().hex)
    stream = files.create(pending, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if files.getScheme() == "file":
            link, there = (spark._jvm.java.nio.file.Path.of(p.toUri().getPath(), _no_names(spark)) for p in (target, pending))
            spark._jvm.java.nio.file.Files.createLink(link, there)
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                files.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(pending, target, _no_options(spark))
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(pending, False)
    return True


def _no_names(spark: SparkSession):
    return spark._sc._gateway.new_array(spark._jvm.java.lang.String, 0)


def _no_options(spark: SparkSession):
    """``Rename.NONE``: never overwrite."""
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    return options


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the commits in a folder, in order; one short name for each comes to the driver."""
    path, files = _files(spark, folder)
    if not files.exists(path):
        return []
    names = [found.getPath().getName() for found in files.listStatus(path)]
    return sorted(int(name.removesuffix(SUFFIX)) for name in names if name.removesuffix(SUFFIX).isdigit())


def last_number(spark: SparkSession, folder: str) -> int:
    return max(numbers(spark, folder), default=0)


def path_of(folder: str, number: int) -> str:
    return f"{folder}/{number:020d}{SUFFIX}"


def commit(spark: SparkSession, folder: str, text: str, seen: int | None = None) -> int:
    """Add a commit and answer its number, the first free one after ``seen``, the last number which
    the writer knows of."""
    number = (last_number(spark, folder) if seen is None else seen) + 1
    while not create_if_absent(spark, path_of(folder, number), text):
        number = max(number, last_number(spark, folder)) + 1
    return number
