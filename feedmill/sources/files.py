"""Small files and listings beside the data, through the file system that Spark itself uses."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str, name: str | None = None):
    """File system and Hadoop path of a folder, or of something in it."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path, name) if name else jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), file


def exists(spark: SparkSession, path: str) -> bool:
    fs, file = located(spark, path)
    return fs.exists(file)


def listed(spark: SparkSession, path: str, glob: str, kept: str) -> list[str]:
    """What fits ``glob`` below a folder, as the ends of the paths that match the expression ``kept``.

    The listing comes to Python as one string, not name by name.
    """
    fs, pattern = located(spark, path, glob)
    jvm = spark.sparkContext._jvm
    found = fs.globStatus(pattern)
    if not found:
        return []
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found))
    return [m[0] for m in re.finditer(kept, text)]


def text(spark: SparkSession, path: str, name: str) -> str:
    fs, file = located(spark, path, name)
    stored = fs.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stored, "UTF-8")
    finally:
        stored.close()


def put(spark: SparkSession, path: str, name: str, content: str) -> None:
    """A file with this content, in place of one of that name."""
    fs, file = located(spark, path, name)
    out = fs.create(file, True)
    out.write(bytearray(content.encode()))
    out.close()


def publish(spark: SparkSession, path: str, name: str, content: str) -> None:
    """A new file that gets its name when it is whole; an error if there is one of that name.

    Where renaming is a copy, as in object stores, two callers may both get through: the caller has to be the only one.
    """
    made = f"_{uuid.uuid4().hex}"
    put(spark, path, made, content)
    fs, ready = located(spark, path, made)
    file = located(spark, path, name)[1]
    if fs.exists(file) or not fs.rename(ready, file):
        fs.delete(ready, False)
        raise RuntimeError(f"{path} has a {name} already")


def remove(spark: SparkSession, path: str, name: str) -> None:
    fs, file = located(spark, path, name)
    fs.delete(file, True)
