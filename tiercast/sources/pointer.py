"""Numbered pointers: small files of which each number can be written once.

What a pointer names is written aside first and takes effect with the pointer, as a whole or not at
all. Of two writers of one number the second fails. A pointer is moved into place complete, by a
rename that does not replace; HDFS does that atomically, an object store has to offer it.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tiercast.operators.scratch import hadoop_path


class Conflict(RuntimeError):
    """Another writer was first."""


def latest(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """The highest pointer and its content; -1 and nothing if there is none."""
    location, files = hadoop_path(spark, folder)
    if not files.exists(location):
        return -1, {}
    names = [entry.getPath().getName() for entry in files.listStatus(location)]
    numbers = [int(name) for name in names if name.isdigit()]
    if not numbers:
        return -1, {}
    context = spark.sparkContext
    stream = files.open(hadoop_path(spark, f"{folder}/{max(numbers):012d}")[0])
    try:
        text = context._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return max(numbers), json.loads(text)


def publish(spark: SparkSession, folder: str, number: int, content: dict) -> None:
    """Write a pointer, or raise ``Conflict`` if its number is taken."""
    jvm = spark.sparkContext._jvm
    aside, files = hadoop_path(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = files.create(aside, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    target, _ = hadoop_path(spark, f"{folder}/{number:012d}")
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(target), how)
    except Py4JJavaError as error:
        files.delete(aside, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise Conflict(f"{target} was written by another run") from None
        raise
