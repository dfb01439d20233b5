"""Files of shared storage through Spark's Hadoop file systems: versions, a pointer, deletion.

A snapshot is a version folder under ``<out>/versions``; ``<out>/CURRENT`` names
the one that readers see. A version becomes visible when the pointer, written
last, is renamed over the old one, so a run that ends midway changes nothing.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

POINTER, VERSIONS = "CURRENT", "versions"
KEPT_VERSIONS = 2           # the current one and the one before, which readers may still be at


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it is not there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(b & 0xFF for b in stream.readAllBytes()).decode()
    finally:
        stream.close()


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: a new file is renamed over the old one."""
    sc = spark.sparkContext
    fs, new = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = sc._jvm
    option = jvm.org.apache.hadoop.fs.Options.Rename
    over = sc._gateway.new_array(option, 1)
    over[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), sc._jsc.hadoopConfiguration())
    context.rename(new, jvm.org.apache.hadoop.fs.Path(path), over)


def new_version(out_dir: str) -> str:
    """The folder of a snapshot to be written."""
    return os.path.join(out_dir, VERSIONS, uuid.uuid4().hex)


def commit(spark: SparkSession, out_dir: str, version: str) -> None:
    """Make ``version`` the current one and retire versions older than the one before it."""
    pointer = os.path.join(out_dir, POINTER)
    history = _read(spark, pointer).split() if exists(spark, pointer) else []
    history = [os.path.basename(version), *history][:KEPT_VERSIONS]
    _replace(spark, pointer, "\n".join(history))
    fs, folder = _fs(spark, os.path.join(out_dir, VERSIONS))
    for status in fs.listStatus(folder):
        if status.getPath().getName() not in history:
            fs.delete(status.getPath(), True)


def resolve(spark: SparkSession, path: str) -> str:
    """``<out>/<table>`` in the current version, or ``path`` itself where no version was committed."""
    out_dir, table = os.path.split(path.rstrip("/"))
    pointer = os.path.join(out_dir, POINTER)
    if not exists(spark, pointer):
        return path
    return os.path.join(out_dir, VERSIONS, _read(spark, pointer).split()[0], table)
