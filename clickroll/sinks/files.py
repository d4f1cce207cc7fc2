"""Folders and small files of a table, on any file system Spark can reach."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def exists(spark: SparkSession, path: str) -> bool:
    fs, root = _folder(spark, path)
    return fs.exists(root)


def names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and times (milliseconds) of what lies right below a folder: one listing."""
    fs, root = _folder(spark, path)
    if not fs.exists(root):
        return []
    return sorted((f.getPath().getName(), f.getModificationTime()) for f in fs.listStatus(root))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; one that is not there does no harm."""
    fs, root = _folder(spark, path)
    fs.delete(root, True)


def write_bytes(spark: SparkSession, path: str, value: bytes) -> None:
    """Write a small file, over one that is there."""
    fs, root = _folder(spark, path)
    out = fs.create(root, True)
    out.write(bytearray(value))
    out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, root = _folder(spark, path)
    source = fs.open(root)
    try:
        return bytes(source.readAllBytes())
    finally:
        source.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Write a small file that is there as a whole or not at all; one of that name must not be there."""
    fs, root = _folder(spark, path)
    part = root.suffix(".part")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    if fs.exists(root) or not fs.rename(part, root):
        raise FileExistsError(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(read_bytes(spark, path))
