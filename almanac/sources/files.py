"""Folder look-ups in whatever file system holds the tables."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def path_of(uri: Column) -> Column:
    """The path in a file's metadata, which writes special characters as %xx."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and all folders, so that it means the same to readers, writers and the catalog."""
    files, located = _located(spark, path)
    return files.makeQualified(located).toString()


def exists(spark: SparkSession, path: str) -> bool:
    files, located = _located(spark, path)
    return files.exists(located)


def time_of(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds."""
    files, located = _located(spark, path)
    return files.getFileStatus(located).getModificationTime() / 1000


def files_of(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(path, size, time of change) of every file of a table: differs once any of them is replaced."""
    files, located = _located(spark, path)
    found, each = [], files.listFiles(located, True)
    while each.hasNext():
        file = each.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether visible files lie directly inside a folder."""
    files, located = _located(spark, path)
    return any(s.isFile() and s.getPath().getName()[0] not in "._" for s in files.listStatus(located))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders directly inside `path`; none when it does not exist."""
    files, located = _located(spark, path)
    if not files.exists(located):
        return []
    names = [s.getPath().getName() for s in files.listStatus(located) if s.isDirectory()]
    return sorted(n for n in names if n[0] not in "._")


def move_only_file(spark: SparkSession, folder: str, to: str, suffix: str) -> None:
    """Give the one file with this suffix in a folder that a single task wrote another place and name."""
    files, located = _located(spark, folder)
    names = [s.getPath() for s in files.listStatus(located) if s.getPath().getName().endswith(suffix)]
    if len(names) != 1:
        raise ValueError(f"{len(names)} files *{suffix} in {folder}")
    target = _located(spark, to)[1]
    files.mkdirs(target.getParent())
    if not files.rename(names[0], target):
        raise OSError(f"cannot move {names[0]} to {to}")


def create_empty(spark: SparkSession, path: str) -> None:
    files, located = _located(spark, path)
    files.mkdirs(located.getParent())
    files.create(located, True).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    files, located = _located(spark, path)
    files.delete(located, True)
