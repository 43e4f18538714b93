"""Tables of one release, published together or not at all.

A release is staged beside the published tables, then a mark names it, and then its
folders take the places of the old ones.  Readers follow the mark: before it is there
they find the old release, from then on the new one, whichever folders have moved.
A run that stops before the mark has changed nothing, and one that stops behind it
is finished by the next.

Only names are handled here (a mark, and a rename per table or per replaced partition
folder); rows are written and read by Spark.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

MARK, STAGED = "_commit", "_staged"


class Files:
    """The file system of a folder, through Hadoop's interface."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._utils = spark._jvm.org.apache.hadoop.io.IOUtils
        self.fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder that are partitions."""
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(path)) if s.isDirectory() and "=" in s.getPath().getName()]

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} couldn't be renamed to {new}")

    def create(self, path: str, text: str) -> None:
        """A small file, there whole or not at all."""
        draft = f"{path}.{uuid.uuid4().hex}"
        out = self.fs.create(self._path(draft))
        out.write(bytearray(text.encode()))
        out.close()
        self.rename(draft, path)

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def pending(files: Files, root: str) -> dict | None:
    """The release that a mark names: its staging folder, whole tables and tables replaced by partition."""
    mark = f"{root}/{MARK}"
    return json.loads(files.read(mark)) if files.exists(mark) else None


def stage(root: str) -> str:
    """A new staging folder's address; readers skip it."""
    return f"{root}/{STAGED}/{uuid.uuid4().hex}"


def commit(spark: SparkSession, root: str, staged: str, whole: Iterable[str], by_partition: Iterable[str] = ()) -> None:
    """Publishes the staged tables: from the mark on, readers see all of them.

    A table of ``by_partition`` keeps the published folders that the staged one doesn't have.
    """
    files = Files(spark, root)
    files.create(f"{root}/{MARK}", json.dumps({"staged": staged, "whole": list(whole), "by_partition": list(by_partition)}))
    finish(spark, root)


def finish(spark: SparkSession, root: str) -> None:
    """Moves what a marked release has still staged, and takes the mark away; safe to repeat."""
    files = Files(spark, root)
    release = pending(files, root) if files.exists(root) else None
    if release is None:
        return
    staged = release["staged"]
    for name in release["whole"]:
        if files.exists(f"{staged}/{name}"):
            files.delete(f"{root}/{name}")
            files.rename(f"{staged}/{name}", f"{root}/{name}")
    for name in release["by_partition"]:
        if not files.exists(f"{staged}/{name}"):
            continue
        if not files.exists(f"{root}/{name}"):
            files.rename(f"{staged}/{name}", f"{root}/{name}")
            continue
        for folder in files.folders(f"{staged}/{name}"):
            files.delete(f"{root}/{name}/{folder}")
            files.rename(f"{staged}/{name}/{folder}", f"{root}/{name}/{folder}")
    files.delete(f"{root}/{MARK}")
    files.delete(staged)


def has_released(spark: SparkSession, root: str, name: str) -> bool:
    """Whether the release that counts has a table."""
    files = Files(spark, root)
    release = pending(files, root) if files.exists(root) else None
    return files.exists(f"{root}/{name}") or release is not None and files.exists(f"{release['staged']}/{name}")


def read_released(spark: SparkSession, root: str, name: str, read, partition: str | None = None) -> DataFrame:
    """A table of the release that counts; ``read(path)`` gives the table of a folder.

    ``partition``: the partition column of a table that may be replaced by partition.  While such a table moves, its rows are those
    still staged and the published ones of other partitions.
    """
    files = Files(spark, root)
    release = pending(files, root) if files.exists(root) else None
    there = release is not None and files.exists(f"{release['staged']}/{name}")
    if there and name in release["whole"]:
        return read(f"{release['staged']}/{name}")
    if there and name in release["by_partition"] and files.folders(f"{release['staged']}/{name}"):
        new = read(f"{release['staged']}/{name}")
        if not files.exists(f"{root}/{name}"):
            return new
        replaced = new.select(F.col(partition).alias("__replaced")).distinct()
        old = read(f"{root}/{name}")
        return old.join(replaced, F.col(partition).eqNullSafe(F.col("__replaced")), "left_anti").unionByName(new)
    return read(f"{root}/{name}")
