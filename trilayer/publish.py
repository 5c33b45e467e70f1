"""Tables are staged beside their place and moved there once they are whole.

A staged folder is committed by the marker that Spark's writer leaves after its last task. From
then on it is a redo record: `settle`, which every reader and writer of the library calls
first, moves what is still staged. A job that dies before the marker leaves the old table,
one that dies after it the new one, never a part of either.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

#: A staged folder replaces the whole table, or the partitions it holds.
WHOLE, PARTS = "whole", "parts"
_COMMITTED = "_SUCCESS"


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(place)


def _children(files: JavaObject, folder: JavaObject) -> list[JavaObject]:
    return [status.getPath() for status in files.listStatus(folder)] if files.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def _move(files: JavaObject, source: JavaObject, target: JavaObject) -> None:
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def _redo(files: JavaObject, staged: JavaObject, target: JavaObject, kind: str) -> None:
    """Move what is staged; may be called again after it was interrupted at any point."""
    if kind == WHOLE:
        _move(files, staged, target)
        return
    for part in _children(files, staged):
        if "=" in part.getName():
            _move(files, part, target.suffix(f"/{part.getName()}"))
    files.delete(staged, True)


def settle(spark: SparkSession, path: str) -> None:
    """Finish the committed replacements of a table, or of single partitions, that were
    interrupted. What was not committed is left alone: its writer may be at work."""
    files, table = _file_system(spark, path)
    for folder in filter(None, (table.getParent(), table)):
        for staged in _children(files, folder):
            target, _, mark = staged.getName().removeprefix(".").rpartition(".")
            kind = mark.partition("-")[0]
            if not staged.getName().startswith(".") or kind not in (WHOLE, PARTS):
                continue
            if folder.equals(table.getParent()) and target != table.getName():
                continue
            if files.exists(staged.suffix(f"/{_COMMITTED}")):
                _redo(files, staged, folder.suffix(f"/{target}"), kind)


def promote(spark: SparkSession, chosen: str, staged: str) -> None:
    """Let a folder inside a staged one take its place, the marker last."""
    files, inner = _file_system(spark, chosen)
    _, outer = _file_system(spark, staged)
    marker = inner.suffix(f"/{_COMMITTED}")
    for child in _children(files, inner):
        if not child.equals(marker):
            _move(files, child, outer.suffix(f"/{child.getName()}"))
    for child in _children(files, outer):
        if "=" not in child.getName() and not child.equals(inner):
            files.delete(child, True)
    _move(files, marker, outer.suffix(f"/{_COMMITTED}"))
    files.delete(inner, True)


@contextmanager
def replacing(spark: SparkSession, path: str, kind: str = WHOLE) -> Iterator[str]:
    """A folder to write the replacement to; on leaving, it takes the table's place.

    Its name begins with a dot, so no reader takes it for data. One writer per table.
    """
    settle(spark, path)
    files, table = _file_system(spark, path)
    staged = table.getParent().suffix(f"/.{table.getName()}.{kind}-{uuid.uuid4().hex}")
    try:
        yield staged.toString()
    except BaseException:
        files.delete(staged, True)
        raise
    _redo(files, staged, table, kind)
