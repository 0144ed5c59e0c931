"""Moving finished files into place, through Hadoop's file systems.

Every call is a metadata operation of the driver, as the commit of a write is:
one per directory or file moved, never one per row.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(file system, path object) of ``path``."""
    context = spark.sparkContext
    own = context._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(context._jsc.hadoopConfiguration()), own


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, own = _at(spark, path)
    return fs.exists(own)


def beside(path: str, label: str) -> str:
    """A fresh path in the same folder, hidden from readers of that folder."""
    folder, slash, name = path.rstrip("/").rpartition("/")
    return f"{folder}{slash}_{name}-{label}-{uuid.uuid4().hex[:12]}"


def listed(spark: SparkSession, path: str, hidden: bool = False) -> list[tuple[str, bool, int]]:
    """(name, is a directory, bytes) of what stands in a folder, by name; without
    what readers skip unless ``hidden``."""
    fs, own = _at(spark, path)
    if not fs.exists(own):
        return []
    found = [(s.getPath().getName(), s.isDirectory(), s.getLen()) for s in fs.listStatus(own)]
    return sorted(f for f in found if hidden or not _hidden(f[0]))


def data_files(spark: SparkSession, path: str, sizes: bool = False) -> dict[str, list]:
    """Names (or names and bytes) of the data files of every folder below ``path`` that
    has any, by the folder's path relative to it."""
    fs, root = _at(spark, path)
    found: dict[str, list] = {}
    if not fs.exists(root):
        return found
    start = len(fs.makeQualified(root).toString().rstrip("/")) + 1
    files = fs.listFiles(root, True)
    while files.hasNext():
        status = files.next()
        folder, _, name = status.getPath().toString()[start:].rpartition("/")
        if not any(map(_hidden, [*folder.split("/"), name])):
            found.setdefault(folder, []).append((name, status.getLen()) if sizes else name)
    return {folder: sorted(names) for folder, names in sorted(found.items())}


def _hidden(name: str) -> bool:
    """Whether readers skip it: a name that begins with _ or . and is no partition folder."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


#: What ``key`` takes off a path, as a regular expression.
SCHEME = "^[A-Za-z0-9+.-]+:/+"


def key(spark: SparkSession, path: str) -> str:
    """The path as ``_metadata.file_path`` writes it, without scheme and leading slashes."""
    fs, own = _at(spark, path)
    return re.sub(SCHEME, "", fs.makeQualified(own).toUri().toString())


def remove(spark: SparkSession, path: str) -> None:
    fs, own = _at(spark, path)
    fs.delete(own, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the target must not exist, its parent is made."""
    fs, a = _at(spark, source)
    b = _path(spark, target)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``. The old one is kept beside
    it until the new one is there, and comes back if it cannot be put there."""
    fs, new = _at(spark, source)
    place, old = _path(spark, target), None
    if fs.exists(place):
        old = _path(spark, beside(target, "old"))
        if not fs.rename(place, old):
            raise OSError(f"cannot move {target} aside")
    else:
        fs.mkdirs(place.getParent())
    if not fs.rename(new, place):
        if old is not None:
            fs.rename(old, place)
        raise OSError(f"cannot move {source} to {target}")
    if old is not None:
        fs.delete(old, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if another writer has made it before."""
    fs, own = _at(spark, path)
    fs.mkdirs(own.getParent())
    return fs.createNewFile(own)
