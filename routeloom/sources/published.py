"""Published outputs: which of a path's versions counts, and how it changes.

A published path holds each version of an output in a folder of its own, and empty marker
files whose names say which version counts: the marker with the highest number. Making an
empty file is one step on every file system, so there is no moment without a whole output:
until the marker is there readers find the version before, and from then on the new one.
A path without markers is an ordinary folder and stands for itself.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# Names that begin with an underscore are no data to Spark's readers.
MARKERS = "_published"
VERSION = "v-"
# Versions that stay: the one that counts and the one a reader may have begun with.
KEPT_VERSIONS = 2
# A version without a marker that is older than this is taken for given up.
GIVEN_UP_SECONDS = 24 * 3600


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.path).getFileSystem(context._jsc.hadoopConfiguration())

    def names(self, inner: str = "") -> dict[str, float]:
        """What lies in the folder, with the times of change in seconds; nothing if it is not there."""
        place = self._path(f"{self.path}/{inner}" if inner else self.path)
        if not self._system.exists(place):
            return {}
        return {
            found.getPath().getName(): found.getModificationTime() / 1000
            for found in self._system.listStatus(place)
        }

    def make(self, inner: str) -> bool:
        """An empty file; false if there is one already."""
        return self._system.createNewFile(self._path(f"{self.path}/{inner}"))

    def delete(self, inner: str) -> None:
        self._system.delete(self._path(f"{self.path}/{inner}"), True)


def _marked(folder: Folder) -> list[tuple[int, str, str]]:
    """(number, version, place in it) of each marker, the one that counts last."""
    markers = []
    for name in folder.names(MARKERS):
        number, _, rest = name.partition(".")
        version, _, inner = rest.partition(".")
        if number.isdigit() and version:
            markers.append((int(number), version, inner))
    return sorted(markers)


def published(spark: SparkSession, path: str) -> str:
    """Where the rows of a path are: its present version, or the path itself."""
    folder = Folder(spark, path)
    markers = _marked(folder)
    if not markers:
        return path
    _, version, inner = markers[-1]
    return "/".join(filter(None, (folder.path, VERSION + version, inner)))


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    check: Callable[[str], None] | None = None,
    inner: str = "",
) -> str:
    """Write a new version of a path and let it count; gives the folder of its rows.

    ``write`` is given the folder to write to, ``check`` the place of the rows in it:
    ``inner``, if only that part of what was written counts. If either raises, the version
    before stays. Of writers at the same time each makes a whole version; the one that
    comes last counts. Plain files that were at the path go once a version counts.
    """
    folder, version = Folder(spark, path), uuid.uuid4().hex
    made = f"{folder.path}/{VERSION}{version}"
    rows = f"{made}/{inner}" if inner else made
    try:
        write(made)
        if check is not None:
            check(rows)
    except BaseException:
        folder.delete(VERSION + version)
        raise
    _mark(folder, version, inner)
    _tidy(folder)
    return rows


def _mark(folder: Folder, version: str, inner: str) -> None:
    markers = _marked(folder)
    number = markers[-1][0] + 1 if markers else 1
    name = ".".join(filter(None, (f"{number:020d}", version, inner)))
    if not folder.make(f"{MARKERS}/{name}"):
        raise OSError(f"{folder.path} has a marker {name} already")


def _tidy(folder: Folder) -> None:
    """Delete what no reader can have begun with: markers first, so that none is left alone."""
    markers = _marked(folder)
    old, new = markers[:-KEPT_VERSIONS], markers[-KEPT_VERSIONS:]
    for number, version, inner in old:
        folder.delete(f"{MARKERS}/" + ".".join(filter(None, (f"{number:020d}", version, inner))))
    kept = {VERSION + version for _, version, _ in new}
    gone = {VERSION + version for _, version, _ in old}
    for name, changed in folder.names().items():
        given_up = name.startswith(VERSION) and time.time() - changed > GIVEN_UP_SECONDS
        plain = not name.startswith(VERSION) and name != MARKERS
        if name not in kept and (name in gone or given_up or plain):
            folder.delete(name)
