"""Moving whole folders on the file system that Spark writes to."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class Store:
    """Looks at and moves folders; a move within one store is a rename."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        """Rename a folder; ``target`` must not be there."""
        to = self._path(target)
        if self._fs.exists(to):
            raise FileExistsError(target)
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._path(source), to):
            raise OSError(f"{source} cannot be moved to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def hidden(path: str) -> str:
    """A new folder beside the data of ``path`` that no read of it sees."""
    return f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Have ``write`` fill a new folder, and put it in the place of ``path`` once it is complete."""
    path = path.rstrip("/")
    store = Store(spark, path)
    fresh, old = (f"{path}-{uuid.uuid4().hex}" for _ in range(2))
    try:
        write(fresh)
        if store.exists(path):
            store.move(path, old)
        try:
            store.move(fresh, path)
        except Exception:
            if store.exists(old):
                store.move(old, path)
            raise
    finally:
        store.remove(fresh)
    store.remove(old)
