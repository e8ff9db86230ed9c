"""Directory operations on whatever file system a path names (metadata only)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder reached through the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.path = path

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def make(self) -> None:
        self._fs.mkdirs(self._path)

    def delete(self) -> None:
        self._fs.delete(self._path, True)

    def move_to(self, target: "Folder") -> None:
        """Rename; the target must not exist yet."""
        if target.exists():
            raise FileExistsError(target.path)
        self._fs.mkdirs(target._path.getParent())
        if not self._fs.rename(self._path, target._path):
            raise OSError(f"cannot move {self.path} to {target.path}")

    def names(self, prefix: str = "") -> list[str]:
        if not self.exists():
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path) if s.isDirectory()]
        return sorted(n for n in found if n.startswith(prefix))

    def has(self, name: str) -> bool:
        return self._fs.exists(self._child(name))

    def mark(self, name: str) -> None:
        """An empty file, made in one step on every store."""
        self._fs.create(self._child(name), True).close()

    def unmark(self, name: str) -> None:
        self._fs.delete(self._child(name), False)

    def files(self) -> dict[str, int]:
        """Data files right below the folder, with their sizes."""
        if not self.exists():
            return {}
        found = {s.getPath().getName(): s.getLen() for s in self._fs.listStatus(self._path) if s.isFile()}
        return {name: size for name, size in found.items() if not name.startswith(("_", "."))}
