"""Small files in folders that the driver reads and writes by Hadoop's file systems, wherever Spark itself can read and write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder by the path that Spark knows it by."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.sc, self.path = spark.sparkContext, path.rstrip("/")
        self.jvm = self.sc._jvm
        self.conf = self.sc._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """What lies in the folder, or in one below it."""
        at = self._path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def sizes(self, name: str) -> dict[str, int]:
        """Bytes of data files by the folder, under ``name``, that they lie in."""
        at, out = self._path(name), {}
        if not self.fs.exists(at):
            return out
        files = self.fs.listFiles(at, True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                parent = f.getPath().getParent().getName()
                out[parent] = out.get(parent, 0) + f.getLen()
        return out

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole, and takes the place of one that is there."""
        folder, _, last = name.rpartition("/")
        hidden = self._path(f"{folder}/.{last}.{uuid.uuid4().hex}" if folder else f".{last}.{uuid.uuid4().hex}")
        stream = self.fs.create(hidden, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        overwrite = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        options = self.sc._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = overwrite
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), self.conf).rename(hidden, self._path(name), options)

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class Numbered:
    """JSON texts by number in a folder; the latest before a number is the state there."""

    def __init__(self, folder: Folder, name: str) -> None:
        self.folder, self.name = folder, name

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names(self.name) if n.endswith(".json") and n[:-5].lstrip("-").isdigit())

    def latest(self, before: int | None = None) -> tuple[int, str] | None:
        found = [n for n in self.numbers() if before is None or n < before]
        return (found[-1], self.read(found[-1])) if found else None

    def read(self, number: int) -> str:
        return self.folder.read(f"{self.name}/{number}.json")

    def put(self, number: int, text: str) -> None:
        self.folder.write(f"{self.name}/{number}.json", text)

    def keep(self, last: int) -> None:
        """Deletes all but so many of the highest numbers."""
        for n in self.numbers()[: -max(1, last)]:
            self.folder.delete(f"{self.name}/{n}.json")
