"""Small files on whatever file system Spark uses: JSON that is published whole, listings, removal."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(""))] if self.fs.exists(self._path("")) else []

    def read(self, name: str) -> dict | None:
        if not self.fs.exists(self._path(name)):
            return None
        stream = self.fs.open(self._path(name))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, name: str, value: dict) -> None:
        """Written beside its place, then renamed to it; an existing file of that name is an error."""
        part = f".{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(part))
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        if self.fs.exists(self._path(name)) or not self.fs.rename(self._path(part), self._path(name)):
            self.fs.delete(self._path(part), False)
            raise FileExistsError(f"{self.root}/{name}")

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
