"""Small files and folders through the file systems Spark itself uses, from the driver."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Folder:
    spark: SparkSession
    path: str

    def _at(self, name: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _files(self) -> Any:
        return self._at("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, name: str = "") -> bool:
        return self._files().exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What the folder (or one below it) holds; nothing if there is none."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._files().listStatus(self._at(name)))

    def text(self, name: str) -> str:
        stream = self._files().open(self._at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str, draft: str) -> None:
        """Write a file as a whole: first as ``draft``, then under its name, which must not be
        taken."""
        stream = self._files().create(self._at(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self._at("").toUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        context.rename(self._at(draft), self._at(name), no_options)

    def remove(self, name: str = "") -> None:
        self._files().delete(self._at(name), True)
