"""A log of numbered commit files, each written whole and once, by any number of writers.

A writer makes its file under another name and renames it to the next number without overwriting:
the file system lets one of several writers have the number. The others see what was committed
meanwhile and decide again. Readers see whole entries only.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class CommitLog:
    """Entries 1, 2, ... in ``folder``; ``schema`` names their fields beside ``number``."""

    spark: SparkSession
    folder: str
    schema: str

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def create(self) -> "CommitLog":
        self._files().mkdirs(self._path(""))
        return self

    def entries(self) -> list[dict[str, Any]]:
        """All entries in order: one small row per commit."""
        rows = self.spark.read.schema(f"number bigint, {self.schema}").json(self.folder).collect()
        return sorted((row.asDict() for row in rows), key=lambda entry: entry["number"])

    def append(self, number: int, entry: dict[str, Any]) -> bool:
        """Write ``entry`` as ``number``; False if another writer has that number."""
        jvm, files = self.spark._jvm, self._files()
        draft = self._path(f".draft-{uuid.uuid4().hex}")
        out = files.create(draft)
        try:
            out.write(bytearray(json.dumps({"number": number, **entry}).encode()))
        finally:
            out.close()
        renamer = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        no_options = self.spark.sparkContext._gateway.new_array(options, 0)
        try:
            renamer.rename(files.makeQualified(draft), files.makeQualified(self._path(f"{number:020d}.json")), no_options)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            return False
        return True
