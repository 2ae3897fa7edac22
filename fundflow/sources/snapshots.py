"""Versions of a group of tables below one root, made visible by one rename.

Data files go to folders of their own, which nothing refers to until a version
names them. A version is one small JSON file, written under a hidden name and
renamed to ``versions/N.json``, which fails if there is an N already: of two
writers that began from the same version, one has to begin again. Readers take
the highest version, so they see all tables of a commit or none.

Files are reached through Hadoop's ``FileContext``, so any store that Spark
writes will do whose rename is atomic (HDFS, a local or mounted folder, ABFS).
A plain object store renames by copying one small file; there, let one writer
commit at a time.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from fundflow.sources.files import context, names, text

_NAME = re.compile(r"^(\d{12})\.json$")


class Conflict(Exception):
    """Another writer committed first."""


@dataclass(frozen=True)
class Version:
    """What a commit holds; number 0 with no content before the first one."""

    number: int = 0
    content: dict[str, Any] = field(default_factory=dict)


class Snapshots:
    """The versions below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files, _ = context(spark, self.root)

    def _path(self, text: str) -> Any:
        return self._hadoop.Path(text)

    def folder(self, label: str) -> str:
        """A fresh folder for data; it is not created."""
        return f"{self.root}/data/{label}-{uuid.uuid4().hex}"

    def numbers(self) -> list[int]:
        """Numbers of all versions, ascending."""
        found = (_NAME.match(name) for name, _ in names(self.spark, f"{self.root}/versions"))
        return sorted(int(m[1]) for m in found if m)

    def read(self, number: int) -> Version:
        path = f"{self.root}/versions/{number:012d}.json"
        return Version(number, json.loads(text(self.spark, path)))

    def current(self) -> Version:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else Version()

    def commit(self, content: dict[str, Any], after: Version) -> Version:
        """Make ``content`` the version that follows ``after``, or raise ``Conflict``."""
        number = after.number + 1
        folder = self._path(f"{self.root}/versions")
        hidden = self._path(f"{self.root}/versions/.{uuid.uuid4().hex}")
        store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        store.mkdirs(folder)
        out = store.create(hidden, False)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        gateway = self.spark.sparkContext._gateway
        options = gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            self._files.rename(hidden, self._path(f"{self.root}/versions/{number:012d}.json"), options)
        except Py4JJavaError as error:
            self._files.delete(hidden, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise Conflict(f"version {number} of {self.root} exists already") from error
            raise
        return Version(number, content)

    def clean(self, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
        """Delete versions before the last ``keep``, and data folders that none of those name.

        A folder is left alone until it is ``older_than`` seconds old, as a writer
        may be filling it; choose more than the longest run and the longest read.
        """
        numbers = self.numbers()
        kept = numbers[-keep:]
        named = json.dumps([self.read(n).content for n in kept])
        for number in numbers[: -keep or None]:
            self._files.delete(self._path(f"{self.root}/versions/{number:012d}.json"), False)
        limit = (time.time() - older_than) * 1000
        gone = []
        for name, changed in names(self.spark, f"{self.root}/data"):
            if name not in named and changed <= limit:
                self._files.delete(self._path(f"{self.root}/data/{name}"), True)
                gone.append(name)
        return gone
