"""A commit log in the shared folder: one small file a commit, made whole by a rename that never replaces.

Work is written first and committed last. What has no commit does not count, and a commit that is there already is a no-op;
so work that is repeated after a failure changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.path, jvm = path.rstrip("/"), spark._jvm
        self._path, self._jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self._conf, self._gateway = spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self._fs = self._path(self.path).getFileSystem(self._conf)

    def _names(self) -> list[int]:
        root = self._path(self.path)
        found = [str(x.getPath().getName()) for x in self._fs.listStatus(root)] if self._fs.exists(root) else []
        return sorted(int(n[:-5]) for n in found if n.endswith(".json") and not n.startswith((".", "_")))

    def last(self) -> int:
        """The greatest number that is committed; -1 if there is none."""
        return max(self._names(), default=-1)

    def has(self, number: int) -> bool:
        return self._fs.exists(self._path(self._file(number)))

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(self._file(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, number: int, content: dict) -> bool:
        """Whether this call has committed the number; False if it is there already, whose content stays."""
        draft, final = self._path(f"{self.path}/_{uuid.uuid4().hex}"), self._path(self._file(number))
        stream = self._fs.create(draft)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        rename = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)  # no OVERWRITE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(draft, final, rename)
            return True
        except Exception:
            if not self.has(number):
                raise
            self._fs.delete(draft, False)
            return False

    def forget(self, below: int) -> None:
        """Remove commits under a number: for logs of which only the newest counts."""
        for n in self._names():
            if n < below:
                self._fs.delete(self._path(self._file(n)), False)

    def remove(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:020d}.json"
