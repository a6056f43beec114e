"""A run's state in shared storage: one file per move, numbered, so that of two drivers only one can move a run."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: The states of a run and where each may go.
MOVES = {"initialized": {"running"}, "running": {"waiting_for_review", "completed", "failed"}, "waiting_for_review": {"running"}, "failed": {"running"}, "completed": set()}


class StaleRun(RuntimeError):
    """Another driver has moved the run since this one read it."""


class Folder:
    """Small files under any path that Spark can write to."""

    def __init__(self, path: str, spark: SparkSession | None = None):
        self.spark = spark or SparkSession.active()
        self.path = path.rstrip("/")
        self._jvm, self._gateway = self.spark._jvm, self.spark.sparkContext._gateway
        self._conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        self._hadoop = self._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def put(self, name: str, text: str, *, replace: bool) -> bool:
        """Writes a draft and renames it; False where ``name`` is taken and may not be replaced.

        A file system with atomic renames (HDFS) lets one of several writers win; a store
        that renames by copying gives no such promise.
        """
        draft = f".{uuid.uuid4().hex}.draft"
        out = self._fs.create(self._at(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        kind = getattr(self._hadoop, "Options$Rename")
        options = self._gateway.new_array(kind, int(replace))
        if replace:
            options[0] = kind.OVERWRITE
        try:
            self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(self._fs.makeQualified(self._at(draft)), self._fs.makeQualified(self._at(name)), options)
        except Exception as e:
            self._fs.delete(self._at(draft), False)
            if not replace and self._fs.exists(self._at(name)):
                return False
            raise e
        return True

    def get(self, name: str) -> str:
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()[0]

    def names(self) -> list[str]:
        if not self._fs.exists(self._at("")):
            return []
        return [f.getPath().getName() for f in self._fs.listStatus(self._at(""))]


class Run:
    """A run's folder and state.

    ``number`` counts the moves written so far.  Move n is the file ``state.n.json``, which
    is never replaced: a driver that read an older state finds the next number taken.
    """

    def __init__(self, folder: str, run_id: str, state: str = "initialized", history: list[str] | None = None, number: int = 0):
        self.folder, self.run_id, self.state, self.number = folder, run_id, state, number
        self.history = list(history or ["initialized"])

    @classmethod
    def load(cls, folder: str, run_id: str) -> Run:
        files = Folder(f"{folder}/{run_id}")
        numbers = [int(n.split(".")[1]) for n in files.names() if n.startswith("state.") and n.endswith(".json")]
        if not numbers:
            raise ValueError(f"no state of run {run_id}")
        return cls(folder, **json.loads(files.get(f"state.{max(numbers)}.json")))

    def move(self, state: str) -> None:
        if state == self.state:
            return
        if state not in MOVES[self.state]:
            raise ValueError(f"a run cannot go from {self.state} to {state}")
        told = {"run_id": self.run_id, "state": state, "history": [*self.history, state], "number": self.number + 1}
        if not Folder(f"{self.folder}/{self.run_id}").put(f"state.{told['number']}.json", json.dumps(told), replace=False):
            raise StaleRun(f"run {self.run_id} has been moved by another driver")
        self.state, self.history, self.number = state, told["history"], told["number"]
        Folder(self.folder).put("latest", self.run_id, replace=True)


def latest(folder: str) -> Run:
    return Run.load(folder, Folder(folder).get("latest").strip())
