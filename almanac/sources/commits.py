"""What a table consists of, switched in one step.

A table's data lies in folders that are written once and never changed. A commit is a small numbered
file that says which folders count; the highest complete number is the table. A writer makes
its folders first and then creates the next number, which the file system refuses when another writer was
faster; then it looks at the new state and tries again. A run that dies at any point leaves the old state
or the new one. Readers that began with an older state go on with it, as its folders stay until
`clean` finds that they have been out of use for long enough.

The next number is created exclusively. On a store without exclusive creation (plain S3), let one
writer at a time change a table.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from almanac.sources.files import _located, remove_folder

_NAME = re.compile(r"(\d{9})\.json")
#: A commit file that is still incomplete after so long belongs to a writer that died.
DEAD_AFTER_SECONDS = 60
TRIES = 20


@dataclass(frozen=True)
class Commit:
    number: int
    time: float  # seconds
    state: dict | None  # None: not complete


class CommitConflict(RuntimeError):
    """Another writer was in the way for too long."""


class Commits:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def head(self) -> dict:
        """The state that counts now; empty before the first commit."""
        for commit in reversed(self._listed()):
            state = self._read(commit.number)
            if state is not None:
                return state
        return {}

    def history(self) -> list[Commit]:
        """All complete commits that are still there, oldest first."""
        read = [Commit(c.number, c.time, self._read(c.number)) for c in self._listed()]
        return [c for c in read if c.state is not None]

    def commit(self, change: Callable[[dict], dict]) -> dict:
        """Make `change` of the present state the present state; `change` runs again when another writer was faster."""
        for _ in range(TRIES):
            listed = self._listed()
            last = listed[-1] if listed else Commit(0, 0.0, None)
            state = self._read(last.number) if listed else {}
            if state is None:
                if time.time() - last.time < DEAD_AFTER_SECONDS:
                    time.sleep(0.2)  # being written
                    continue
                state = self.head()
            fresh = change(state)
            if self._create(last.number + 1, fresh):
                return fresh
        raise CommitConflict(f"other writers keep changing {self.folder}")

    def in_use(self, keep_seconds: float) -> tuple[list[dict], float]:
        """(states that readers may still hold, the time before which others are out of use): the head, and what it replaced of late."""
        limit = time.time() - keep_seconds
        commits = self.history()
        return [c.state for i, c in enumerate(commits) if i + 1 == len(commits) or commits[i + 1].time >= limit], limit

    def forget(self, keep_seconds: float) -> None:
        """Remove the commit files of states out of use."""
        commits = self._listed()
        limit = time.time() - keep_seconds
        complete = [c for c in commits if self._read(c.number) is not None]
        for commit, successor in zip(complete, complete[1:], strict=False):
            if successor.time < limit:
                remove_folder(self.spark, self._path(commit.number))

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:09d}.json"

    def _listed(self) -> list[Commit]:
        files, located = _located(self.spark, self.folder)
        if not files.exists(located):
            return []
        found = [(s.getPath().getName(), s.getModificationTime() / 1000) for s in files.listStatus(located)]
        return sorted((Commit(int(m[1]), at, None) for name, at in found if (m := _NAME.fullmatch(name))), key=lambda c: c.number)

    def _read(self, number: int) -> dict | None:
        files, located = _located(self.spark, self._path(number))
        stream = files.open(located)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()

    def _create(self, number: int, state: dict) -> bool:
        files, located = _located(self.spark, self._path(number))
        files.mkdirs(located.getParent())
        try:
            stream = files.create(located, False)
        except Py4JJavaError as fault:
            if "FileAlreadyExists" in str(fault.java_exception):
                return False
            raise
        try:
            stream.write(json.dumps(state).encode())
        finally:
            stream.close()
        return True
