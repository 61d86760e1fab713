"""Control values that several drivers raise: a versioned table whose commits are files that are created only if absent."""

from __future__ import annotations

import json
import os
import random
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Versions that stay behind the last one, for a reader that has just listed them.
KEPT = 16


class LostRaceError(RuntimeError):
    """Others were first each time."""


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def create_if_absent(spark: SparkSession, name: str, content: bytes) -> bool:
    """Whether this call made the file; another one's stays as it is.

    The content is written beside it and takes its name in one step. A local
    file system's rename replaces what is there, so there a link is made, which
    fails; elsewhere the store's own rename without overwriting decides.
    """
    jvm = spark._jvm
    path, fs = _path(spark, name)
    fs.mkdirs(path.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(path.getParent(), f"_draft-{uuid.uuid4().hex}")
    if fs.getUri().getScheme() == "file":
        own, goal = (fs.makeQualified(p).toUri().getPath() for p in (draft, path))
        with open(own, "wb") as f:
            f.write(content)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(own, goal)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    out = fs.create(draft, False)
    out.write(bytearray(content))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(path), options)
        return True
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(draft, False)


@dataclass
class Counter:
    """A number in a folder; each change is the next version, and only one writer can make it."""

    spark: SparkSession
    folder: str
    tries: int = 50

    def _versions(self) -> list[int]:
        path, fs = _path(self.spark, self.folder)
        if not fs.exists(path):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(path))
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _file(self, version: int) -> str:
        return f"{self.folder}/v{version:020d}.json"

    def read(self) -> tuple[int, int | None]:
        """(version, value): 0 and None if it was never set."""
        for _ in range(self.tries):
            versions = self._versions()
            if not versions:
                return 0, None
            path, fs = _path(self.spark, self._file(versions[-1]))
            try:
                stream = fs.open(path)
            except Exception as e:
                if "FileNotFound" not in str(e):
                    raise
                continue  # it was pruned since it was listed
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "utf-8")
            stream.close()
            return versions[-1], json.loads(text)["value"]
        raise LostRaceError(f"{self.folder}: versions went faster than they could be read")

    def change(self, f: Callable[[int | None], int | None]) -> tuple[int | None, int | None]:
        """(value before, value after) of a change by f, which may be asked again when another writer was first; None leaves the value."""
        for k in range(self.tries):
            version, old = self.read()
            new = f(old)
            if new is None:
                return old, old
            if create_if_absent(self.spark, self._file(version + 1), json.dumps({"value": new}).encode()):
                self._prune(version + 1 - KEPT)
                return old, new
            time.sleep(random.random() * min(0.5, 0.01 * 2**k))
        raise LostRaceError(f"{self.folder}: lost {self.tries} races")

    def _prune(self, before: int) -> None:
        for version in self._versions():
            if version < before:
                path, fs = _path(self.spark, self._file(version))
                fs.delete(path, False)

    def raise_to(self, value: int) -> int:
        """The highest value so far, which is at least this one; it never falls."""
        return self.change(lambda old: value if old is None or old < value else None)[1]

    def take(self, n: int, start: int = 0) -> range:
        """The next n numbers above the value, or above `start` if it was never set; no other writer gets them."""
        old, _ = self.change(lambda v: (start if v is None else v) + n)
        first = (start if old is None else old) + 1
        return range(first, first + n)
