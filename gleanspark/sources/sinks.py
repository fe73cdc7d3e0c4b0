"""Publishing: every output is staged, then all are put in place, or none.

Works through Hadoop's file system, so on any store that Spark reaches. Only the driver touches names; data is written by tasks.
"""

from __future__ import annotations

import json
import os
import socket
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LOCK_HOURS = 24


class Store:
    """A folder on a Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, relative: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}" if relative else self.root)

    def exists(self, relative: str) -> bool:
        return self.fs.exists(self.path(relative))

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, relative: str) -> None:
        self.fs.delete(self.path(relative), True)

    def write(self, relative: str, text: str, overwrite: bool = True) -> None:
        out = self.fs.create(self.path(relative), overwrite)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, relative: str) -> str:
        stream = self.fs.open(self.path(relative))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def parts(self, relative: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(relative)) if s.getPath().getName().startswith("part-"))


def stage(store: Store, relative: str, rows: DataFrame, single: bool) -> None:
    """Writes the column ``json`` as lines: a folder of part files, or a single file if asked for."""
    if not single:
        rows.select("json").write.text(f"{store.root}/{relative}")
        return
    rows.select("json").coalesce(1).write.text(f"{store.root}/{relative}.parts")
    found = store.parts(f"{relative}.parts")
    if found:
        store.move(f"{relative}.parts/{found[0]}", relative)
    else:
        store.write(relative, "")
    store.delete(f"{relative}.parts")


def publish(store: Store, staged: dict[str, str], run_id: str, move: Callable[[str, str], None] | None = None) -> None:
    """Moves staged outputs (target -> staged name) into place. On any failure what was replaced comes back, last first.

    If that fails too, the backups stay where they are and the error says so.
    """
    move, done = move or store.move, []
    try:
        for target, source in staged.items():
            backup = f".tmp/{run_id}.backup/{target}" if store.exists(target) else None
            if backup:
                store.move(target, backup)
            done.append((target, backup))
            move(source, target)
    except Exception as failure:
        try:
            for target, backup in reversed(done):
                store.delete(target)
                if backup:
                    store.move(backup, target)
        except Exception as again:
            raise RuntimeError(f"rollback failed; backups are in .tmp/{run_id}.backup") from again
        raise failure
    store.delete(f".tmp/{run_id}.backup")


def _alive(owner: dict) -> bool:
    if owner.get("host") != socket.gethostname():
        return True
    try:
        os.kill(int(owner["pid"]), 0)
    except ProcessLookupError:
        return False
    except (OSError, ValueError, KeyError):
        return True
    return True


def acquire_lock(store: Store, day: str, run_id: str, now: float | None = None) -> str:
    """Creates the lock of a date. One held by a live process of this host or younger than a day is an error; an older or dead one is taken over."""
    name, now = f".locks/{day}.lock", now or time.time()
    text = json.dumps({"run_id": run_id, "pid": os.getpid(), "host": socket.gethostname(), "at": now})
    for _ in range(2):
        try:
            store.write(name, text, overwrite=False)
            return name
        except Exception:
            if not store.exists(name):
                raise
            try:
                owner = json.loads(store.read(name))
            except ValueError:
                owner = {}
            here = owner.get("host") == socket.gethostname()
            if here and _alive(owner) or not here and now - float(owner.get("at", 0)) < LOCK_HOURS * 3600:
                raise RuntimeError(f"{day} is locked by run {owner.get('run_id')}") from None
            store.delete(name)
    raise RuntimeError(f"{day} is locked")


def release_lock(store: Store, day: str, run_id: str) -> None:
    """Removes the lock if this run holds it."""
    name = f".locks/{day}.lock"
    if store.exists(name) and json.loads(store.read(name)).get("run_id") == run_id:
        store.delete(name)
