"""Several tables changed as one: new folders are written first, one small pointer file is put in place last.

A pointer is ``root/_commits/<version>.json``. Readers follow the one with the greatest
version, so a writer that fails half-way leaves folders no pointer names, and nothing else.
Folders that a pointer names are never written again: a table read before a commit stays readable
after it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from chartloom.sources.paths import file_system

POINTERS = "_commits"


def fresh_name() -> str:
    """A folder name that no earlier writer can have used."""
    return uuid.uuid4().hex


def latest(spark: SparkSession, root: str) -> tuple[int, dict[str, Any]]:
    """Version and state of the newest commit; (0, {}) before the first."""
    system, folder = file_system(spark, f"{root.rstrip('/')}/{POINTERS}")
    if not system.exists(folder):
        return 0, {}
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    version = max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)
    if not version:
        return 0, {}
    stream = system.open(_pointer(spark, root, version))
    try:
        return version, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, change: Callable[[dict[str, Any]], dict[str, Any]]) -> int:
    """Put ``change(state)`` in the place of the newest state and return its version.

    Another writer's commit in between is not lost: the change is made again on its state.
    Between writers this relies on a rename that refuses an existing target (as HDFS's does).
    """
    while True:
        version, state = latest(spark, root)
        if _put(spark, root, version + 1, change(state)):
            return version + 1


def _pointer(spark: SparkSession, root: str, version: int):
    return file_system(spark, f"{root.rstrip('/')}/{POINTERS}/{version}.json")[1]


def _put(spark: SparkSession, root: str, version: int, state: dict[str, Any]) -> bool:
    target = _pointer(spark, root, version)
    system, draft = file_system(spark, f"{root.rstrip('/')}/{POINTERS}/.{fresh_name()}")
    stream = system.create(draft, False)
    stream.write(json.dumps(state).encode())
    stream.close()
    if not system.exists(target) and system.rename(draft, target):
        return True
    system.delete(draft, False)
    if not system.exists(target):
        raise OSError(f"cannot put {target.toString()} in place")
    return False
