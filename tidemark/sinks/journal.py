"""A replacement of partitions that survives the loss of the driver at any moment.

New files are staged beside the table, in a folder readers pass over. A manifest, written in one
step, is the commit: before it the old rows are all there, after it the new state is decided.
Then staged folders take the place of old ones, partitions that received no row are emptied, and
the manifest goes. Each of these steps may be repeated, so whoever finds the manifest of a lost run
brings it to its end: the next replacement of any of its partitions, or :func:`recover`.

One writer at a time may replace a given partition; writers of different partitions of
one table do not meet.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import SparkSession

from tidemark.sinks.files import Files

JOURNAL, STAGED = "_journal", "_staged"
MOVES_AT_ONCE = 16


class Replacement:
    """The replacement of a set of partitions of the table at ``root``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], values: Sequence[Sequence]) -> None:
        """``values``: for each key those it may take; every combination is replaced."""
        self.files = Files(spark, root)
        self.keys, self.values = list(keys), [list(own) for own in values]
        self.id = uuid4().hex
        self.staged = f"{STAGED}/{self.id}"
        for manifest in manifests(self.files):
            if self._covers(parts_of(self.files, manifest)):
                finish(self.files, manifest)

    @property
    def folder(self) -> str:
        """Where to write the new rows, partitioned by the keys."""
        return f"{self.files.root}/{self.staged}"

    def commit(self) -> None:
        """Decide for the staged rows, then put them in place."""
        filled = set(self.files.below(self.staged, len(self.keys)))
        emptied = [name for name in self._stored() if name not in filled]
        name = f"{JOURNAL}/{self.id}.json"
        self.files.write_text(name, json.dumps(
            {"staged": self.staged, "keys": self.keys, "filled": sorted(filled), "emptied": emptied}))
        finish(self.files, name)

    def abandon(self) -> None:
        self.files.delete(self.staged)

    def _stored(self) -> list[str]:
        """Those partitions to replace that have a folder. One listing for each folder on the way."""
        found = [""]
        for key, values in zip(self.keys, self.values):
            wanted = {self.files.partition_name([key], [value]) for value in values}
            found = [f"{parent}/{name}".lstrip("/") for parent in found
                     for name in self.files.names(parent, folders=True) if name in wanted]
        return found

    def _covers(self, partitions: Collection[str]) -> bool:
        """Whether one of the partitions is to be replaced."""
        wanted = [{self.files.partition_name([key], [value]) for value in values}
                  for key, values in zip(self.keys, self.values)]
        return any(
            len(parts := name.split("/")) == len(wanted) and all(p in own for p, own in zip(parts, wanted))
            for name in partitions)


def manifests(files: Files) -> list[str]:
    return [f"{JOURNAL}/{name}" for name in files.names(JOURNAL) if name.endswith(".json")]


def parts_of(files: Files, manifest: str) -> list[str]:
    told = json.loads(files.read_text(manifest))
    return told["filled"] + told["emptied"]


def finish(files: Files, manifest: str) -> None:
    """Bring a committed replacement to its end, wherever it stopped."""
    told = json.loads(files.read_text(manifest))
    staged = told["staged"]

    def place(name: str) -> None:
        # A folder that is no longer staged is in its place already.
        if files.exists(f"{staged}/{name}"):
            files.delete(name)
            files.move(f"{staged}/{name}", name)

    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        list(pool.map(place, told["filled"]))
        list(pool.map(files.empty, told["emptied"]))
    files.delete(staged)
    files.delete(manifest)


def recover(spark: SparkSession, root: str, abandoned_after: dt.timedelta = dt.timedelta(days=1)) -> int:
    """Finish what lost runs had committed; returns how many. Call it while nobody writes to the table.

    Staged rows that were never committed are deleted once they are old enough to be nobody's.
    """
    files = Files(spark, root)
    pending = manifests(files)
    for manifest in pending:
        finish(files, manifest)
    now = time.time()
    for name in files.names(STAGED, folders=True):
        if files.age(f"{STAGED}/{name}", now) >= abandoned_after.total_seconds():
            files.delete(f"{STAGED}/{name}")
    return len(pending)
