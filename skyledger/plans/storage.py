"""Where the tables of one deployment lie, and scratch folders for one-shot queries.

A deployment is one folder on shared storage::

    raw/YYYY/MM/DD/        landed documents, JSON objects
    silver/load=<id>/status=<ok|corrupt>/datetime_brasil=<day>/
    rollup/block=<b>/load=<id>/      mergeable gold states of that load
    merged_blocks/block=<b>/         those of a closed block, merged by stream, and merged_marks/
    commits/block=<b>/     a numbered mark per committed load
    compactions/           a mark per compaction of silver loads, which is a load that replaces others
    gold/slot=<0|1>/<merged_rollup|daily_wide>/<day partitions>, weather_codes/, touched/, refresh/
    ledger/<id>/folder=<landing folder>/load=<id>/   files that loads have taken, and ledger_note/
    catalogs/              databases whose views follow the current slot
    checkpoints/

A load counts from the moment its mark is written, which is the last thing it does; what a failed
load left behind has no mark and is read by nobody. Marks are numbered in order, a hundred to a
block, and so are the folders of the rollups: a refresh reads the blocks from the last merged number
on, however many loads there have been.

Of the two gold slots the one with the higher number in its ``refresh`` mark is current.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession


MERGED_ROLLUP = "merged_rollup"
WEATHER_CODES = "weather_codes"
TOUCHED_DAYS = "touched"
REFRESH_MARK = "refresh"
MARKS_PER_BLOCK = 100
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Deployment:
    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self._at("raw")

    @property
    def silver(self) -> str:
        return self._at("silver")

    @property
    def rollup(self) -> str:
        return self._at("rollup")

    @property
    def all_commits(self) -> str:
        return self._at("commits/block=*")

    @property
    def compactions(self) -> str:
        return self._at("compactions")

    @property
    def merged_blocks(self) -> str:
        return self._at("merged_blocks")

    @property
    def merged_marks(self) -> str:
        return self._at("merged_marks")

    @property
    def ledger_note(self) -> str:
        return self._at("ledger_note")

    def ledger(self, name: str) -> str:
        return self._at(f"ledger/{name}")

    @property
    def catalogs(self) -> str:
        return self._at("catalogs")

    @property
    def refresh_marks(self) -> str:
        return self._at(f"gold/slot=*/{REFRESH_MARK}")

    def commits(self, block: int) -> str:
        return self._at(f"commits/block={block}")

    def rollups(self, block: int) -> str:
        return self._at(f"rollup/block={block}")

    def gold(self, slot: int, table: str) -> str:
        return self._at(f"gold/slot={slot}/{table}")

    def checkpoint(self, stream: str) -> str:
        return self._at(f"checkpoints/{stream}")


def load_folder(table: str, load_id: str) -> str:
    return f"{table}/load={load_id}"


def block_of(number: int) -> int:
    return number // MARKS_PER_BLOCK


def _path_and_files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def has_folder(spark: SparkSession, folder: str) -> bool:
    path, files = _path_and_files(spark, folder)
    return files.exists(path)


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether there is a data file, in the folder or in folders of partitions."""
    path, files = _path_and_files(spark, folder)
    found = files.exists(path) and files.listFiles(path, True)
    while found and found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def glob_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that a pattern names; of files that it names, the folders they are in."""
    path, files = _path_and_files(spark, pattern)
    found = files.globStatus(path) or []
    folders = (s.getPath() if s.isDirectory() else s.getPath().getParent() for s in found)
    return list({folder.toString() for folder in folders})


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, the same for every session."""
    path, files = _path_and_files(spark, folder)
    return files.makeQualified(path).toString()


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files in a folder."""
    path, files = _path_and_files(spark, folder)
    return files.getContentSummary(path).getLength()


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder; whether it was there."""
    path, files = _path_and_files(spark, folder)
    return files.delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written or collected inside leaves no shuffle files: by default they stay on the disks of the
    executors until the driver happens to collect garbage, those of one step beside those of the next."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach, removed when
    the session's JVM ends.

    Only a local session without that setting, as in tests, gets a temporary folder of this machine,
    which is set for the session, so that all of it lies in one place.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="skyledger-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", shared)
    folder = f"{shared.rstrip('/')}/skyledger-{label}-{uuid.uuid4().hex}"
    path, files = _path_and_files(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder
