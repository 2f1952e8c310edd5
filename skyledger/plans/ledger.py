"""New raw files to silver by a ledger of the files that loads have taken.

A stream over a folder keeps the path of every file it has seen in the memory of the driver. Here
the paths lie in a table beside the loads, by landing folder and load. A run lists some landing
folders at a time, takes away what the ledger has for them and loads the rest, so that the driver
holds the listing of a few folders and the paths of one load, however many files there have been. A
file counts by its name alone: one that comes late, with an old time stamp, is found as any other.

The ledger of a load is written before its mark. A note of the load that is under way tells the next run
which rows of the ledger to forget if that mark never came.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.operators.silver import to_silver
from skyledger.plans.storage import (
    Deployment,
    glob_folders,
    has_folder,
    remove_folder,
)
from skyledger.sinks.tables import LoadMetrics, next_number, supersede as mark_superseded, write_load
from skyledger.sources.commits import if_there, marks_above, streams
from skyledger.sources.raw import RAW_GLOB, parse_documents
from skyledger.sources.schema import CORRUPT

#: Landing folders that are listed at a time, and files that one load takes.
FOLDERS_AT_ONCE = 32
FILES_PER_LOAD = 10_000
_ROWS = "name string, folder string, load string"


@dataclass(frozen=True)
class _Note:
    """The load under way, or the last one: its ledger, number, name and the keys of its folders."""

    ledger: str
    number: int = -1
    load: str | None = None
    folders: list[str] = field(default_factory=list)


def _read_note(spark: SparkSession, deployment: Deployment) -> _Note | None:
    note = if_there(spark, lambda: spark.read.text(deployment.ledger_note))
    rows = [] if note is None else note.collect()
    return _Note(**json.loads(rows[0][0])) if rows else None


def _write_note(spark: SparkSession, deployment: Deployment, note: _Note) -> None:
    text = spark.createDataFrame([(json.dumps(asdict(note)),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(deployment.ledger_note)


#: What stands in the name of a partition as it is.
_SAFE = "[^A-Za-z0-9.-]"


def _key(folder: str) -> str:
    """The name of a landing folder as a partition of the ledger: the end of its path, and a digest
    that tells apart what reads the same."""
    end = "-".join(folder.rstrip("/").split("/")[-3:])
    return f"{re.sub(_SAFE, '_', end)}-{hashlib.md5(end.encode()).hexdigest()[:8]}"


def _key_of(end: Column) -> Column:
    digest = F.substring(F.md5(end), 1, 8)
    return F.concat_ws("-", F.regexp_replace(end, _SAFE, "_"), digest)


def _rows_of(root: str, key: str) -> str:
    return f"{root}/folder={key}"


def _forget(spark: SparkSession, deployment: Deployment, note: _Note) -> None:
    for folder in note.folders:
        root = deployment.ledger(note.ledger)
        remove_folder(spark, f"{_rows_of(root, folder)}/load={note.load}")


def _settled(spark: SparkSession, deployment: Deployment, take_over: bool) -> _Note:
    """The state to go on from. Reads the marks since the last load of this ledger, or all at first."""
    note = _read_note(spark, deployment)
    if note is not None:
        marks = marks_above(spark, deployment, note.number - 1)
        of_load = F.col("load") == note.load
        of_others = F.col("load").isNotNull() & F.col("stream").isNotNull()
        of_others &= F.col("stream") != note.ledger
        seen = marks.agg(
            F.max(of_load).alias("committed"),
            F.max(of_others | (F.col("supersedes") == note.ledger)).alias("others"),
        ).first()
        if note.load is not None and not seen["committed"]:
            _forget(spark, deployment, note)
        if not seen["others"]:
            return note
    others = streams(spark, deployment)  # with an earlier ledger of this deployment's, if one is left
    if others and not take_over:
        raise ValueError(
            f"{deployment.root} has loads of an ingest stream ({', '.join(sorted(others))}), whose "
            "files this ledger does not know and would load again; pass supersede=True to replace "
            "those loads."
        )
    fresh = _Note(f"ledger-{uuid.uuid4().hex}")
    for stream in sorted(others):
        mark_superseded(spark, deployment, stream, fresh.ledger)
    _write_note(spark, deployment, fresh)
    return fresh


def _listed(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``folder`` and ``name`` of the files in the folders; no file is opened."""
    files = spark.read.format("binaryFile").load(folders)
    files = files.select("path", F.split("path", "/").alias("parts"))
    n = F.size("parts")
    key = _key_of(F.concat_ws("-", F.slice("parts", n - 3, F.lit(3))))
    return files.select("path", key.alias("folder"), F.element_at("parts", -1).alias("name"))


def _known(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """What the ledger has for the folders; others are not read."""
    there = [p for f in folders if has_folder(spark, p := _rows_of(root, _key(f)))]
    if not there:
        return spark.createDataFrame([], _ROWS)
    return spark.read.schema(_ROWS).option("basePath", root).parquet(*there)


def new_files(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """``path``, ``folder`` and ``name`` of files that the ledger below ``root`` does not have."""
    known = _known(spark, root, folders).select("folder", "name")
    return _listed(spark, folders).join(known, ["folder", "name"], "left_anti")


def _chunks(folders: list[str], size: int) -> Iterator[list[str]]:
    for start in range(0, len(folders), size):
        yield folders[start : start + size]


def ingest_new(
    spark: SparkSession,
    deployment: Deployment,
    raw: str | None = None,
    glob: str = RAW_GLOB,
    location_mode: str = "string",
    gather_days: bool = False,
    newest: int | None = None,
    folders_at_once: int = FOLDERS_AT_ONCE,
    files_per_load: int = FILES_PER_LOAD,
    report: Callable[[LoadMetrics], object] | None = None,
    supersede: bool = False,
) -> int:
    """Load every file in the landing folders that no load has taken; how many loads that took.

    ``glob`` names the landing folders below ``raw``; ``newest`` looks at so many of them only, the
    last ones by name, where late files in older ones are not expected. A run that dies takes the files of
    its unfinished load again next time. A deployment is fed by one ledger or one stream: others are
    refused, or replaced with ``supersede``. There must be one run at a time.
    """
    note = _settled(spark, deployment, supersede)
    root = deployment.ledger(note.ledger)
    folders = sorted(glob_folders(spark, f"{(raw or deployment.raw).rstrip('/')}/{glob}"))
    loads = 0
    for chunk in _chunks(folders[-newest:] if newest else folders, folders_at_once):
        while True:
            found = new_files(spark, root, chunk).orderBy("folder", "name")
            chosen = found.limit(files_per_load).collect()
            if not chosen:
                break
            load = f"{note.ledger}-{uuid.uuid4().hex}"
            taken = sorted({row["folder"] for row in chosen})
            note = _Note(note.ledger, next_number(spark, deployment), load, taken)
            _write_note(spark, deployment, note)
            rows = [(row["name"], row["folder"], load) for row in chosen]
            ledger = spark.createDataFrame(rows, _ROWS).coalesce(1)
            ledger.write.mode("append").partitionBy("folder", "load").parquet(root)
            documents = parse_documents(spark.read.text([row["path"] for row in chosen]))
            silver = to_silver(documents, location_mode, keep=[CORRUPT])
            metrics = write_load(
                silver, deployment, load, gather_days, note.ledger, count=report is not None
            )
            loads += 1
            if report:
                report(metrics)
            if len(chosen) < files_per_load:
                break
    return loads
