"""Runs over the ledger of raw files."""

from __future__ import annotations

import json
import os
from datetime import date
from pathlib import Path
from unittest.mock import patch

import pytest

from skyledger.plans import ledger, refresh
from skyledger.plans.ledger import ingest_new
from skyledger.plans.storage import Deployment
from skyledger.sinks import tables as sinks
from skyledger.sources.commits import committed_loads
from skyledger.sources.sample_documents import events_table, weather_documents
from skyledger.sources.tables import read_gold, read_quarantine, read_silver

from helpers import document, write_lines

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def deployment(tmp_path):
    return Deployment(str(tmp_path / "deployment"))


@pytest.fixture
def raw(tmp_path):
    return tmp_path / "deployment/raw"


def land(raw: Path, folder: str, name: str, *temperatures):
    write_lines(raw / folder, name, *(json.dumps(document(temperature=t)) for t in temperatures))
    return raw / folder / name


def temperatures(spark, deployment):
    return sorted(r.temperature for r in read_silver(spark, deployment).collect())


def test_late_files_with_old_time_stamps_are_read_once(spark, deployment, raw):
    assert ingest_new(spark, deployment) == 0  # nothing has landed
    land(raw, "2025/04/10", "a.json", 1)
    land(raw, "2025/04/11", "b.json", 2, 3)
    assert ingest_new(spark, deployment) == 1
    late = land(raw, "2025/04/10", "late.json", 4)
    os.utime(late, (0, 0))
    for _ in range(2):
        ingest_new(spark, deployment)
    assert temperatures(spark, deployment) == [1, 2, 3, 4]
    land(raw, "2025/04/10", "b.json", 5)  # a name that is known in another folder
    land(raw, "2025/04", "c.json", 6)  # a folder higher up
    land(raw, "2025/04/10/12", "d.json", 7)  # and one lower down, which the pattern does not name
    assert ingest_new(spark, deployment) == 1
    assert temperatures(spark, deployment) == [1, 2, 3, 4, 5, 6]
    assert ingest_new(spark, deployment) == 0


def test_only_the_newest_folders(spark, deployment, raw):
    for day in range(1, 6):
        land(raw, f"2025/04/0{day}", "a.json", day)
    assert ingest_new(spark, deployment, newest=2) == 1
    assert temperatures(spark, deployment) == [4, 5]
    assert ingest_new(spark, deployment, folders_at_once=2) == 2  # days 1, 2 and 3
    assert temperatures(spark, deployment) == [1, 2, 3, 4, 5]


def test_a_run_that_died_is_made_up_for(spark, deployment, raw):
    land(raw, "2025/04/10", "a.json", 1)
    ingest_new(spark, deployment)
    land(raw, "2025/04/10", "b.json", 2)
    for lost in ("rollup", "_mark"):  # after the ledger, before the mark
        with patch.object(sinks, lost, side_effect=RuntimeError("lost")):
            with pytest.raises(RuntimeError):
                ingest_new(spark, deployment)
        assert temperatures(spark, deployment) == [1]
    with patch.object(ledger, "write_load", side_effect=RuntimeError("lost")):
        with pytest.raises(RuntimeError):
            ingest_new(spark, deployment)
    refresh.run(spark, deployment, mode="ledger")
    assert temperatures(spark, deployment) == [1, 2]
    assert read_gold(spark, deployment, "avg_temperature_daily").first().avg_temperature == 1.5
    # a run that died after its mark is not repeated
    land(raw, "2025/04/10", "c.json", 6)
    with pytest.raises(RuntimeError):
        ingest_new(spark, deployment, report=_lost)
    assert ingest_new(spark, deployment) == 0
    refresh.run(spark, deployment, mode="ledger")
    assert read_gold(spark, deployment, "avg_temperature_daily").first().avg_temperature == 3.0


def _lost(metrics):
    raise RuntimeError("lost")


def test_counts_and_quarantine(spark, deployment, raw):
    write_lines(raw / "2025/04/10", "a.json", json.dumps(document(temperature=1)), "nonsense")
    seen = []
    ingest_new(spark, deployment, report=seen.append)
    assert seen == [sinks.LoadMetrics(2, 1, 1)]
    assert [r[0] for r in read_quarantine(spark, deployment).collect()] == ["nonsense"]


def test_many_files_in_bounded_pieces(spark, deployment, raw):
    """What comes to the driver at a time is the listing of a few folders and the paths of a load."""
    for day in range(1, 13):
        for number in range(250):
            land(raw, f"2025/04/{day:02d}", f"f{number}.json", day)
    listings, loads = [], []
    listed, write = ledger._listed, sinks.write_load

    def watched(spark, folders):
        listings.append(len(folders))
        return listed(spark, folders)

    def written(silver, *args, **options):
        loads.append(len(silver.inputFiles()))
        return write(silver, *args, **options)

    with patch.object(ledger, "_listed", watched), patch.object(ledger, "write_load", written):
        n = ingest_new(spark, deployment, folders_at_once=4, files_per_load=600)
    assert max(listings) == 4 and max(loads) == 600
    assert sum(loads) == 3000 and n == len(loads) == 6
    assert read_silver(spark, deployment).count() == 3000
    # a run over the newest folder reads its part of the ledger and no other
    land(raw, "2025/04/13", "new.json", 13)
    read = []
    known = ledger._known
    with patch.object(ledger, "_known", lambda s, root, f: read.append(f) or known(s, root, f)):
        assert ingest_new(spark, deployment, newest=1) == 1
    assert {folder.rsplit("/", 1)[-1] for folders in read for folder in folders} == {"13"}
    assert ingest_new(spark, deployment) == 0


def test_a_stream_and_a_ledger_do_not_load_the_same_files(spark, deployment):
    documents = weather_documents(events_table(spark, DATA))
    n = documents.count()
    sinks.land_documents(documents, deployment.raw, date(2025, 4, 10))
    refresh.run(spark, deployment)
    with pytest.raises(ValueError, match="pass supersede"):
        refresh.run(spark, deployment, mode="ledger")
    refresh.run(spark, deployment, mode="ledger", supersede=True)
    assert read_silver(spark, deployment).count() == n
    refresh.run(spark, deployment, mode="ledger")
    assert (read_silver(spark, deployment).count(), committed_loads(spark, deployment).count()) == (n, 1)
    codes = read_gold(spark, deployment, "weather_condition_summary")
    assert codes.groupBy().sum("weather_code_count").first()[0] == n
