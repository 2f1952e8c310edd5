from __future__ import annotations

import json
from pathlib import Path

from skyledger.sources.raw import parse_documents

PLACE = {"lat": -8.05, "lon": -34.9, "name": "Recife, Micro, Pernambuco, Nordeste, Brasil"}


def document(time="2025-04-10T12:00:00Z", location=None, **values) -> dict:
    return {"data": {"time": time, "values": values}, "location": location or PLACE}


def lines_frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def documents_frame(spark, *documents):
    return parse_documents(lines_frame(spark, [json.dumps(d) for d in documents]))


def write_lines(folder: Path, name: str, *lines: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")


def plan_text(frame, mode="formatted") -> str:
    execution = frame._jdf.queryExecution()
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(execution, mode)
