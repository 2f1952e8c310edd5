from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from skyledger.functions.casts import local_day
from skyledger.functions.parsing import parse_json
from skyledger.operators.silver import to_silver
from skyledger.sources.raw import quarantine, read_raw, well_formed
from skyledger.sources.schema import SILVER_COLUMNS, silver_schema

from helpers import PLACE, document, documents_frame, lines_frame, write_lines


def silver_row(spark, doc, **options):
    return to_silver(well_formed(documents_frame(spark, doc)), **options).first()


def test_columns_types_and_order(spark):
    silver = to_silver(documents_frame(spark, document()))
    assert len(SILVER_COLUMNS) == 28
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in silver_schema()
    ]
    assert silver.columns[:6] == [
        "location_name", "latitude", "longitude", "datetime_utc", "datetime_brasil", "cloud_base",
    ]
    assert silver.columns[-3:] == ["wind_speed", "ingestion_at", "ingestion_at_timestamp"]


def test_values_are_cast_leniently(spark):
    row = silver_row(
        spark,
        document(
            temperature="25.5", humidity="damp", weatherCode=1000.0, uvHealthConcern=3, windSpeed=7
        ),
    )
    assert row.temperature == 25.5
    assert row.humidity is None
    assert row.weather_code == 1000
    assert row.uv_health_concern == 3
    assert row.wind_speed == 7.0
    assert row.cloud_base is None


def test_ingestion_columns(spark):
    moment = datetime(2025, 4, 11, 9, 30)
    row = silver_row(spark, document(), ingested_at=moment)
    assert row.ingestion_at == date(2025, 4, 11)
    assert row.ingestion_at_timestamp == moment
    row = silver_row(spark, document())
    assert row.ingestion_at is not None and row.ingestion_at_timestamp is not None


def test_location_name_modes(spark):
    assert silver_row(spark, document()).location_name == PLACE["name"]
    assert silver_row(spark, document(), location_mode="double").location_name is None
    numeric = document(location={**PLACE, "name": "12.5"})
    assert silver_row(spark, numeric, location_mode="double").location_name == 12.5
    with pytest.raises(ValueError):
        silver_row(spark, document(), location_mode="int")


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo", "America/Los_Angeles"])
def test_local_day_does_not_depend_on_the_session_zone(spark, zone):
    cases = [
        ("2025-04-10T01:30:00Z", date(2025, 4, 9)),
        ("2025-04-10T03:00:00Z", date(2025, 4, 10)),
        ("2025-04-10T02:59:59Z", date(2025, 4, 9)),
        ("2025-04-10T04:30:00Z", date(2025, 4, 10)),
        ("2025-04-09T23:30:00-03:00", date(2025, 4, 9)),
        ("2018-12-10T02:30:00Z", date(2018, 12, 10)),
        ("1969-12-31T02:00:00Z", date(1969, 12, 30)),
        ("1900-01-01T12:00:00Z", date(1900, 1, 1)),
        ("not a time", None),
        (None, None),
    ]
    frame = spark.createDataFrame([(text,) for text, _ in cases], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        days = [row.d for row in frame.select(local_day(F.col("t")).alias("d")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert days == [day for _, day in cases]


def test_missing_fields_are_null(spark, tmp_path):
    write_lines(tmp_path / "a/b", "f.json", '{"location": {"lat": 1}}', "{}")
    rows = to_silver(well_formed(read_raw(spark, str(tmp_path)))).collect()
    assert sorted((r.latitude for r in rows), key=str) == [1.0, None]
    assert all(r.temperature is None and r.datetime_brasil is None for r in rows)


def test_glob_depth(spark, tmp_path):
    for depth, folder in [(3, "a/b"), (4, "a/b/c")]:
        write_lines(tmp_path / folder, "f.json", json.dumps(document(temperature=depth)))
    read = read_raw(spark, str(tmp_path))
    assert {r.t for r in read.select(F.col("data.values.temperature").alias("t")).collect()} == {"3", "4"}
    write_lines(tmp_path / "a/b/c/d", "f.json", json.dumps(document(temperature=5)))
    assert read_raw(spark, str(tmp_path)).count() == 2
    assert read_raw(spark, str(tmp_path), recursive=True).count() == 3
    with pytest.raises(AnalysisException):
        read_raw(spark, str(tmp_path / "a/b/c/d")).count()


def test_corrupt_pieces_go_to_quarantine(spark, tmp_path):
    good = json.dumps(document(temperature=1))
    broken = good[:40]
    two = json.dumps(document(temperature=2)) + json.dumps(document(temperature=3))
    followed = json.dumps(document(temperature=4)) + " junk"
    write_lines(tmp_path / "a/b", "f.json", good, broken, "", two, followed)
    documents = read_raw(spark, str(tmp_path))
    kept = to_silver(well_formed(documents)).collect()
    assert sorted(r.temperature for r in kept) == [1.0, 2.0, 3.0]
    assert sorted(r._corrupt_record for r in quarantine(documents).collect()) == sorted(
        [broken, followed]
    )


JOINED = [
    ('{"a":1}{"a":2}  {"a":"}{"}', ["1", "2", "}{"], []),
    ('{"a":"x\\"}{"}{"a":3}', ['x"}{', "3"], []),
    ('{"a":1}{"a":2} junk', ["1"], ['{"a":2} junk']),
    ('{"a":1}} junk', [], ['{"a":1}} junk']),
    ('{"a":1}]} junk', [], ['{"a":1}]} junk']),
    ('{"a":1}]} [ {', [], ['{"a":1}]} [ {']),
    ('{"a":1}]}', [], ['{"a":1}]}']),
    ('{"a":1}],"b":[{}', [], ['{"a":1}],"b":[{}']),
    ('{"a":1}],"json_objects":[{}', [], ['{"a":1}],"json_objects":[{}']),
    ('{"a":1}]}[', [], ['{"a":1}]}[']),
    ('{"a":1},', [], ['{"a":1},']),
    (',{"a":1}', [], [',{"a":1}']),
    ('{"a":1},{"_piece_seal":1}', [], ['{"a":1},{"_piece_seal":1}']),
    ('{"a":"]}] [ {"}', ["]}] [ {"], []),
    ('{"a":1},{"a":2}', [], ['{"a":1},{"a":2}']),
    ('{"a":"unfinished}{"a":2}', [], ['{"a":"unfinished}{"a":2}']),
    ('{"a":[1,{"c":2}]}', ['[1,{"c":2}]'], []),
    ("null", [], ["null"]),
    ('[{"a":1}]', [], ['[{"a":1}]']),
    ("  ", [], []),
    ('{"a":1}' * 20_000, ["1"] * 20_000, []),
]


@pytest.mark.parametrize("text, values, bad", JOINED, ids=range(len(JOINED)))
def test_joined_objects(spark, text, values, bad):
    schema = T.StructType().add("a", T.StringType())
    rows = parse_json(lines_frame(spark, [text]), "value", schema, "bad").collect()
    assert [r.a for r in rows if r.bad is None] == values
    assert [r.bad for r in rows if r.bad is not None] == bad


def test_a_measurement_of_another_kind_costs_only_itself(spark, tmp_path):
    odd = {**document(temperature=1), "extra": [1, 2]}
    odd["data"]["values"]["humidity"] = {"percent": 5}
    write_lines(tmp_path / "a/b", "f.json", json.dumps(odd))
    row = to_silver(well_formed(read_raw(spark, str(tmp_path)))).first()
    assert (row.temperature, row.humidity) == (1.0, None)


def test_nan_and_infinity_stay_what_they_are(spark, tmp_path):
    line = json.dumps(document(temperature=float("nan"), humidity=float("inf"), windGust=-1))
    write_lines(tmp_path / "a/b", "f.json", line)
    row = to_silver(well_formed(read_raw(spark, str(tmp_path)))).first()
    assert row.temperature != row.temperature
    assert (row.humidity, row.wind_gust) == (float("inf"), -1.0)


def test_good_and_bad_lines_can_be_counted(spark, tmp_path):
    write_lines(tmp_path / "a/b", "f.json", json.dumps(document()), "nonsense", "{}")
    documents = read_raw(spark, str(tmp_path))
    assert (well_formed(documents).count(), quarantine(documents).count()) == (2, 1)
    assert to_silver(well_formed(documents)).count() == 2
