"""The SQL that checks each query, over the ``events`` view alone.

The sample documents are defined by the same SQL expressions on both sides; everything after that is
written here independently of the Spark code.
"""

from __future__ import annotations

from skyledger.sources.sample_documents import LATITUDE, LONGITUDE, NAME, VALUES
from skyledger.sources.schema import MEASUREMENTS, snake_case

_DOCS = f"""
docs as (
  select event_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as datetime_utc,
         cast(ts - interval 3 hour as date) as datetime_brasil,
         {NAME} as location_name,
         {LATITUDE} as latitude,
         {LONGITUDE} as longitude,
         {", ".join(f"{VALUES[m]} as {snake_case(m)}" for m in MEASUREMENTS)}
  from events
)"""

_SILVER_COLUMNS = ", ".join(
    ["location_name", "latitude", "longitude", "datetime_utc", "datetime_brasil"]
    + [snake_case(m) for m in MEASUREMENTS]
)


def _text(column: str) -> str:
    return f"cast({column} as varchar)"


def _mean(column: str) -> str:
    # Exact half-up to two decimals over whole units of 0.0001.
    units = f"sum(cast(round({column} * 10000) as hugeint))"
    n = f"count({column})"
    return (
        f"case when {n} > 0 then cast(sign({units}) * ((2 * abs({units}) + 100 * {n}) // (200 * {n}))"
        f" as double) / cast(100 as double) end"
    )


def _millionths(column: str) -> str:
    # Exact half-up to two decimals of the mean of whole millionths.
    total, n = f"sum(cast({column} as hugeint))", "count(*)"
    return (
        f"cast(sign({total}) * ((2 * abs({total}) + 10000 * {n}) // (20000 * {n})) as double)"
        " / cast(100 as double)"
    )


def _extreme(function: str, column: str) -> str:
    return f"round({function}({column}), 2)"


def _positive(column: str) -> str:
    return f"count(case when {column} > 0 then 1 end)"


_DAILY = {
    "avg_temperature_daily": {
        "avg_temperature": _mean("temperature"),
        "avg_apparent_temperature": _mean("temperature_apparent"),
    },
    "precipitation_daily": {"avg_precipitation_probability": _mean("precipitation_probability")},
    "humidity_wind_daily": {
        "avg_humidity": _mean("humidity"),
        "avg_wind_speed": _mean("wind_speed"),
    },
    "cloud_cover_daily": {
        "avg_cloud_cover": _mean("cloud_cover"),
        "max_cloud_base": _extreme("max", "cloud_base"),
        "min_cloud_ceiling": _extreme("min", "cloud_ceiling"),
    },
    "max_min_temperature_daily": {
        "max_temperature": _extreme("max", "temperature"),
        "min_temperature": _extreme("min", "temperature"),
    },
    "snow_rain_condition_daily": {
        "rain_events": _positive("rain_intensity"),
        "snow_events": _positive("snow_intensity"),
    },
}
_PLACE = "location_name, latitude, longitude"


def _daily(measures: dict[str, str]) -> str:
    outputs = ", ".join(f"{sql} as {name}" for name, sql in measures.items())
    return (
        f"select {_PLACE}, datetime_brasil as date, {outputs} from docs"
        f" group by {_PLACE}, datetime_brasil"
    )


def _with_docs(select: str, *more: str) -> str:
    return f"with {', '.join([_DOCS, *more])}\n{select}"


_WIDE = _with_docs(_daily({k: v for table in _DAILY.values() for k, v in table.items()}))
_CODES = (
    f"select {_PLACE}, weather_code, count(*) as weather_code_count from docs"
    f" group by {_PLACE}, weather_code"
)



def _positions(select: str, first: str, *more: str) -> str:
    keys = ", ".join(f"{c} nulls first" for c in ("location_name", "latitude", "longitude", *more))
    return f"select *, row_number() over (order by {first}, {keys}) - 1 as position from ({select})"


_LONG = [
    f"select '{table}' as table_name, {_PLACE}, datetime_brasil as date,"
    f" cast(null as integer) as weather_code, '{measure}' as measure,"
    f" cast({sql} as double) as value from docs group by {_PLACE}, datetime_brasil"
    for table, measures in _DAILY.items()
    for measure, sql in measures.items()
] + [
    f"select 'weather_condition_summary' as table_name, {_PLACE}, cast(null as date) as date,"
    f" weather_code, 'weather_code_count' as measure, cast(count(*) as double) as value"
    f" from docs group by {_PLACE}, weather_code"
]

# Alerts -------------------------------------------------------------------------------------

_LABELLED = """
labelled as (
  select *,
         trim(string_split(location_name, ',')[1]) as city,
         case when len(string_split(location_name, ',')) >= 3
              then trim(string_split(location_name, ',')[-3]) end as state,
         len(string_split(location_name, ',')) < 3 as location_incomplete
  from docs
)"""


def _defaulted(column: str, default: str) -> str:
    return (
        f"coalesce({column}, {default}) as {column},"
        f" coalesce(cast({column} as varchar), '{default}') as {column}_text"
    )


_ALERT_DEFAULTS = {
    "precipitation_probability": "0",
    "wind_speed": "0",
    "wind_gust": "0",
    "rain_intensity": "0",
    "snow_intensity": "0",
    "freezing_rain_intensity": "0",
    "temperature": "0",
    "uv_index": "0",
    "visibility": "100",
    "pressure_sea_level": "1013",
}
_INPUTS = f"""
inputs as (
  select event_id, datetime_utc, location_name, city, state, location_incomplete,
         case when state is null then city else city || ', ' || state end as label,
         {", ".join(_defaulted(c, d) for c, d in _ALERT_DEFAULTS.items())}
  from labelled
)"""

_FIRED = [
    ("rain_probability", "precipitation_probability", ">= 70", "Rain is likely in ", "%"),
    ("wind_speed", "wind_speed", ">= 15", "Strong wind in ", " km/h"),
    ("wind_gust", "wind_gust", ">= 20", "Strong gusts in ", " km/h"),
    ("heavy_rain", "rain_intensity", ">= 10", "Heavy rain in ", " mm/h"),
    ("snow", "snow_intensity", ">= 5", "Heavy snow in ", " mm/h"),
    ("freezing_rain", "freezing_rain_intensity", "> 0", "Freezing rain in ", " mm/h"),
    ("extreme_heat", "temperature", ">= 40", "Extreme heat in ", "°C"),
    ("extreme_cold", "temperature", "<= -5", "Extreme cold in ", "°C"),
    ("uv_index", "uv_index", ">= 7", "High UV index in ", ""),
    ("low_visibility", "visibility", "<= 1", "Low visibility in ", " km"),
    ("low_pressure", "pressure_sea_level", "<= 1000", "Low air pressure in ", " hPa"),
]


def _line(column: str, start: str, unit: str) -> str:
    return f"'{start}' || label || ': ' || {column}_text || '{unit}'"


def _rules(fired: list[tuple[str, str, str, str, str]]) -> str:
    return "rules as (" + " union all ".join(
        f"select event_id, {order} as rule_order, '{rule}' as rule_id, {column} as value,"
        f" {_line(column, start, unit)} as message from inputs where {column} {condition}"
        for order, (rule, column, condition, start, unit) in enumerate(fired, start=1)
    ) + ")"


_RULES = _rules(_FIRED)
_CUSTOM = {
    "rain_probability": ">= 55",
    "wind_speed": ">= 12.5",
    "extreme_cold": "<= 0.5",
    "low_visibility": "<= 2.25",
}
_CUSTOM_RULES = _rules([(r, c, _CUSTOM.get(r, t), s, u) for r, c, t, s, u in _FIRED])
_DIGESTS = """
digests as (
  select event_id, 'Severe weather alert' as subject,
         'Severe weather alert:' || chr(10) || chr(10)
           || string_agg(message, chr(10) order by rule_order) as message
  from rules group by event_id
)"""
_ALERTS = (_LABELLED, _INPUTS, _RULES, _DIGESTS)

# Envelopes: no records for every 40th event; a second, unreadable record for every 41st; a first,
# unreadable one for every 43rd.
_RECORDS = """
records as (
  select *, 0 as record_index,
         case when event_id % 41 <> 0 and event_id % 43 = 0 then 'base64' end as decode_error
  from docs where event_id % 40 <> 0
  union all
  select *, 1 as record_index, case when event_id % 41 = 0 then 'json' end as decode_error
  from docs where event_id % 40 <> 0 and (event_id % 41 = 0 or event_id % 43 = 0)
)"""

# Odd envelopes: broken, of another shape, with two documents in one payload, two on one line.
_ODD = """
odd as (
  select *, event_id % 7 as kind, copy
  from docs cross join (values (0), (1)) as copies(copy)
  where copy = 0 or event_id % 7 in (2, 3)
)"""

ORACLE_SQL: dict[str, str] = {
    "raw_events": _with_docs(
        "select datetime_utc as time, location_name as name,"
        f" {_text('latitude')} as lat, {_text('longitude')} as lon, "
        + ", ".join(f"{_text(snake_case(m))} as {snake_case(m)}" for m in MEASUREMENTS)
        + " from docs"
    ),
    "envelope_decode": _with_docs(
        "select event_id, record_index, decode_error,"
        " case when decode_error is null then datetime_utc end as time,"
        " case when decode_error is null then location_name end as name,"
        f" case when decode_error is null then {_text('wind_gust')} end as wind_gust,"
        f" case when decode_error is null then {_text('temperature')} end as temperature"
        " from records",
        _RECORDS,
    ),
    "envelope_status": (
        "select event_id, case when event_id % 40 = 0 then 400 else 200 end as status,"
        " case when event_id % 40 = 0 then 'no_records' end as reason,"
        " case when event_id % 40 = 0 then 0"
        " when event_id % 41 = 0 or event_id % 43 = 0 then 2 else 1 end as records from events"
    ),
    "silver_events": _with_docs(f"select {_SILVER_COLUMNS} from docs"),
    "silver_location_double": _with_docs(
        "select try_cast(location_name as double) as location_name, latitude, longitude,"
        f" datetime_brasil as date, {_mean('temperature')} as avg_temperature,"
        f" {_mean('temperature_apparent')} as avg_apparent_temperature"
        " from docs group by try_cast(location_name as double), latitude, longitude, datetime_brasil"
    ),
    "silver_local_day": _with_docs("select event_id, datetime_utc, datetime_brasil from docs"),
    **{name: _with_docs(_daily(measures)) for name, measures in _DAILY.items()},
    "weather_condition_summary": _with_docs(_CODES),
    **{
        f"{name}_ordered": _with_docs(_positions(_daily(measures), "date desc nulls first"))
        for name, measures in _DAILY.items()
    },
    "weather_condition_summary_ordered": _with_docs(
        _positions(_CODES, "weather_code_count desc", "weather_code")
    ),
    "silver_ingestion": (
        "select event_id, date '2024-02-03' as ingestion_at,"
        " epoch(timestamp '2024-02-03 12:05:06')::bigint as ingestion_seconds from events"
    ),
    "raw_joined_objects": _with_docs(
        "select case when bad then null else datetime_utc end as time,"
        " case when bad then null else location_name end as name,"
        f" case when bad then null else {_text('wind_gust')} end as wind_gust,"
        " case when bad then '} }junk' end as corrupt_end,"
        " case when bad then datetime_utc end as corrupt_time"
        " from (select *, event_id % 30 = 29 as bad from docs)"
    ),
    "silver_after_failed_load": _with_docs(
        f"select {_PLACE}, datetime_brasil as date, count(*) as rows,"
        f" {_positive('rain_intensity')} as rain_events, {_positive('snow_intensity')} as snow_events"
        f" from docs group by {_PLACE}, datetime_brasil"
    ),
    "envelope_oddities": _with_docs(
        "select event_id, case when kind > 1 then 0 end as record_index,"
        " case when kind > 1 then case when kind = 2 then copy else 0 end end as document_index,"
        " case kind when 0 then 'envelope_json' when 1 then 'envelope_shape' end as decode_error,"
        " case when kind > 1 then datetime_utc end as time from odd",
        _ODD,
    ),
    "envelope_reasons": _with_docs(
        "select event_id, case when kind < 2 then 400 else 200 end as status,"
        " case kind when 0 then 'envelope_json' when 1 then 'envelope_shape' end as reason,"
        " case when kind < 2 then 0 else 1 end as records"
        " from odd where not (kind = 2 and copy = 1)",
        _ODD,
    ),
    "alerts_quarantine": _with_docs(
        "select case kind when 0 then 'envelope_json' else 'envelope_shape' end as decode_error,"
        " case kind when 0 then '{\"Records\":[{\"kinesis\":{\"data\":\"eyJkYXRh' else '5' end"
        " as bad_payload from odd where kind < 2",
        _ODD,
    ),
    "alert_rules_custom": _with_docs(
        "select event_id, rule_order, rule_id, cast(value as double) as value, message from rules",
        *_ALERTS[:2],
        _CUSTOM_RULES,
    ),
    "gold_fused_daily": _WIDE,
    "gold_from_rollup": _WIDE,
    "alert_inputs": _with_docs(
        "select event_id, label, "
        + ", ".join(f"cast({c} as double) as {c}" for c in _ALERT_DEFAULTS)
        + ", "
        + ", ".join(f"{c}_text" for c in _ALERT_DEFAULTS)
        + " from inputs",
        _LABELLED,
        _INPUTS,
    ),
    "location_label": _with_docs(
        "select event_id, location_name, city, state, label, location_incomplete from inputs",
        _LABELLED,
        _INPUTS,
    ),
    "alert_rules": _with_docs(
        "select event_id, rule_order, rule_id, cast(value as double) as value, message from rules",
        *_ALERTS[:3],
    ),
    "alert_digests": _with_docs(
        "select event_id, label, subject, message from digests join inputs using (event_id)",
        *_ALERTS,
    ),
    "alert_summary": _with_docs(
        "select count(*) as events, count(d.event_id) as alerting,"
        " count(*) - count(d.event_id) as silent,"
        " count(case when location_incomplete then 1 end) as incomplete_locations"
        " from inputs left join digests d using (event_id)",
        *_ALERTS,
    ),
    "silver_append_twice": _with_docs(
        f"select {_PLACE}, datetime_brasil as date, 2 * count(*) as rows from docs"
        f" group by {_PLACE}, datetime_brasil"
    ),
    "gold_refresh": _with_docs(" union all ".join(_LONG)),
    "gold_catalog": _with_docs(
        " union all ".join(
            _LONG
            + [
                f"select 'refresh {part}' as table_name, null as location_name, null as latitude,"
                " null as longitude, null as date, null as weather_code,"
                " 'weather_code_count' as measure, cast(count(*) as double) as value"
                f" from docs where event_id % 3 <= {part}"
                for part in range(3)
            ]
        )
    ),
    "ingest_metrics": (
        "select count(*) as rows_read,"
        " count(case when event_id % 101 = 0 then 1 end) as rows_corrupt,"
        " count(case when event_id % 101 <> 0 then 1 end) as rows_written from events"
    ),
    "silver_ledger": _with_docs(f"select {_SILVER_COLUMNS} from docs"),
    "silver_compacted": _with_docs(f"select {_SILVER_COLUMNS} from docs"),
    "raw_stray_brackets": _with_docs(
        "select event_id, case when event_id % 5 = 0 then datetime_utc end as time,"
        " case when event_id % 5 = 0 then location_name end as name,"
        " case event_id % 5 when 1 then ' [ {' when 2 then ':[{}' when 3 then '}} }'"
        " when 4 then '}}]}' end as corrupt_end from docs"
    ),
    "silver_stream": _with_docs(f"select {_SILVER_COLUMNS} from docs"),
    "alerts_stream": _with_docs(
        "select i.datetime_utc, i.location_name, i.label, i.location_incomplete,"
        " d.subject, d.message"
        " from records r join inputs i using (event_id) join digests d using (event_id)"
        " where r.decode_error is null",
        *_ALERTS,
        _RECORDS,
    ),
    "alerts_outbox": _with_docs(
        "select distinct i.datetime_utc, i.location_name, i.label, d.subject, d.message"
        " from records r join inputs i using (event_id) join digests d using (event_id)"
        " where r.decode_error is null",
        *_ALERTS,
        _RECORDS,
    ),
    "means_of_six_decimals": _with_docs(
        f"select {_PLACE}, datetime_brasil as date,"
        f" {_millionths('(event_id * 7919) % 60000000')} as avg_temperature,"
        f" {_millionths('-((event_id * 104729) % 999983)')} as avg_humidity"
        f" from docs group by {_PLACE}, datetime_brasil"
    ),
    "raw_to_gold": _with_docs(" union all ".join(_LONG)),
}
