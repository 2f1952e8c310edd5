"""Gold tables under stable names in a catalog, for other sessions and applications.

A name is a view over the folder of the current slot. A refresh that makes the other slot current
replaces the two views that name a folder; the daily tables are projections of one of them and
switch with it. A view is looked up anew by every query, so no session holds on to a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.operators.gold import DAILY_TABLES, DAILY_WIDE, daily_columns
from skyledger.plans.storage import WEATHER_CODES, Deployment, has_data, qualified
from skyledger.sources.commits import if_there
from skyledger.sources.tables import current_gold, current_slot

CODES = "weather_condition_summary"
_DATABASES = "database string"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _over_folder(spark: SparkSession, database: str, name: str, folder: str, table: DataFrame) -> None:
    """A view with the columns of the table over the files of a folder, which may have none."""
    typed = [(_quoted(f.name), f.dataType.simpleString()) for f in table.schema]
    if has_data(spark, folder):
        columns = ", ".join(f"cast({c} as {t}) as {c}" for c, t in typed)
        query = f"select {columns} from parquet.{_quoted(qualified(spark, folder))}"
    else:
        columns = ", ".join(f"cast(null as {t}) as {c}" for c, t in typed)
        query = f"select {columns} where false"
    spark.sql(f"create or replace view {_quoted(database)}.{_quoted(name)} as {query}")


def _switch(spark: SparkSession, deployment: Deployment, database: str) -> None:
    slot = current_slot(spark, deployment)
    for name, folder in ((DAILY_WIDE, DAILY_WIDE), (CODES, WEATHER_CODES)):
        table = current_gold(spark, deployment, slot, name)
        _over_folder(spark, database, name, deployment.gold(slot, folder), table)


def _databases(spark: SparkSession, deployment: Deployment) -> list[str]:
    named = if_there(spark, lambda: spark.read.schema(_DATABASES).json(deployment.catalogs))
    return [] if named is None else sorted({row[0] for row in named.collect()})


def publish_catalog(spark: SparkSession, deployment: Deployment, database: str) -> None:
    """The seven gold tables and ``daily_wide`` as views of ``database``, which must exist.

    From now on every refresh of the deployment, in whatever application, switches them; that
    application needs the same catalog. A reader has until the end of the next refresh to finish a
    query; the next query sees the new tables. There must have been a refresh.
    """
    _switch(spark, deployment, database)
    for name in DAILY_TABLES:
        columns = ", ".join(map(_quoted, daily_columns(name)))
        spark.sql(
            f"create or replace view {_quoted(database)}.{_quoted(name)} as"
            f" select {columns} from {_quoted(database)}.{_quoted(DAILY_WIDE)}"
        )
    if database not in _databases(spark, deployment):
        row = spark.createDataFrame([(database,)], _DATABASES).coalesce(1)
        row.write.mode("append").json(deployment.catalogs)


def switch_catalogs(spark: SparkSession, deployment: Deployment) -> None:
    """Lets the views of all databases that have them name the current slot."""
    for database in _databases(spark, deployment):
        if spark.catalog.databaseExists(_quoted(database)):
            _switch(spark, deployment, database)


def withdraw_catalog(spark: SparkSession, deployment: Deployment, database: str) -> None:
    """Drops the views; refreshes leave the database alone from now on."""
    for name in (*DAILY_TABLES, DAILY_WIDE, CODES):
        spark.sql(f"drop view if exists {_quoted(database)}.{_quoted(name)}")
    left = [(d,) for d in _databases(spark, deployment) if d != database]
    rows = spark.createDataFrame(left, _DATABASES).coalesce(1)
    rows.write.mode("overwrite").json(deployment.catalogs)
