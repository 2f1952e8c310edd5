"""Raw zone: JSON files with one or several weather documents per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.functions.parsing import parse_json
from skyledger.sources.schema import CORRUPT, DOCUMENT_SCHEMA, TEXT_LINE

RAW_GLOB = "*/*/*"


def _read(reader, path: str, glob: str, recursive: bool, options) -> DataFrame:
    lines = reader.option("recursiveFileLookup", str(recursive).lower()).options(**options)
    return parse_documents(
        lines.text(path if recursive or not glob else f"{path.rstrip('/')}/{glob}")
    )


def read_raw(
    spark: SparkSession,
    path: str,
    glob: str = RAW_GLOB,
    recursive: bool = False,
    **options: str,
) -> DataFrame:
    """Documents below ``path``, numbers as text; a piece of a line that is not exactly one JSON
    object keeps its text in ``_corrupt_record``.

    Objects that were written without a line break between them are taken apart. The schema is
    explicit: there is no inference pass, and a field that no file has is NULL. ``glob`` reads
    files at depth three and four; ``recursive`` reads any depth instead.
    """
    return _read(spark.read, path, glob, recursive, options)


def stream_raw(
    spark: SparkSession,
    path: str,
    glob: str = RAW_GLOB,
    recursive: bool = False,
    **options: str,
) -> DataFrame:
    """As ``read_raw``, as a stream over new files.

    The file source forgets files older than ``maxFileAge`` before the newest one and would skip
    one that arrives with such an old time stamp. The default here keeps every file.
    """
    return _read(spark.readStream, path, glob, recursive, {"maxFileAge": "36500d", **options})


def parse_documents(
    lines: DataFrame,
    column: str = TEXT_LINE,
    keep: Sequence[str] = (),
    taken_apart: bool = False,
) -> DataFrame:
    """Documents out of a text column, in the shape of ``read_raw``."""
    return parse_json(lines, column, DOCUMENT_SCHEMA, CORRUPT, keep, taken_apart)


def well_formed(documents: DataFrame) -> DataFrame:
    return documents.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine(documents: DataFrame) -> DataFrame:
    """The pieces that could not be read: text in ``_corrupt_record``, other fields as far as read."""
    return documents.where(F.col(CORRUPT).isNotNull())


def to_lines(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Documents as JSON text; NULL fields are left out of the text."""
    document = F.struct(*DOCUMENT_SCHEMA.names)
    return documents.select(*keep, F.to_json(document).alias(TEXT_LINE))
