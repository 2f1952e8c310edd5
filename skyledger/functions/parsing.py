"""JSON text to columns: joined objects taken apart, each object parsed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: The end of an object that another one follows. Braces inside strings do not count; a text with an
#: unfinished string is not taken apart.
_JOINT = r'\G((?:[^"}]++|"(?:[^"\\]++|\\.)*+"|\}(?!\s*\{))*+\})\s*(?=\{)'
_MAY_BE_JOINED = r"\}\s*\{"
_BREAK = "\n"
_NOT_BLANK = r"[^ \t\r]"
#: Field of the objects that stand before and behind a piece when it is parsed.
_SEAL = "_piece_seal"


def pieces_of(text: Column) -> Column:
    """The objects of a text without line breaks that holds one or several of them, in order.

    A text that cannot be taken apart is one piece; a blank text has none.
    """
    parts = F.when(
        text.rlike(_MAY_BE_JOINED),
        F.split(F.regexp_replace(text, _JOINT, f"$1{_BREAK}"), _BREAK, -1),
    ).otherwise(F.array(text))
    return F.filter(parts, is_not_blank)


def is_not_blank(text: Column) -> Column:
    # most texts are objects, which takes no look at the rest
    return text.startswith("{") | text.rlike(_NOT_BLANK)


def one_line(text: Column) -> Column:
    """A JSON text without line breaks; inside strings JSON has none."""
    # looking for them costs a tenth of translating every character
    broken = text.contains("\n") | text.contains("\r")
    return F.when(broken, F.translate(text, "\n\r", "  ")).otherwise(text)


def parse_json(
    lines: DataFrame,
    column: str,
    schema: T.StructType,
    corrupt: str,
    keep: Sequence[str] = (),
    taken_apart: bool = False,
) -> DataFrame:
    """The ``keep`` columns, then the fields of ``schema`` out of each object in ``column``, then
    ``corrupt``: the piece itself where it is not exactly one object.

    A piece is parsed as the middle one of three list elements. The outer two hold its hash, so they
    are told from anything in the piece: if all three come out of one list, nothing in the piece
    closed a bracket that it had not opened, however many it opens or closes. That takes no look at
    the text beside the parser's.

    With ``taken_apart`` the column holds pieces already; one that is NULL gives NULL fields.

    As a generator with one row rather than a projection: a later filter on a parsed field would be
    pushed below a projection together with the whole parser, which then runs twice on each row.
    """
    bad = "json_failure"
    element = T.StructType([*schema.fields, T.StructField(_SEAL, T.LongType())])
    inside = T.StructType().add("json_objects", T.ArrayType(element)).add(bad, T.StringType())
    piece, hashed = F.col("json_piece"), F.col("json_hash")
    seal = F.concat(F.lit(f'{{"{_SEAL}":'), hashed.cast("string"), F.lit("}"))
    wrapped = F.concat(
        F.lit('{"json_objects":['), seal, F.lit(","), piece, F.lit(","), seal, F.lit("]}")
    )
    parsed = F.from_json(wrapped, inside, {"columnNameOfCorruptRecord": bad})
    pieces = F.col(column) if taken_apart else F.explode(pieces_of(F.col(column)))
    single = lines.select(*keep, pieces.alias("json_piece"))
    sealed = single.withColumn("json_hash", F.xxhash64("json_piece"))
    opened = sealed.select(*keep, "json_piece", "json_hash", F.inline(F.array(parsed)))
    first, one, last = (F.try_element_at("json_objects", F.lit(i)) for i in (1, 2, 3))
    whole = (
        F.col(bad).isNull()
        & (F.size("json_objects") == 3)
        & (first.getField(_SEAL) == hashed)
        & (last.getField(_SEAL) == hashed)
        & one.isNotNull()
        & (piece.startswith("{") | piece.rlike(r"^\s*\{"))
    )
    fields = [one.getField(name).alias(name) for name in schema.names]
    return opened.select(
        *keep, *fields, F.when(~F.coalesce(whole, F.lit(False)), piece).alias(corrupt)
    )
