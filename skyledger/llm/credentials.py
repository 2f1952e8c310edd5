"""Secret scans with linking of the parts of a credential, in DataFrame functions only.

Strong spans are reported by themselves. A weak candidate (an identifier, a secret value or an
endpoint that would be noise alone) is reported only where the parts that complete it stand near:
an identifier and a secret need each other, an endpoint needs both. A secret longer than the scope
keeps the two others apart by itself, so an endpoint near it needs no identifier of its own. Every weak
candidate reaches ``scope`` characters to both sides, and an interval join by cells of that width finds the parts
inside.

Offsets are code points. Pieces between matches and matches are measured one by one, and their
running sum, a window over the matches of one kind in one text, gives the place of each match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.common import texts_of, write_scratch

SCOPE = 200

# The base patterns and the lengths below which a match is dropped.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"


@dataclass(frozen=True)
class Kind:
    """``least`` characters in ``group`` (0: the whole match); ``role`` is what it can complete."""

    name: str
    pattern: str
    role: str
    weak: bool = False
    group: int = 0
    least: int = 1


KINDS = (
    Kind("assign", ASSIGN, "secret", group=2, least=6),
    Kind("access", ACCESS, "identifier", least=20),
    Kind("hex", HEX, "secret", least=24),
    Kind(
        "identifier",
        r"(?i:client_?id|access_?id|account|user(?:name)?|login)[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9._@-]+)",
        "identifier",
        weak=True,
        group=1,
        least=3,
    ),
    Kind(
        "value",
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}+"
        r"={0,2}+(?![A-Za-z0-9+/_=-])",
        "secret",
        weak=True,
        least=20,
    ),
    Kind(
        "endpoint",
        r"(?:https?|jdbc:[a-z]+|postgres|mysql|redis|amqp|s3a?)://[A-Za-z0-9._:/@%-]+",
        "endpoint",
        weak=True,
        least=10,
    ),
)
KEY = ("id_key", "text_hash")
#: Stands for a null id in keys.
_NO_ID = -(2**63)


def _matches(kind: Kind) -> Column:
    """Per match of the kind: characters before it since the last match, and its own length."""
    text = F.col("text")
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    pieces = F.split(text, kind.pattern, -1)
    rows = F.transform(
        F.arrays_zip(pieces.alias("piece"), whole.alias("match"), value.alias("value")),
        lambda x: F.struct(
            F.length(x["piece"]).alias("gap"),
            F.length(x["match"]).alias("length"),
            (F.length(x["value"]) >= kind.least).alias("kept"),
        ),
    )
    # the last piece has no match behind it
    return F.when(text.rlike(kind.pattern), F.filter(rows, lambda x: x["length"].isNotNull()))


def _keyed(texts: DataFrame) -> DataFrame:
    """With the keys that tell texts apart."""
    return texts.withColumns(
        {
            "id_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
            "text_hash": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
        }
    )


def candidates(docs: DataFrame) -> DataFrame:
    """All matches that are long enough: ``id_key``, ``text_hash``, ``kind`` (its number),
    ``start``, ``stop``. Repeated rows give their matches once."""
    keyed = _keyed(texts_of(docs))
    marked = keyed.where(F.greatest(*(F.col("text").rlike(k.pattern) for k in KINDS)))
    by_kind = F.array(
        *(F.struct(F.lit(i).alias("kind"), _matches(k).alias("found")) for i, k in enumerate(KINDS))
    )
    kinds = marked.select(*KEY, F.inline(by_kind))
    one_each = kinds.select(*KEY, "kind", F.posexplode("found").alias("place", "m"))
    single = one_each.groupBy(*KEY, "kind", "place").agg(F.first("m").alias("m"))
    before = Window.partitionBy(*KEY, "kind").orderBy("place")
    stop = F.sum(F.col("m.gap") + F.col("m.length")).over(before)
    placed = single.select(*KEY, "kind", "m", stop.alias("stop"))
    return placed.where("m.kept").select(
        *KEY, "kind", (F.col("stop") - F.col("m.length")).cast("long").alias("start"), "stop"
    )


def _written_candidates(docs: DataFrame) -> DataFrame:
    """The candidates as a table: few rows, which the linking reads several times."""
    return write_scratch(candidates(docs), "candidates")


def _is(kinds: list[int]) -> Column:
    return F.col("kind").isin(kinds)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Strong spans, and the weak ones that are completed by other parts within ``scope``.

    A weak candidate that overlaps a strong span is no part of its own and is left out.
    """
    weak_kinds = [i for i, k in enumerate(KINDS) if k.weak]
    strong = found.where(~_is(weak_kinds))
    role = F.element_at(F.array(*(F.lit(k.role) for k in KINDS)), F.col("kind") + 1)
    is_long = (role == "secret") & (F.col("stop") - F.col("start") > scope)
    cell = F.floor(F.col("start") / scope)

    def reach(frame: DataFrame) -> DataFrame:
        """A row per cell that the span with its scope touches."""
        first, last = F.floor((F.col("start") - scope) / scope), F.floor((F.col("stop") + scope) / scope)
        return frame.withColumn("cell", F.explode(F.sequence(first, last)))

    covered = F.explode(F.sequence(cell, F.floor((F.col("stop") - 1) / scope)))
    # a part lies in every cell it covers; cells of one pair are compared once, see the distinct
    parts = found.select(
        *KEY,
        covered.alias("cell"),
        F.col("kind").alias("other_kind"),
        role.alias("other_role"),
        F.col("start").alias("other_start"),
        F.col("stop").alias("other_stop"),
    )
    # per cell and kind the outermost parts are enough to tell whether one lies within the scope
    parts = parts.groupBy(*KEY, "cell", "other_kind", "other_role").agg(
        F.min("other_start").alias("low"),
        F.max("other_stop").alias("high"),
        F.collect_set(F.struct("other_start", "other_stop")).alias("spans"),
    )
    pairs = reach(found.where(_is(weak_kinds) | is_long)).join(parts, [*KEY, "cell"])
    near = F.exists(
        "spans",
        lambda s: (s["other_start"] < F.col("stop") + scope)
        & (s["other_stop"] > F.col("start") - scope),
    )
    strong_kinds = [i for i, k in enumerate(KINDS) if not k.weak]
    overlap = F.col("other_kind").isin(strong_kinds) & F.exists(
        "spans",
        lambda s: (s["other_start"] < F.col("stop")) & (s["other_stop"] > F.col("start")),
    )
    told = (
        pairs.where(near)
        .withColumn("role", role)
        .groupBy(*KEY, "kind", "start", "stop", "role")
        .agg(
            F.max(F.col("other_role") == "identifier").alias("has_identifier"),
            F.max(F.col("other_role") == "secret").alias("has_secret"),
            F.max(overlap).alias("overlaps"),
        )
    )
    complete = (
        F.when(F.col("role") == "identifier", F.col("has_secret"))
        .when(F.col("role") == "secret", F.col("has_identifier"))
        .otherwise(F.col("has_identifier") & F.col("has_secret"))
    )
    own = _is(weak_kinds) & ~F.col("overlaps")
    reported = told.where(complete & own)
    bridges = told.where(is_long & F.col("has_identifier") & (own | _is(strong_kinds))).select(
        *KEY,
        covered.alias("cell"),
        F.col("start").alias("other_start"),
        F.col("stop").alias("other_stop"),
    )
    apart = told.where((F.col("role") == "endpoint") & own & ~F.col("has_identifier"))
    bridged = reach(apart).join(bridges, [*KEY, "cell"]).where(
        (F.col("other_start") < F.col("stop") + scope) & (F.col("other_stop") > F.col("start") - scope)
    )
    return (
        strong.unionByName(reported.select(*strong.columns))
        .unionByName(bridged.select(*strong.columns).distinct())
    )


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k.name) for k in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":",
                F.element_at(names, s["kind"] + 1),
                s["start"].cast("string"),
                s["stop"].cast("string"),
            ),
        ),
        ",",
    )


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text_hash`` and ``found``, its spans as an array of
    ``(start, kind, stop)`` in the order of start and kind, empty if there are none.

    A null text counts as empty. Repeated rows get the same spans each; a null ``doc_id`` is one
    more value. Texts are not shuffled, only spans and ids.
    """
    spans = linked(_written_candidates(docs), scope)
    per_text = spans.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "stop"))).alias("found")
    )
    keys = _keyed(texts_of(docs)).select("doc_id", *KEY)
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")
    return keys.join(per_text, list(KEY), "left").select(
        "doc_id", "text_hash", F.coalesce("found", none).alias("found")
    )


def digests(scanned: DataFrame) -> DataFrame:
    """Counts and span lists of the base kinds and of all kinds."""
    base = F.filter("found", lambda s: s["kind"] < 3)

    def count(i: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == i)).cast("long")

    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark`` and ``n_chars`` set anew.

    Overlapping spans are replaced once, from the first start to the last stop. Rows without a span
    keep their text, null included.
    """
    found = linked(_written_candidates(docs), scope)
    per_text = found.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("redact_spans")
    )
    whole = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    keyed = _keyed(docs.select("doc_id", "text", whole))
    joined = keyed.join(per_text, list(KEY), "left")
    text = F.col("text")
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, span: Column) -> Column:
        gap = span["start"] - acc["at"]
        kept = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(gap, F.lit(0)).cast("int"))
        # a span that touches the last one makes one mark with it
        marked = F.when((gap <= 0) & (acc["at"] > 0), acc["done"]).otherwise(
            F.concat(acc["done"], kept, F.lit(mark))
        )
        return F.struct(marked.alias("done"), F.greatest(acc["at"], span["stop"]).alias("at"))

    redacted = F.aggregate(
        "redact_spans",
        start,
        step,
        lambda acc: F.concat(acc["done"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    clean = F.when(F.col("redact_spans").isNull(), text).otherwise(redacted)
    cleaned = joined.select("row", "redact_spans", clean.alias("clean"))

    def column(name: str) -> Column:
        own = F.col("row").getField(name)
        if name == "text":
            return F.col("clean").alias(name)
        if name == "n_chars":
            chars = F.length("clean").cast(docs.schema[name].dataType)
            return F.when(F.col("redact_spans").isNull(), own).otherwise(chars).alias(name)
        return own.alias(name)

    return cleaned.select(*(column(name) for name in docs.columns))
