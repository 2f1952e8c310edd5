"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import write_counted, write_scratch

#: Rows of the working tables in one of their files.
ROWS_PER_FILE = 250_000


def _doubled(parent: DataFrame) -> DataFrame:
    """Every node points where its pointer pointed, and whether that moved it."""
    above = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return parent.join(above, "root").select(
        "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected with, for every node of
    ``edges`` (``a``, ``b``: long, either direction, loops and repeats allowed).

    Each round every node points at its smallest neighbour (or itself), pointers are doubled until
    they reach their roots, and the edges between roots are the input of the next round. Only roots
    that are still connected remain, so rounds are few; no row leaves the executors. Loops stay in
    the table of the first round as edges from a node to itself.
    """
    rest, n = write_counted(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    files = 1 + n // ROWS_PER_FILE  # working tables are never larger
    result = None
    while n:
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(
            F.min(F.least("a", "b")).alias("root")
        )
        parent = write_scratch(parent.coalesce(files), "parents")
        moving = 1
        while moving:
            # two steps at a time; the second one tells whether there is more to do
            stepped = _doubled(_doubled(parent).select("node", "root"))
            stepped, moving = write_counted(stepped.coalesce(files), "parents", F.col("moved"))
            parent = stepped.select("node", "root")
        ends = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        other = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = rest.join(ends, "a").join(other, "b").where("ra <> rb")
        roots = moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        rest, n = write_counted(roots.distinct().coalesce(files), "edges")
        if result is None:
            result = parent.select("node", F.col("root").alias("component"))
        else:
            higher = parent.select(F.col("node").alias("component"), F.col("root").alias("higher"))
            result = write_scratch(
                result.join(higher, "component", "left")
                .select("node", F.coalesce("higher", "component").alias("component"))
                .coalesce(files),
                "components",
            )
    if result is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return result
