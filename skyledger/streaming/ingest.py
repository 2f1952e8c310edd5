"""Raw files to silver as a stream: each file once, also over restarts."""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators.silver import to_silver
from skyledger.plans.storage import Deployment
from skyledger.sinks.tables import LoadMetrics, supersede, write_load
from skyledger.sources.commits import streams
from skyledger.sources.raw import RAW_GLOB, stream_raw
from skyledger.sources.schema import CORRUPT


class _Identity:
    """The id of the stream, which its batches wait for; it comes with the checkpoint."""

    def __init__(self):
        self._known, self._id = Event(), ""

    def set(self, query: StreamingQuery) -> None:
        self._id = query.id
        self._known.set()

    def get(self) -> str:
        self._known.wait()
        return self._id


def _take_over(
    spark: SparkSession, deployment: Deployment, stream: str, supersede_others: bool
) -> None:
    """Refuses to count files twice that a stream with another checkpoint has taken."""
    for other in sorted(streams(spark, deployment) - {stream}):
        if not supersede_others:
            raise ValueError(
                f"{deployment.root} has loads of another ingest stream ({other}); its checkpoint is "
                "gone, so this stream would load the same files again. Put the checkpoint back, or "
                "pass supersede=True to replace those loads."
            )
        supersede(spark, deployment, other, stream)


def start_ingest(
    spark: SparkSession,
    deployment: Deployment,
    raw: str | None = None,
    glob: str = RAW_GLOB,
    recursive: bool = False,
    location_mode: str = "string",
    gather_days: bool = False,
    every: str | None = None,
    after_load: Callable[[], object] | None = None,
    report: Callable[[LoadMetrics], object] | None = None,
    supersede: bool = False,
    **options: str,
) -> StreamingQuery:
    """Start the stream; ``every`` (such as ``1 hour``) keeps it running, else it ends when it
    has taken all files there are.

    A batch goes to a load named after the stream and its number in the checkpoint; a batch repeated
    after a failure is the same load. A new checkpoint makes a new stream: it fails if another one
    has loads here, or replaces them with ``supersede``. ``after_load`` is part of the batch;
    ``report`` gets the counts of each load, which cost a job.
    """
    identity, first = _Identity(), [True]

    def write(batch: DataFrame, number: int) -> None:
        stream = identity.get()
        if first:
            _take_over(spark, deployment, stream, supersede)
            first.clear()
        load_id = f"stream-{stream}-{number:09d}"
        metrics = write_load(
            batch, deployment, load_id, gather_days, stream, count=report is not None
        )
        if report:
            report(metrics)
        if after_load:
            after_load()

    documents = stream_raw(spark, raw or deployment.raw, glob, recursive, **options)
    writer = (
        to_silver(documents, location_mode, keep=[CORRUPT])
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", deployment.checkpoint("silver"))
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    query = writer.trigger(**trigger).start()
    identity.set(query)
    return query


def ingest_available(
    spark: SparkSession, deployment: Deployment, raw: str | None = None, **reading: object
) -> None:
    start_ingest(spark, deployment, raw, **reading).awaitTermination()
