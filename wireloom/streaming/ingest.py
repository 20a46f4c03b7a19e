"""Incremental collection: every micro-batch is one run of the collect job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wireloom.plans import jobs
from wireloom.sources.store import NewsStore


def run_name(stream: str, epoch: int) -> str:
    """The batch id of a micro-batch; a replayed one has the same."""
    return f"{stream}-{epoch:010d}"


def _drained(stream: DataFrame, collect: Callable[[DataFrame, str], object], checkpoint: str, name: str, on_batch) -> StreamingQuery:
    """Start a query that collects every micro-batch under its own name, and ends with the input."""

    def each(batch: DataFrame, epoch: int) -> None:
        counts = collect(batch, run_name(name, epoch))
        if on_batch is not None:
            on_batch(run_name(name, epoch), counts)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(name).trigger(availableNow=True).start()


def ingest(
    messages: DataFrame,
    store: NewsStore,
    group: str,
    checkpoint: str,
    stream: str = "ingest",
    agencies: DataFrame | None = None,
    on_batch: Callable[[str, tuple[int, int]], None] | None = None,
) -> StreamingQuery:
    """Stage what is new in a stream of messages, then stop when the input is drained.

    Duplicates are found against the store and within the micro-batch, so no
    state grows with the stream.  A message is taken however late it is, as long
    as its id is unseen.
    """
    return _drained(messages, lambda batch, name: jobs.collect(store, batch, group, name, agencies), checkpoint, stream, on_batch)


def ingest_pages(
    pages: DataFrame,
    store: NewsStore,
    agencies: DataFrame,
    checkpoint: str,
    stream: str = "pages",
    on_batch: Callable[[str, dict[str, tuple[int, int]]], None] | None = None,
) -> StreamingQuery:
    """The same for a stream of channel pages (channel, html), for all groups."""
    return _drained(pages, lambda batch, name: jobs.collect_pages(store, batch, agencies, name), checkpoint, stream, on_batch)
