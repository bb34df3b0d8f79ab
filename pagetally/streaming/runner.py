"""The reports and the landing job as streaming queries. Every query has a checkpoint."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..config import JobConfig
from ..operators import dimensions as D
from ..operators.parsing import rejected_lines, visit_facts
from ..plans import reports
from ..plans.reports import ARTICLE, SECTION, PageKind
from ..sinks import Batch, query_id
from ..sources.dimensions import snapshot
from ..sources.lines import CONSUMER_ONLY
from .rebase import take_over

log = logging.getLogger(__name__)

SERIALIZERS = {"key.serializer", "value.serializer"}  # Spark's own

# Trigger settings: all that is there now, then stop.
AVAILABLE_NOW = {"availableNow": True}


class LateRows(StreamingQueryListener):
    """Logs how many rows of a micro-batch came after their window was closed."""

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        if late:
            log.warning("%s, batch %s: %s late rows", event.progress.name, event.progress.batchId, late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start_writing(
    df: DataFrame,
    sink_write: Callable[[DataFrame, Batch], None],
    checkpoint: str,
    name: str,
    trigger: dict,
    mode: str = "append",
) -> StreamingQuery:
    """Hand every micro-batch to a sink, with its number and the id of the query."""
    owner: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not owner:
            owner.append(query_id(batch.sparkSession, checkpoint))
        sink_write(batch, Batch(owner[0], batch_id))

    writer = df.writeStream.outputMode(mode).queryName(name)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.foreachBatch(write).start()


def _start_hot_pages(
    lines: DataFrame,
    dim: DataFrame,
    kind: PageKind,
    sink,
    checkpoint: str,
    cfg: JobConfig,
    trigger: dict,
    earlier: str | None,
) -> StreamingQuery:
    """Count by id and window in the stream, and rank and name the closed windows of each
    micro-batch.

    All rows of a window close in the same micro-batch, so ranking there is complete, keeps
    no list of rows as state, and sends n rows per task and window through the shuffle. Names
    are no part of the state: a page that is renamed between two starts keeps one counter.
    """
    fixed = snapshot(kind.prepare(dim), kind.visit_key, owner=checkpoint)
    taken = take_over(lines.sparkSession, earlier, checkpoint, kind.visit_key, LongType())
    counts = reports.page_counts(visit_facts(lines, cfg.honor_offset), fixed, kind, cfg, taken)

    def write(counted: DataFrame, batch: Batch) -> None:
        named = D.name_counts(counted, fixed, kind.visit_key, kind.dim_key, how="left")
        sink.write(reports.top_pages(named, kind, cfg), batch)

    return start_writing(counts, write, checkpoint, f"hot_{kind.visit_key}", trigger)


def start_hot_section(
    lines: DataFrame,
    dim: DataFrame,
    sink,
    checkpoint: str,
    cfg: JobConfig = JobConfig(),
    trigger: dict = AVAILABLE_NOW,
    earlier: str | None = None,
) -> StreamingQuery:
    return _start_hot_pages(lines, dim, SECTION, sink, checkpoint, cfg, trigger, earlier)


def start_hot_article(
    lines: DataFrame,
    dim: DataFrame,
    sink,
    checkpoint: str,
    cfg: JobConfig = JobConfig(),
    trigger: dict = AVAILABLE_NOW,
    earlier: str | None = None,
) -> StreamingQuery:
    return _start_hot_pages(lines, dim, ARTICLE, sink, checkpoint, cfg, trigger, earlier)


def start_client_access(
    lines: DataFrame,
    sink,
    checkpoint: str,
    cfg: JobConfig = JobConfig(),
    trigger: dict = AVAILABLE_NOW,
    earlier: str | None = None,
) -> StreamingQuery:
    """With `earlier`, the checkpoint of a query that has ended, the report goes on from there."""
    taken = take_over(lines.sparkSession, earlier, checkpoint, "client_ip", StringType())
    counts = reports.client_access(lines, cfg, taken)
    return start_writing(counts, sink.write, checkpoint, "client_access", trigger)


def start_rejected_lines(
    lines: DataFrame,
    sink,
    checkpoint: str,
    cfg: JobConfig = JobConfig(),
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """The lines that yield no visit, with the reason, as a result table of their own."""
    rejected = rejected_lines(lines, cfg.honor_offset)
    return start_writing(rejected, sink.write, checkpoint, "rejected_lines", trigger)


def _landing(lines: DataFrame, checkpoint: str, trigger: dict) -> DataStreamWriter:
    writer = lines.select("value").writeStream.outputMode("append").queryName("land_raw_logs")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger)


def land_raw_logs(
    lines: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Store raw lines durably, each exactly once, also over restarts."""
    return _landing(lines, checkpoint, trigger).format("parquet").start(path)


def producer_options(
    servers: str, topic: str, producer: dict[str, str] | None = None
) -> dict[str, str]:
    """Writer options for a Kafka topic; producer settings are passed through as kafka.*"""
    own = {k: v for k, v in (producer or {}).items() if k not in CONSUMER_ONLY | SERIALIZERS}
    settings = {"acks": "1", "linger.ms": "1", "compression.type": "snappy", **own}
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        **{f"kafka.{k}": v for k, v in settings.items()},
    }


def publish_raw_logs(
    lines: DataFrame, options: dict[str, str], checkpoint: str, trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Send raw lines to Kafka. Needs the spark-sql-kafka package on the cluster."""
    return _landing(lines, checkpoint, trigger).format("kafka").options(**options).start()
