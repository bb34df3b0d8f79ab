"""The three reports: hot sections, hot articles, accesses per client.

Each takes raw lines. A batch gives the whole report; a stream gives the counts of closed
windows, and the streaming runner ranks those per micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.columns import once
from ..operators import dimensions as D
from ..operators import parsing, windows


@dataclass(frozen=True)
class PageKind:
    """A kind of page: its column in visits, its dimension, and its result columns."""

    visit_key: str
    dim_key: str
    name: str
    count: str
    prepare: Callable[[DataFrame], DataFrame]


SECTION = PageKind("section_id", "fid", "name", "section_pv", D.sections)
ARTICLE = PageKind("article_id", "tid", "subject", "article_pv", D.articles)


def page_visits(
    visits: DataFrame, dim: DataFrame, kind: PageKind, cfg: JobConfig = JobConfig()
) -> DataFrame:
    """Every visit of a known page: id, name, event_time. `dim` is prepared by its kind."""
    found = D.lookup(visits, dim, kind.visit_key, kind.dim_key, cfg.lookup_salts, cfg.bitmap_bytes)
    return found.select(kind.visit_key, kind.name, "event_time")


def page_counts(
    visits: DataFrame, dim: DataFrame | None, kind: PageKind, cfg: JobConfig, taken=None
) -> DataFrame:
    """Visits of known pages per page and window: id, window, pv, and in a batch the name.

    A batch counts first and names the few counted rows, so that no visit is shuffled for
    the join. A stream looks ids up first: only visits of known pages may move its watermark.
    Its counts have no name; the closed ones are named where they are written. A stream can go on
    from what an earlier one has `taken` (streaming.rebase). Without `dim` it counts all pages.
    """
    width, start = cfg.hot_window, cfg.window_start_time
    if visits.isStreaming:
        known = visits.where(F.col(kind.visit_key) > 0)
        if dim is not None:
            ids = dim.select(kind.dim_key)
            known = D.lookup(visits, ids, kind.visit_key, kind.dim_key, cfg.lookup_salts, cfg.bitmap_bytes)
        known = known.select(kind.visit_key, "event_time")
        if taken is not None:
            known = taken.going_on(known, width, start)
        known = known.withWatermark("event_time", cfg.watermark_delay)
        return windows.tumbling_count(known, [kind.visit_key], width, start)
    counts = windows.tumbling_count(visits, [kind.visit_key], width, start)
    return D.name_counts(counts, dim, kind.visit_key, kind.dim_key)


def page_report(counts: DataFrame, kind: PageKind, cfg: JobConfig) -> DataFrame:
    """Counts with result column names and text bounds."""
    count = (F.col("pv") + F.lit(cfg.count_offset)).alias(kind.count)
    return windows.with_bounds(counts.select(kind.visit_key, kind.name, count, "window"))


def top_pages(counts: DataFrame, kind: PageKind, cfg: JobConfig) -> DataFrame:
    return page_report(windows.top_n(counts, cfg.top_n, kind.visit_key), kind, cfg)


def _hot_pages(lines: DataFrame, dim: DataFrame, kind: PageKind, cfg: JobConfig) -> DataFrame:
    visits = parsing.visit_facts(lines, cfg.honor_offset)
    return top_pages(page_counts(visits, kind.prepare(dim), kind, cfg), kind, cfg)


def hot_section(lines: DataFrame, dim: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    return _hot_pages(lines, dim, SECTION, cfg)


def hot_article(lines: DataFrame, dim: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    return _hot_pages(lines, dim, ARTICLE, cfg)


def client_counts(visits: DataFrame, cfg: JobConfig, taken=None) -> DataFrame:
    """Accesses per client and window, batch or stream; all pages unless told otherwise. The
    watermark of a stream follows all visits, those of other pages too."""
    width, start = cfg.client_window, cfg.window_start_time
    page = (F.col("section_id") > 0) | (F.col("article_id") > 0)
    counted = page if cfg.forum_pages_only else F.lit(True)
    rows = visits.select("client_ip", "event_time", counted.alias("_page"))
    if taken is not None:
        rows = taken.going_on(rows, width, start, _page=F.lit(True))
    rows = rows.withWatermark("event_time", cfg.watermark_delay)
    if cfg.forum_pages_only:
        # A filter on the plain column would be pushed below the watermark.
        rows = once(rows, "_counted", F.col("_page")).where("_counted")
    return client_report(windows.tumbling_count(rows, ["client_ip"], width, start), cfg)


def client_report(counts: DataFrame, cfg: JobConfig) -> DataFrame:
    """Counts per client with result column names and text bounds."""
    count = (F.col("pv") + F.lit(cfg.count_offset)).alias("client_access_cnt")
    return windows.with_bounds(counts.select(F.col("client_ip").alias("client"), count, "window"))


def client_access(lines: DataFrame, cfg: JobConfig = JobConfig(), taken=None) -> DataFrame:
    return client_counts(parsing.visit_facts(lines, cfg.honor_offset), cfg, taken)
