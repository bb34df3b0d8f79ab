"""Every operator and report as a query over a folder of tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .config import JobConfig
from .functions import columns as C
from .operators import dimensions as D
from .operators import parsing
from .plans import reports, tiles, visits
from .plans.reports import ARTICLE, SECTION
from .session import run_dir
from .sinks import FileTable, SnapshotTable
from .sources import derived, lines, tailing
from .streaming import changes, open_windows, rebase, runner
from .streaming import visits as visit_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Dates are read and windows are shown in UTC, whatever the session was set to.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return lines.spread(_table(spark, sf_dir, name).select(*columns))


_EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
_ITEM_COLUMNS = (
    "l_suppkey",
    "l_partkey",
    "l_linenumber",
    "l_extendedprice",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


def _forum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.forum_lines(_log_table(spark, sf_dir, "events", *_EVENT_COLUMNS))


def _shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.shop_lines(_log_table(spark, sf_dir, "lineitem", *_ITEM_COLUMNS))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prose = derived.prose_lines(_log_table(spark, sf_dir, "documents", "text"))
    return _forum(spark, sf_dir).union(prose)


def _forum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return derived.forum_lines(reader.parquet(sf_dir))


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.section_table(_table(spark, sf_dir, "nation"))


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.article_table(_table(spark, sf_dir, "part"))


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", C.time_text(F.col("event_time")))


# Parsing


@query
def parse_lines(spark, sf_dir):
    return parsing.parse_lines(_mixed(spark, sf_dir))


@query
def rejected_lines(spark, sf_dir):
    return parsing.rejected_lines(_mixed(spark, sf_dir))


@query
def successful_requests(spark, sf_dir):
    return parsing.successful(parsing.parse_lines(_forum(spark, sf_dir)))


@query
def combined_fields(spark, sf_dir):
    return parsing.parse_lines(_forum(spark, sf_dir), combined=True)


@query
def crawl_combined_fields(spark, sf_dir):
    pages = derived.crawl_lines(_table(spark, sf_dir, "pages"))
    return parsing.parse_lines(pages, combined=True)


@query
def parse_dates(spark, sf_dir):
    dated = parsing.parsed_dates(parsing.parse_lines(_forum(spark, sf_dir)))
    return dated.select("client_ip", "date_time", "event_time_text")


@query
def epoch_millis(spark, sf_dir):
    dated = parsing.parsed_dates(parsing.parse_lines(_forum(spark, sf_dir)))
    return dated.select("client_ip", "date_time", "event_ms")


@query
def page_ids(spark, sf_dir):
    found = parsing.page_ids(parsing.parse_lines(_forum(spark, sf_dir)))
    return found.select("client_ip", "request", "section_id", "article_id")


@query
def request_parts(spark, sf_dir):
    return parsing.request_parts(parsing.parse_lines(_forum(spark, sf_dir)))


@query
def visit_facts(spark, sf_dir):
    return _timed(parsing.visit_facts(_forum(spark, sf_dir)))


# Dimensions and lookups


@query
def dim_sections(spark, sf_dir):
    return D.sections(_sections(spark, sf_dir))


@query
def dim_articles(spark, sf_dir):
    return D.articles(_articles(spark, sf_dir))


@query
def section_visits(spark, sf_dir):
    found = parsing.visit_facts(_forum(spark, sf_dir))
    return _timed(reports.page_visits(found, D.sections(_sections(spark, sf_dir)), SECTION))


@query
def article_visits(spark, sf_dir):
    found = parsing.visit_facts(_forum(spark, sf_dir))
    return _timed(reports.page_visits(found, D.articles(_articles(spark, sf_dir)), ARTICLE))


@query
def article_visits_bitmap(spark, sf_dir):
    """The lookup in a dimension that is not broadcast: a bitmap of its ids, then the salted join."""
    found = parsing.visit_facts(_forum(spark, sf_dir))
    dim = D.articles(_articles(spark, sf_dir))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        visited = reports.page_visits(found, dim, ARTICLE)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    return _timed(visited)


# Window counts


@query
def section_pv_3d(spark, sf_dir):
    found = parsing.visit_facts(_forum(spark, sf_dir))
    dim, cfg = D.sections(_sections(spark, sf_dir)), JobConfig()
    return reports.page_report(reports.page_counts(found, dim, SECTION, cfg), SECTION, cfg)


@query
def article_pv_3d(spark, sf_dir):
    found = parsing.visit_facts(_forum(spark, sf_dir))
    dim, cfg = D.articles(_articles(spark, sf_dir)), JobConfig()
    return reports.page_report(reports.page_counts(found, dim, ARTICLE, cfg), ARTICLE, cfg)


@query
def client_access_1d(spark, sf_dir):
    return reports.client_access(_forum(spark, sf_dir))


@query
def client_forum_access_1d(spark, sf_dir):
    return reports.client_access(_forum(spark, sf_dir), JobConfig(forum_pages_only=True))


@query
def client_access_zoned(spark, sf_dir):
    """With the zone offset of the log honored and counters that start at one."""
    return reports.client_access(
        _forum(spark, sf_dir), JobConfig(honor_offset=True, count_offset=1)
    )


# Reports


@query
def hot_section(spark, sf_dir):
    return reports.hot_section(_forum(spark, sf_dir), _sections(spark, sf_dir))


@query
def hot_section_top3(spark, sf_dir):
    cfg = JobConfig(top_n=3)
    return reports.hot_section(_forum(spark, sf_dir), _sections(spark, sf_dir), cfg)


@query
def hot_section_local_days(spark, sf_dir):
    """Windows that start at midnight of UTC+8."""
    cfg = JobConfig(window_start_time="16 hours")
    return reports.hot_section(_forum(spark, sf_dir), _sections(spark, sf_dir), cfg)


@query
def hot_article(spark, sf_dir):
    return reports.hot_article(_forum(spark, sf_dir), _articles(spark, sf_dir))


@query
def hot_article_shop(spark, sf_dir):
    """The article report with n = 3 over the largest table, one line per item."""
    cfg = JobConfig(top_n=3)
    return reports.hot_article(_shop(spark, sf_dir), _articles(spark, sf_dir), cfg)


@query
def client_access_shop(spark, sf_dir):
    return reports.client_access(_shop(spark, sf_dir))


def _part_counts(spark: SparkSession, sf_dir: str, cfg: JobConfig) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") + 1).cast("bigint").alias("article_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )
    return reports.page_counts(items, D.articles(_articles(spark, sf_dir)), ARTICLE, cfg)


@query
def top_parts_3d(spark, sf_dir):
    """Counting and ranking alone, on typed columns without any text."""
    cfg = JobConfig(top_n=3)
    return reports.top_pages(_part_counts(spark, sf_dir, cfg), ARTICLE, cfg)


@query
def top_parts_3d_large(spark, sf_dir):
    """So many rows of each window that they are selected by histograms."""
    cfg = JobConfig(top_n=5_000)
    return reports.top_pages(_part_counts(spark, sf_dir, cfg), ARTICLE, cfg)


@query
def top_parts_year_large(spark, sf_dir):
    """The same over windows of a year, which have more parts than that from a scale of 0.1 on."""
    cfg = JobConfig(top_n=1_500, hot_window="360 days")
    return reports.top_pages(_part_counts(spark, sf_dir, cfg), ARTICLE, cfg)


@query
def client_access_from_table(spark, sf_dir):
    """The client report from the stored visits instead of from text."""
    path = run_dir(spark, "visits")
    visits.write_visits(_forum(spark, sf_dir), path)
    return reports.client_counts(visits.read_visits(spark, path), JobConfig())


# Sinks: two appends of a report to its result table


def _append_twice(report: DataFrame, table: FileTable) -> DataFrame:
    for _ in range(2):
        table.write(report)
    return table.read(report.sparkSession)


@query
def append_hot_section(spark, sf_dir):
    table = FileTable(run_dir(spark, "hot_section"), schemas.HOT_SECTION)
    return _append_twice(hot_section(spark, sf_dir), table)


@query
def append_hot_article(spark, sf_dir):
    table = FileTable(run_dir(spark, "hot_article"), schemas.HOT_ARTICLE)
    return _append_twice(hot_article(spark, sf_dir), table)


@query
def append_client_access(spark, sf_dir):
    table = FileTable(run_dir(spark, "client_ip_access"), schemas.CLIENT_IP_ACCESS)
    return _append_twice(client_access_1d(spark, sf_dir), table)


@query
def append_client_access_compacted(spark, sf_dir):
    """Two appends, brought together into one folder that readers of the first version do not see."""
    table = SnapshotTable(run_dir(spark, "client_snapshots"), schemas.CLIENT_IP_ACCESS)
    _append_twice(client_access_1d(spark, sf_dir), table)
    table.compact(spark)
    table.manifest.clean(spark)
    return table.read(spark)


# Tiles: increments over a folder of log files that has more of them each time


def _tiles(spark: SparkSession, sf_dir: str) -> tiles.TileStore:
    """Two increments; the second finds the files of the first beside its own."""
    work = run_dir(spark, "tiles")
    store, forum = tiles.TileStore(f"{work}/tiles"), _forum(spark, sf_dir)
    late = F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    for part in (~late, late):
        forum.where(part).write.mode("append").text(f"{work}/logs")
        store.add(spark, f"{work}/logs/*.txt")
    return store


@query
def section_pv_3d_from_tiles(spark, sf_dir):
    return tiles.page_report(_tiles(spark, sf_dir), _sections(spark, sf_dir), SECTION)


@query
def hot_article_from_tiles(spark, sf_dir):
    """From tiles that were brought together."""
    store = _tiles(spark, sf_dir)
    store.compact(spark)
    store.manifest.clean(spark)
    return tiles.top_pages(store, _articles(spark, sf_dir), ARTICLE)


@query
def client_access_from_tiles(spark, sf_dir):
    return tiles.client_access(spark, _tiles(spark, sf_dir), JobConfig(forum_pages_only=True))


# Streams: run over all that is there, then read the result table


@query
def stream_client_access(spark, sf_dir):
    work = run_dir(spark, "stream_client_access")
    table = FileTable(f"{work}/out", schemas.CLIENT_IP_ACCESS)
    source = _forum_stream(spark, sf_dir)
    runner.start_client_access(source, table, f"{work}/checkpoint").awaitTermination()
    return table.read(spark)


@query
def stream_open_client_windows(spark, sf_dir):
    """What the client report has counted in the windows that it has not closed."""
    work = run_dir(spark, "stream_open_client_windows")
    table = FileTable(f"{work}/out", schemas.CLIENT_IP_ACCESS)
    source = _forum_stream(spark, sf_dir)
    runner.start_client_access(source, table, f"{work}/checkpoint").awaitTermination()
    return open_windows.open_client_access(spark, f"{work}/checkpoint")


@query
def stream_client_access_so_far(spark, sf_dir):
    """Closed windows from the result table and open ones from the state: the whole report."""
    work = run_dir(spark, "stream_client_access_so_far")
    table = FileTable(f"{work}/out", schemas.CLIENT_IP_ACCESS)
    source = _forum_stream(spark, sf_dir)
    runner.start_client_access(source, table, f"{work}/checkpoint").awaitTermination()
    return open_windows.client_access_so_far(spark, table, f"{work}/checkpoint")


@query
def stream_open_hot_article(spark, sf_dir):
    """The top articles of the windows that are still open."""
    work = run_dir(spark, "stream_open_hot_article")
    table = FileTable(f"{work}/out", schemas.HOT_ARTICLE)
    source, dim = _forum_stream(spark, sf_dir), _articles(spark, sf_dir)
    cfg = JobConfig(top_n=3)
    runner.start_hot_article(source, dim, table, f"{work}/checkpoint", cfg).awaitTermination()
    return open_windows.open_pages(spark, f"{work}/checkpoint", dim, ARTICLE, cfg)


@query
def stream_client_access_two_runs(spark, sf_dir):
    """Two streams of their own checkpoints into one result table: both results are there."""
    work = run_dir(spark, "stream_two_runs")
    table = FileTable(f"{work}/out", schemas.CLIENT_IP_ACCESS)
    for name in ("first", "second"):
        source = _forum_stream(spark, sf_dir)
        runner.start_client_access(source, table, f"{work}/{name}").awaitTermination()
    return table.read(spark)


@query
def stream_client_access_snapshots(spark, sf_dir):
    """The client report as a stream into a table of snapshots."""
    work = run_dir(spark, "stream_snapshots")
    table = SnapshotTable(f"{work}/out", schemas.CLIENT_IP_ACCESS)
    source = _forum_stream(spark, sf_dir)
    runner.start_client_access(source, table, f"{work}/checkpoint").awaitTermination()
    table.compact(spark)
    return table.read(spark)


@query
def stream_hot_section(spark, sf_dir):
    work = run_dir(spark, "stream_hot_section")
    table = FileTable(f"{work}/out", schemas.HOT_SECTION)
    source, dim = _forum_stream(spark, sf_dir), _sections(spark, sf_dir)
    runner.start_hot_section(source, dim, table, f"{work}/checkpoint").awaitTermination()
    return table.read(spark)


@query
def stream_hot_article(spark, sf_dir):
    work = run_dir(spark, "stream_hot_article")
    table = FileTable(f"{work}/out", schemas.HOT_ARTICLE)
    source, dim = _forum_stream(spark, sf_dir), _articles(spark, sf_dir)
    cfg = JobConfig(top_n=3)
    runner.start_hot_article(source, dim, table, f"{work}/checkpoint", cfg).awaitTermination()
    return table.read(spark)


@query
def stream_hot_article_renamed(spark, sf_dir):
    """A stream that is stopped halfway and goes on after all subjects were edited."""
    work = run_dir(spark, "stream_renamed")
    table = FileTable(f"{work}/out", schemas.HOT_ARTICLE)
    dim = _articles(spark, sf_dir)
    edited = F.when(F.col("subject") != "", F.concat("subject", F.lit(" (new)"))).otherwise("")
    names = (dim, dim.withColumn("subject", edited))
    for source, known in zip(_halves(spark, sf_dir, f"{work}/events"), names, strict=True):
        runner.start_hot_article(
            derived.forum_lines(source), known, table, f"{work}/checkpoint", JobConfig(top_n=3)
        ).awaitTermination()
    return table.read(spark)


def _late(spark: SparkSession, sf_dir: str, work: str) -> None:
    """Two runs: nine tenths of the events, and then the others, mostly late."""
    events = _table(spark, sf_dir, "events")
    table = FileTable(f"{work}/out", schemas.CLIENT_IP_ACCESS)
    for part in (F.col("event_id") % 10 != 0, F.col("event_id") % 10 == 0):
        events.where(part).write.mode("append").parquet(f"{work}/events")
        source = derived.forum_lines(spark.readStream.schema(events.schema).parquet(f"{work}/events"))
        visit_streams.start_visits(source, work, f"{work}/cp-visits").awaitTermination()
        found = visit_streams.visit_stream(spark, work)
        visit_streams.start_client_access(found, table, f"{work}/cp-report").awaitTermination()


@query
def stream_late_rows(spark, sf_dir):
    """Visits that came when their window was closed."""
    work = run_dir(spark, "stream_late_rows")
    _late(spark, sf_dir, work)
    return _timed(visit_streams.late_visits(spark, work).drop("batch_id"))


@query
def stream_client_access_corrected(spark, sf_dir):
    """Closed, open and late counts of the client report: all visits."""
    work = run_dir(spark, "stream_corrected")
    _late(spark, sf_dir, work)
    closed = FileTable(f"{work}/out", schemas.CLIENT_IP_ACCESS).read(spark)
    still = open_windows.open_client_access(spark, f"{work}/cp-report")
    late = visit_streams.corrections(spark, work)
    every = closed.unionByName(still).unionByName(late)
    return every.groupBy("client", "time_beg", "time_end").agg(
        F.sum("client_access_cnt").alias("client_access_cnt")
    )


def _halves(spark: SparkSession, sf_dir: str, folder: str):
    """Twice: the events of one half of the time, added to a folder of files."""
    events = _table(spark, sf_dir, "events")
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    middle = ends.select((F.col("low") + (F.col("high") - F.col("low")) / 2).alias("at")).first().at
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        events.where(part).write.mode("append").parquet(folder)
        yield spark.readStream.schema(events.schema).parquet(folder)


@query
def stream_hot_article_changed(spark, sf_dir):
    """A report that runs on while every second subject is edited and one of ten articles goes."""
    work = run_dir(spark, "stream_changed")
    table = FileTable(f"{work}/out", schemas.HOT_ARTICLE)
    pages = SnapshotTable(f"{work}/pages", changes.change_schema(ARTICLE))
    first = D.articles(_articles(spark, sf_dir)).select("tid", "subject", F.lit(1).alias("version"))
    edited = F.when(F.col("tid") % 10 == 3, "").otherwise(F.concat("subject", F.lit(" (new)")))
    then = first.where("tid % 2 = 1").select("tid", edited.alias("subject"), F.lit(2).alias("version"))
    report = None
    for source, change in zip(_halves(spark, sf_dir, f"{work}/events"), (first, then), strict=True):
        change.write.mode("append").parquet(f"{work}/changes")
        stream = spark.readStream.schema(first.schema).parquet(f"{work}/changes")
        changes.start_dimension(stream, ARTICLE, pages, f"{work}/cp-pages").awaitTermination()
        if report is None:
            report = changes.start_hot_pages(
                derived.forum_lines(source), ARTICLE, pages, table, f"{work}/cp-report",
                JobConfig(top_n=3), {"processingTime": "0 seconds"},
            )
        report.processAllAvailable()
    report.stop()
    return table.read(spark)


@query
def stream_client_access_rebased(spark, sf_dir):
    """A query of 8 state partitions ends halfway, and one of 32 goes on from its open windows;
    what both have reported, and what is open in the end."""
    work = run_dir(spark, "stream_rebased")
    table = FileTable(f"{work}/out", schemas.CLIENT_IP_ACCESS)
    key, before = "spark.sql.shuffle.partitions", None
    kept = spark.conf.get(key)
    try:
        for partitions, source in zip((8, 32), _halves(spark, sf_dir, f"{work}/lines"), strict=True):
            spark.conf.set(key, str(partitions))
            checkpoint = f"{work}/checkpoint-{partitions}"
            if before:
                source = lines.without_files(source, rebase.processed_files(spark, before))
            raw = derived.forum_lines(source)
            runner.start_client_access(raw, table, checkpoint, earlier=before).awaitTermination()
            before = checkpoint
    finally:
        spark.conf.set(key, kept)
    return table.read(spark).unionByName(open_windows.open_client_access(spark, before))


@query
def land_raw_logs(spark, sf_dir):
    work = run_dir(spark, "land_raw_logs")
    source = _forum_stream(spark, sf_dir)
    runner.land_raw_logs(source, f"{work}/lines", f"{work}/checkpoint").awaitTermination()
    return lines.landed_lines(spark, f"{work}/lines")


@query
def land_tailed_logs(spark, sf_dir):
    """Logs that grow and are rotated between two starts of the landing job."""
    work = run_dir(spark, "land_tailed_logs")
    _forum(spark, sf_dir).write.parquet(f"{work}/source")
    source = spark.read.schema(schemas.RAW_LINE).parquet(f"{work}/source")
    for grown in (False, True):
        derived.write_server_logs(source, f"{work}/logs", grown)
        stream = tailing.tailed_lines(spark, f"{work}/logs", "server-*")
        runner.land_raw_logs(stream, f"{work}/lines", f"{work}/checkpoint").awaitTermination()
    return lines.landed_lines(spark, f"{work}/lines")


# Whole chains: lines pass through files before the report


@query
def client_access_from_text(spark, sf_dir):
    path = run_dir(spark, "text")
    _forum(spark, sf_dir).write.text(path)
    return reports.client_access(lines.text_lines(spark, path))


@query
def hot_article_from_landed(spark, sf_dir):
    landed = land_raw_logs(spark, sf_dir)
    return reports.hot_article(landed, _articles(spark, sf_dir))


@query
def stream_client_access_from_landed(spark, sf_dir):
    """Two streams in a row: landing, then the report over the landed files."""
    work = run_dir(spark, "stream_from_landed")
    table = FileTable(f"{work}/out", schemas.CLIENT_IP_ACCESS)
    raw, cfg = f"{work}/lines", JobConfig(forum_pages_only=True)
    runner.land_raw_logs(
        _forum_stream(spark, sf_dir), raw, f"{work}/landing"
    ).awaitTermination()
    source = lines.landed_line_stream(spark, raw)
    runner.start_client_access(source, table, f"{work}/report", cfg).awaitTermination()
    return table.read(spark)
