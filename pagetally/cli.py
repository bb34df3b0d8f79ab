"""Run one job: spark-submit --py-files pagetally.zip run_job.py hot_section --kafka ...

Settings of brokers and databases are read from a file of key=value lines (--settings):
kafka.bootstrap.servers, mysql.url, mysql.username, mysql.password, and optionally
mysql.driver. All other kafka.* settings go to the reader or the writer of the topic, as
security settings do; kafka.auto.offset.reset says where a first start begins.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from pagetally import schemas
from pagetally.config import JobConfig
from pagetally.operators.parsing import rejected_lines
from pagetally.plans import reports, tiles
from pagetally.plans.reports import ARTICLE, SECTION
from pagetally.session import build_session
from pagetally.sinks import Console, FileTable, JdbcTable, SnapshotTable
from pagetally.sources import dimensions, lines, tailing
from pagetally.streaming import open_windows, rebase, runner

RESULTS = {
    "hot_section": ("hot_section", schemas.HOT_SECTION),
    "hot_article": ("hot_article", schemas.HOT_ARTICLE),
    "client_access": ("client_ip_access", schemas.CLIENT_IP_ACCESS),
    "rejected_lines": ("rejected_lines", schemas.REJECTED),
}
# Windows that a running report has not closed, read from its checkpoint.
OPEN = {"open_hot_section": SECTION, "open_hot_article": ARTICLE, "open_client_access": None}
DIMENSIONS = {
    "hot_section": ("pre_forum_forum", schemas.SECTION_DIM),
    "hot_article": ("pre_forum_post", schemas.ARTICLE_DIM),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Page-view reports over access logs")
    p.add_argument("job", choices=[*RESULTS, *OPEN, "land_raw_logs", "count_tiles", "compact"])
    p.add_argument("--settings", help="file of key=value lines")

    source = p.add_mutually_exclusive_group()
    source.add_argument("--text", help="text files, as a batch")
    source.add_argument("--landed", help="landed lines, as a batch")
    source.add_argument("--text-stream", help="folder that receives finished log files")
    source.add_argument("--landed-stream", help="landed lines, as a stream")
    source.add_argument("--tail", help="mounted folder of files that are still written to")
    source.add_argument("--kafka", action="store_true", help="topic with log lines")
    p.add_argument("--tiles", help="tiles: count_tiles adds to them, reports read them")
    p.add_argument("--tail-pattern", default="*", help="names of the files in that folder")
    p.add_argument("--topic", default=lines.DEFAULT_TOPIC)
    p.add_argument("--max-files", type=int, help="files per micro-batch")
    p.add_argument("--max-offsets", type=int, help="messages per micro-batch")
    p.add_argument("--min-partitions", type=int, help="least number of tasks that read the topic")

    p.add_argument("--dim-files", help="parquet dimension instead of the database table")
    p.add_argument("--dim-table", help="name of the database table")
    p.add_argument("--dim-parts", type=int, default=8, help="parallel reads of the table")

    out = p.add_mutually_exclusive_group()
    out.add_argument("--out-files", help="folder of parquet files")
    out.add_argument("--out-snapshots", help="folder of parquet files that count by version")
    out.add_argument("--out-jdbc", action="store_true", help="result table of the database")
    out.add_argument("--out-kafka", action="store_true", help="topic (land_raw_logs only)")
    out.add_argument("--out-console", action="store_true")
    p.add_argument("--out-table", help="name of the result table")

    p.add_argument("--checkpoint", help="checkpoint folder of a stream")
    p.add_argument("--earlier", help="checkpoint of a query that has ended, to go on from")
    p.add_argument("--available-now", action="store_true", help="stop when all is read")
    p.add_argument("--state-partitions", type=int, help="of a stream, fixed by its first start")
    p.add_argument("--interval", default="1 minute", help="time between micro-batches")

    d = JobConfig()
    p.add_argument("--top-n", type=int, default=d.top_n)
    p.add_argument("--hot-window", default=d.hot_window)
    p.add_argument("--client-window", default=d.client_window)
    p.add_argument("--watermark-delay", default=d.watermark_delay)
    p.add_argument("--window-start-time", default=d.window_start_time)
    p.add_argument("--lookup-salts", type=int, default=d.lookup_salts)
    p.add_argument("--bitmap-bytes", type=int, default=d.bitmap_bytes)
    p.add_argument("--count-offset", type=int, default=d.count_offset)
    p.add_argument("--honor-offset", action="store_true")
    p.add_argument("--forum-pages-only", action="store_true")
    return p


def settings(path: str | None) -> dict[str, str]:
    if path is None:
        return {}
    with open(path, encoding="utf-8") as f:
        rows = [r.strip() for r in f if r.strip() and not r.lstrip().startswith("#")]
    return {k.strip(): v.strip() for k, _, v in (r.partition("=") for r in rows)}


def _kafka(values: dict[str, str]) -> dict[str, str]:
    """The kafka.* settings without that prefix, and without the servers."""
    found = {k.removeprefix("kafka."): v for k, v in values.items() if k.startswith("kafka.")}
    return {k: v for k, v in found.items() if k != "bootstrap.servers"}


def _connection(values: dict[str, str]) -> dict[str, str]:
    names = {"mysql.username": "user", "mysql.password": "password", "mysql.driver": "driver"}
    return {option: values[key] for key, option in names.items() if key in values}


def source(spark: SparkSession, args, values: dict[str, str]) -> DataFrame:
    given = (args.text, args.landed, args.text_stream, args.landed_stream, args.tail, args.kafka)
    if not any(given):
        raise SystemExit(f"{args.job} needs a source of lines")
    if args.text:
        return lines.text_lines(spark, args.text)
    if args.landed:
        return lines.landed_lines(spark, args.landed)
    if args.text_stream or args.landed_stream:
        read = lines.text_line_stream if args.text_stream else lines.landed_line_stream
        found = read(spark, args.text_stream or args.landed_stream, args.max_files)
        if args.earlier:
            found = lines.without_files(found, rebase.processed_files(spark, args.earlier))
        return found
    ended = rebase.source_position(spark, args.earlier) if args.earlier else None
    if args.tail:
        return tailing.tailed_lines(spark, args.tail, args.tail_pattern, starting_offsets=ended)
    servers = values["kafka.bootstrap.servers"]
    options = lines.kafka_options(
        servers,
        args.topic,
        ended=ended,
        max_offsets_per_trigger=args.max_offsets,
        min_partitions=args.min_partitions,
        consumer=_kafka(values),
    )
    return lines.kafka_lines(spark, options)


def dimension(spark: SparkSession, args, values: dict[str, str]) -> DataFrame:
    table, schema = DIMENSIONS[args.job.removeprefix("open_")]
    if args.dim_files:
        return spark.read.schema(schema).parquet(args.dim_files)
    options = dimensions.jdbc_options(
        values["mysql.url"], args.dim_table or table, _connection(values)
    )
    return dimensions.jdbc_dimension(spark, options, schema, args.dim_parts)


def sink(args, values: dict[str, str]):
    table, schema = RESULTS[args.job.removeprefix("open_")]
    if args.out_files:
        return FileTable(args.out_files, schema)
    if args.out_snapshots:
        return SnapshotTable(args.out_snapshots, schema)
    if args.out_console:
        return Console(schema)
    if not args.out_jdbc:
        raise SystemExit(f"{args.job} writes to --out-files, -snapshots, -jdbc or -console")
    return JdbcTable(
        values["mysql.url"], args.out_table or table, schema, _connection(values)
    )


def config(args) -> JobConfig:
    return JobConfig(
        hot_window=args.hot_window,
        client_window=args.client_window,
        top_n=args.top_n,
        lookup_salts=args.lookup_salts,
        bitmap_bytes=args.bitmap_bytes,
        watermark_delay=args.watermark_delay,
        count_offset=args.count_offset,
        honor_offset=args.honor_offset,
        forum_pages_only=args.forum_pages_only,
        window_start_time=args.window_start_time,
    )


def open_report(spark: SparkSession, args, values: dict[str, str]) -> DataFrame:
    if not args.checkpoint:
        raise SystemExit(f"{args.job} reads the --checkpoint of the running report")
    kind, cfg = OPEN[args.job], config(args)
    if kind is None:
        return open_windows.open_client_access(spark, args.checkpoint, cfg)
    return open_windows.open_pages(spark, args.checkpoint, dimension(spark, args, values), kind, cfg)


def tile_report(spark: SparkSession, args, values: dict[str, str]) -> DataFrame:
    store, cfg = tiles.TileStore(args.tiles, args.honor_offset), config(args)
    if args.job == "client_access":
        return tiles.client_access(spark, store, cfg)
    kind = {"hot_section": SECTION, "hot_article": ARTICLE}[args.job]
    return tiles.top_pages(store, dimension(spark, args, values), kind, cfg)


def count_tiles(spark: SparkSession, args) -> None:
    if not args.tiles or not (args.text or args.landed):
        raise SystemExit("count_tiles counts --text or --landed files into --tiles")
    store, form = tiles.TileStore(args.tiles, args.honor_offset), "text" if args.text else "parquet"
    store.add(spark, args.text or args.landed, form)


def compact(spark: SparkSession, args) -> None:
    """Fewer folders of tiles or of a result; what readers of the version before use stays."""
    if not args.tiles and not args.out_snapshots:
        raise SystemExit("compact works on --tiles or --out-snapshots")
    if args.tiles:
        table = tiles.TileStore(args.tiles)
    else:
        table = SnapshotTable.of(spark, args.out_snapshots)
    table.compact(spark)
    table.manifest.clean(spark)


def _run(spark: SparkSession, args) -> None:
    values, cfg = settings(args.settings), config(args)
    if args.job in ("count_tiles", "compact"):
        {"count_tiles": count_tiles, "compact": compact}[args.job](spark, args)
        return
    if args.tiles and args.job in ("hot_section", "hot_article", "client_access"):
        sink(args, values).write(tile_report(spark, args, values))
        return
    if args.job in OPEN:
        if args.out_kafka:
            raise SystemExit("reports write to --out-files, --out-jdbc or --out-console")
        sink(args, values).write(open_report(spark, args, values))
        return
    rows = source(spark, args, values)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.interval}
    if rows.isStreaming:
        if not args.checkpoint:
            raise SystemExit("a stream needs --checkpoint")
        if args.state_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", args.state_partitions)
    if args.job == "land_raw_logs":
        if not rows.isStreaming:
            raise SystemExit("land_raw_logs needs a stream")
        if args.out_kafka:
            servers = values["kafka.bootstrap.servers"]
            options = runner.producer_options(servers, args.topic, _kafka(values))
            runner.publish_raw_logs(rows, options, args.checkpoint, trigger).awaitTermination()
        elif args.out_files:
            runner.land_raw_logs(
                rows, args.out_files, args.checkpoint, trigger
            ).awaitTermination()
        else:
            raise SystemExit("land_raw_logs writes to --out-files or --out-kafka")
        return
    if args.out_kafka:
        raise SystemExit("reports write to --out-files, --out-jdbc or --out-console")
    target = sink(args, values)
    if args.job == "client_access":
        if rows.isStreaming:
            runner.start_client_access(
                rows, target, args.checkpoint, cfg, trigger, args.earlier
            ).awaitTermination()
        else:
            target.write(reports.client_access(rows, cfg))
        return
    if args.job == "rejected_lines":
        if rows.isStreaming:
            runner.start_rejected_lines(
                rows, target, args.checkpoint, cfg, trigger
            ).awaitTermination()
        else:
            target.write(rejected_lines(rows, cfg.honor_offset))
        return
    dim = dimension(spark, args, values)
    start, report = {
        "hot_section": (runner.start_hot_section, reports.hot_section),
        "hot_article": (runner.start_hot_article, reports.hot_article),
    }[args.job]
    if rows.isStreaming:
        start(rows, dim, target, args.checkpoint, cfg, trigger, args.earlier).awaitTermination()
    else:
        target.write(report(rows, dim, cfg))


def run(spark: SparkSession, args) -> None:
    """One job; late rows are logged while it runs."""
    late = runner.LateRows()
    spark.streams.addListener(late)
    try:
        _run(spark, args)
    finally:
        spark.streams.removeListener(late)


def main() -> None:
    args = parser().parse_args()
    run(build_session(args.job), args)


if __name__ == "__main__":
    main()
