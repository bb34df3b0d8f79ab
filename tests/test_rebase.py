"""A report that goes on in a new query."""

import pytest
from pyspark.sql import functions as F
from test_streaming import LogFolder, at, rows, visit

from pagetally import cli, schemas
from pagetally.config import JobConfig
from pagetally.plans import reports
from pagetally.session import children
from pagetally.sinks import FileTable
from pagetally.sources import lines
from pagetally.streaming import open_windows, rebase, runner


@pytest.fixture()
def logs(folder):
    return LogFolder(f"{folder}/logs")


@pytest.fixture()
def partitions(spark):
    """Set the number of state partitions of the next query."""
    key = "spark.sql.shuffle.partitions"
    kept = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, kept)


def stream(spark, logs, before=None):
    found = lines.text_line_stream(spark, str(logs.path))
    return lines.without_files(found, rebase.processed_files(spark, before)) if before else found


def test_more_state_partitions_halfway(spark, folder, logs, partitions):
    table = FileTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
    first, second = f"{folder}/cp1", f"{folder}/cp2"
    partitions(4)
    logs.add([visit(at(1)), visit(at(2)), visit(at(2), "10.0.0.2")])
    runner.start_client_access(stream(spark, logs), table, first).awaitTermination()
    assert rebase.processed_files(spark, first).count() == 1
    partitions(16)
    logs.add([visit(at(2, 5)), visit(at(1, 7)), visit(at(3))])  # the second one is late
    runner.start_client_access(stream(spark, logs, first), table, second, earlier=first).awaitTermination()
    state = spark.read.format("state-metadata").load(second).select("numPartitions").first()[0]
    assert state == 16
    logs.add([visit(at(3, 2)), visit(at(5))])
    # A restart finds what was taken over, named or not, and does not take it twice.
    runner.start_client_access(stream(spark, logs, first), table, second).awaitTermination()
    closed = rows(table.read(spark))
    want = reports.client_access(lines.text_lines(spark, str(logs.path)))
    late = F.col("time_beg") == F.lit("2024-01-01 00:00:00")
    fixed = want.withColumn("client_access_cnt", F.col("client_access_cnt") - late.cast("long"))
    still = rows(open_windows.open_client_access(spark, second))
    assert sorted(closed + still) == rows(fixed) and len(still) == 1
    assert len(children(spark, f"{folder}/out")) == 2


def test_hot_pages_go_on(spark, folder, logs):
    dim = spark.createDataFrame([(t, f"s{t}") for t in range(1, 9)], schemas.ARTICLE_DIM)
    table, cfg = FileTable(f"{folder}/out", schemas.HOT_ARTICLE), JobConfig(hot_window="1 day", top_n=2)
    page = lambda t, d: visit(at(d), page=f"mod=viewthread&tid={t}")
    logs.add([page(1, 1), page(1, 1), page(2, 1), page(3, 2)])
    first, second = f"{folder}/cp1", f"{folder}/cp2"
    runner.start_hot_article(stream(spark, logs), dim, table, first, cfg).awaitTermination()
    logs.add([page(4, 2), page(4, 2), page(3, 2), page(3, 2), page(5, 3), page(1, 1), page(6, 4)])
    source = stream(spark, logs, first)
    runner.start_hot_article(source, dim, table, second, cfg, earlier=first).awaitTermination()
    found = [(r.article_id, r.article_pv, r.time_beg[:10]) for r in table.read(spark).collect()]
    assert sorted(found) == [(1, 2, "2024-01-01"), (2, 1, "2024-01-01"), (3, 3, "2024-01-02"), (4, 2, "2024-01-02"), (5, 1, "2024-01-03")]


def test_pages_only_and_a_query_that_never_ran(spark, folder, logs):
    cfg = JobConfig(forum_pages_only=True)
    table = FileTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
    assert rebase.processed_files(spark, f"{folder}/cp0").count() == 0
    logs.add([visit(at(1)), visit(at(1), page="mod=other")])
    for before, now in (("cp0", "cp1"), ("cp1", "cp2")):
        source = stream(spark, logs, f"{folder}/{before}")
        runner.start_client_access(
            source, table, f"{folder}/{now}", cfg, earlier=f"{folder}/{before}"
        ).awaitTermination()
        found = open_windows.open_client_access(spark, f"{folder}/{now}")
        assert [r[:2] for r in rows(found)] == [("10.0.0.1", 1)]
    logs.add([visit(at(3), page="mod=other")])
    runner.start_client_access(stream(spark, logs, f"{folder}/cp1"), table, f"{folder}/cp2", cfg).awaitTermination()
    assert [r[:2] for r in rows(table.read(spark))] == [("10.0.0.1", 1)]


def test_jobs_go_on_over_files_and_tailed_logs(spark, folder, logs):
    run = lambda *a: cli.run(spark, cli.parser().parse_args([*a]))
    for name, flag in (("files", "--text-stream"), ("tail", "--tail")):
        out, cps = f"{folder}/{name}", [f"{folder}/{name}{i}" for i in (1, 2)]
        args = ["client_access", flag, str(logs.path), "--available-now", "--out-files", out, "--checkpoint"]
        logs.add([visit(at(1)), visit(at(2))])
        run(*args, cps[0])
        had = logs.count
        logs.add([visit(at(2, 3)), visit(at(4))])
        run(*args, cps[1], "--earlier", cps[0])
        run(*args, cps[1], "--earlier", cps[0])
        table = FileTable(out, schemas.CLIENT_IP_ACCESS)
        whole = rows(reports.client_access(lines.text_lines(spark, str(logs.path))))
        still = rows(open_windows.open_client_access(spark, cps[1]))
        assert sorted(rows(table.read(spark)) + still) == whole, (name, had)


def test_topics_go_on(spark, folder):
    options = lines.kafka_options("b:1", ended='{"t": {"0": 5}}', consumer={"auto.offset.reset": "latest"})
    assert options["startingOffsets"] == '{"t": {"0": 5}}'
    assert rebase.source_position(spark, f"{folder}/none") is None
