"""Open windows from the state of a query, while it runs and between two starts."""

from datetime import datetime

import pytest
from test_streaming import LogFolder, at, rows, visit

from pagetally import cli, schemas
from pagetally.config import JobConfig
from pagetally.plans.reports import ARTICLE
from pagetally.sinks import FileTable
from pagetally.sources import lines
from pagetally.streaming import open_windows, runner

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture()
def logs(folder):
    return LogFolder(f"{folder}/logs")


def day(n):
    return f"{datetime(2024, 1, n):%Y-%m-%d %H:%M:%S}"


def client(name, n, d):
    return (name, n, day(d), day(d + 1))


def test_open_windows_of_a_running_query(spark, folder, logs):
    checkpoint, table = f"{folder}/cp", FileTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
    assert rows(open_windows.open_client_access(spark, checkpoint)) == []
    logs.add([visit(at(1)), visit(at(1, 5)), visit(at(2), "10.0.0.2")])
    stream = lines.text_line_stream(spark, str(logs.path))
    query = runner.start_client_access(
        stream, table, checkpoint, trigger={"processingTime": "100 milliseconds"}
    )
    query.processAllAvailable()
    so_far = lambda: rows(open_windows.client_access_so_far(spark, table, checkpoint))
    assert rows(table.read(spark)) == [client("10.0.0.1", 2, 1)]
    assert rows(open_windows.open_client_access(spark, checkpoint)) == [client("10.0.0.2", 1, 2)]
    assert so_far() == [client("10.0.0.1", 2, 1), client("10.0.0.2", 1, 2)]
    logs.add([visit(at(2, 7), "10.0.0.2"), visit(at(2, 8))])
    query.processAllAvailable()
    assert so_far() == [client("10.0.0.1", 1, 2), client("10.0.0.1", 2, 1), client("10.0.0.2", 2, 2)]
    query.stop()
    logs.add([visit(at(4), "10.0.0.3")])
    stream = lines.text_line_stream(spark, str(logs.path))
    runner.start_client_access(stream, table, checkpoint).awaitTermination()
    assert rows(open_windows.open_client_access(spark, checkpoint)) == [client("10.0.0.3", 1, 4)]
    assert len(so_far()) == 4


def test_state_and_results_are_of_one_batch(spark, folder, logs):
    """As of an earlier micro-batch its windows are open, and results of later ones are left out."""
    checkpoint, table = f"{folder}/cp", FileTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
    for n in (1, 2, 3):
        logs.add([visit(at(n))])
        stream = lines.text_line_stream(spark, str(logs.path))
        runner.start_client_access(stream, table, checkpoint).awaitTermination()
    last = open_windows.last_batch(spark, checkpoint)
    found = []
    for n in range(last.id + 1):
        batch = last._replace(id=n)
        closed = rows(table.read(spark, batch))
        still = rows(open_windows.open_client_access(spark, checkpoint, batch=batch))
        assert not set(closed) & set(still)
        found.append(len(closed) + len(still))
    assert found == sorted(found) and found[0] == 1 and found[-1] == 3


def test_open_pages_have_their_names_and_rank(spark, folder, logs):
    logs.add([visit(at(1), page=f"mod=viewthread&tid={t}") for t in (7, 7, 8, 9, 9, 9, 100_000)])
    dim = spark.createDataFrame([(7, "seven"), (8, "eight"), (9, "nine")], schemas.ARTICLE_DIM)
    table, cfg = FileTable(f"{folder}/out", schemas.HOT_ARTICLE), JobConfig(top_n=2)
    stream = lines.text_line_stream(spark, str(logs.path))
    runner.start_hot_article(stream, dim, table, f"{folder}/cp", cfg).awaitTermination()
    assert rows(table.read(spark)) == []
    renamed = spark.createDataFrame([(9, "new"), (8, "eight")], schemas.ARTICLE_DIM)
    got = rows(open_windows.open_pages(spark, f"{folder}/cp", renamed, ARTICLE, cfg))
    start = got[0][3]
    assert [r[:3] for r in got] == [(7, None, 2), (9, "new", 3)] and start <= day(1)


def test_state_of_another_provider_is_read(spark, folder, logs):
    """The provider comes from the checkpoint, whatever the session that reads has set."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    logs.add([visit(at(1))])
    spark.conf.set(key, ROCKS)
    try:
        stream = lines.text_line_stream(spark, str(logs.path))
        table = FileTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
        runner.start_client_access(stream, table, f"{folder}/cp").awaitTermination()
    finally:
        spark.conf.set(key, before)
    assert rows(open_windows.open_client_access(spark, f"{folder}/cp")) == [client("10.0.0.1", 1, 1)]


def test_open_jobs(spark, folder, logs):
    logs.add([visit(at(1)), visit(at(1, 3))])
    cp = ["--checkpoint", f"{folder}/cp"]
    run = lambda *a: cli.run(spark, cli.parser().parse_args([*a]))
    run("client_access", "--text-stream", str(logs.path), "--available-now", "--out-files", f"{folder}/out", *cp)
    run("open_client_access", "--out-files", f"{folder}/open", *cp)
    found = FileTable(f"{folder}/open", schemas.CLIENT_IP_ACCESS).read(spark)
    assert rows(found) == [client("10.0.0.1", 2, 1)]
    spark.createDataFrame([(1, "one")], schemas.ARTICLE_DIM).write.parquet(f"{folder}/dim")
    run("hot_article", "--text-stream", str(logs.path), "--available-now", "--out-files", f"{folder}/hot",
        "--dim-files", f"{folder}/dim", "--checkpoint", f"{folder}/cp2")
    run("open_hot_article", "--dim-files", f"{folder}/dim", "--out-files", f"{folder}/open_hot", "--checkpoint", f"{folder}/cp2")
    assert [r[2] for r in rows(FileTable(f"{folder}/open_hot", schemas.HOT_ARTICLE).read(spark))] == [2]
    for wrong in (["open_client_access", "--out-console"], ["client_access", "--out-console"]):
        with pytest.raises(SystemExit):
            run(*wrong)
