"""Tables whose folders are committed by version, and tiles of visits in such a table."""

import threading
from datetime import datetime

import pytest
from test_streaming import at, rows, sections, visit

from pagetally import cli, schemas
from pagetally.config import JobConfig
from pagetally.manifest import Entry, Manifest
from pagetally.plans import reports, tiles
from pagetally.plans.reports import ARTICLE, SECTION
from pagetally.session import children, exists, read_text, write_new
from pagetally.sinks import Batch, SnapshotTable
from pagetally.sources import lines


def counts(spark, *found):
    return spark.createDataFrame([(c, n, "b", "e") for c, n in found], schemas.CLIENT_IP_ACCESS)


def test_files_are_written_once_and_whole(spark, folder):
    path = f"{folder}/deep/file"
    assert write_new(spark, path, "[\"é\"]") and not write_new(spark, path, "other")
    assert read_text(spark, path) == '["é"]'
    assert [p.rsplit("/", 1)[1] for p in children(spark, f"{folder}/deep")] == ["file"]


def test_writers_at_the_same_time_lose_nothing(spark, folder):
    manifest = Manifest(f"{folder}/table")
    assert manifest.entries(spark) == []
    add = lambda i: manifest.add(spark, f"data/{i}", f"/{i}")
    threads = [threading.Thread(target=add, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(e.key for e in manifest.entries(spark)) == [f"/{i}" for i in range(8)]
    with pytest.raises(RuntimeError):
        manifest.replace(spark, [Entry("data/99", "/99")], "data/x", "/x")
    assert len(manifest.entries(spark)) == 8


def test_a_replayed_batch_takes_the_place_of_its_first_try(spark, folder):
    table = SnapshotTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
    assert rows(table.read(spark)) == []
    table.write(counts(spark, ("a", 1)), Batch("q", 0))
    table.write(counts(spark, ("b", 2)), Batch("q", 1))
    table.write(counts(spark, ("b", 3), ("c", 1)), Batch("q", 1))
    table.write(counts(spark), Batch("q", 2))
    table.write(counts(spark, ("b", 9)), Batch("other", 1))
    assert [r[:2] for r in rows(table.read(spark))] == [("a", 1), ("b", 3), ("b", 9), ("c", 1)]
    assert [r[:2] for r in rows(table.read(spark, Batch("q", 0)))] == [("a", 1)]
    table.write(counts(spark), Batch("q", 1))
    assert [r[:2] for r in rows(table.read(spark))] == [("a", 1), ("b", 9)]
    assert len(table.manifest.entries(spark)) == 2


def test_readers_are_not_disturbed_by_a_rewrite(spark, folder):
    table = SnapshotTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
    for i in range(4):
        table.write(counts(spark, ("a", i)), Batch("q", i))
    table.write(counts(spark, ("p", 1)))
    table.write(counts(spark, ("p", 2)))
    begun, want = table.read(spark), rows(table.read(spark))
    half = table.manifest.new_folder()  # a rewrite that never commits
    counts(spark, ("x", 1)).write.parquet(f"{table.path}/{half}")
    assert rows(table.read(spark)) == want
    table.compact(spark)
    keys = sorted(e.key for e in table.manifest.entries(spark))
    assert len(keys) == 3 and keys[-2:] == ["q/2", "q/3"]  # the last one can still be replayed
    assert rows(begun) == rows(table.read(spark)) == want
    table.write(counts(spark, ("a", 7)), Batch("q", 3))
    assert [r[1] for r in rows(table.read(spark, Batch("q", 3)))] == [0, 1, 2, 7]
    old = [e.folder for e in table.manifest.entries(spark)]
    table.manifest.clean(spark, keep=1)
    assert all(exists(spark, f"{table.path}/{f}") for f in old)
    assert len(children(spark, f"{table.path}/_versions")) == 1
    assert len(children(spark, f"{table.path}/data")) == 3 + 1  # and the one that never counted


class Logs:
    def __init__(self, folder):
        self.folder, self.n = folder, 0

    def add(self, spark, texts):
        spark.createDataFrame([(t,) for t in texts], schemas.RAW_LINE).coalesce(1).write.mode("append").text(self.folder)


@pytest.fixture()
def logs(folder):
    return Logs(f"{folder}/logs")


def test_increments_read_only_new_files(spark, folder, logs):
    store = tiles.TileStore(f"{folder}/tiles")
    assert rows(tiles.client_access(spark, store)) == []
    logs.add(spark, [visit(at(1)), visit(at(1, 5)), visit(at(4))])
    assert store.add(spark, logs.folder + "/*.txt") == 1
    assert store.add(spark, logs.folder + "/*.txt") == 0
    first = set(spark.read.text(logs.folder).inputFiles())
    logs.add(spark, [visit(at(1, 5)), visit(at(2), "10.0.0.2", "mod=forumdisplay&fid=3")])
    files = store.new_files(spark, logs.folder + "/*.txt")
    read = set(store.new_lines(spark, files).inputFiles())
    assert len(read) == 1 and not read & first
    assert store.add(spark, logs.folder + "/*.txt") == 1
    raw = lines.text_lines(spark, logs.folder)
    assert rows(tiles.client_access(spark, store)) == rows(reports.client_access(raw))
    for cfg in (JobConfig(top_n=2), JobConfig(hot_window="1 day", window_start_time="16 hours")):
        dim = sections(spark)
        assert rows(tiles.top_pages(store, dim, SECTION, cfg)) == rows(reports.hot_section(raw, dim, cfg))
    cfg = JobConfig(client_window="6 hours", forum_pages_only=True, count_offset=1)
    assert rows(tiles.client_access(spark, store, cfg)) == rows(reports.client_access(raw, cfg))
    before = rows(tiles.client_access(spark, store))
    store.compact(spark)
    store.manifest.clean(spark, keep=1)
    assert len(store.manifest.entries(spark)) == 1 == len(children(spark, f"{store.path}/data"))
    assert rows(tiles.client_access(spark, store)) == before
    assert store.add(spark, logs.folder + "/*.txt") == 0
    per = store.tiles(spark, "client").groupBy("client", "hour").count()
    assert per.where("count > 1").isEmpty()


def test_a_file_that_has_changed_is_an_error(spark, folder):
    import os

    os.makedirs(f"{folder}/logs")
    path = f"{folder}/logs/a.txt"
    with open(path, "w") as file:
        file.write(visit(at(1)) + "\n")
    store = tiles.TileStore(f"{folder}/tiles")
    store.add(spark, f"{folder}/logs")
    with open(path, "a") as file:
        file.write(visit(at(1)) + "\n")
    with pytest.raises(ValueError, match="changed"):
        store.add(spark, f"{folder}/logs")
    assert store.tiles(spark, "client").count() == 1


def test_an_increment_that_fails_counts_nothing(spark, folder, logs, monkeypatch):
    store = tiles.TileStore(f"{folder}/tiles")
    logs.add(spark, [visit(at(1))])
    with monkeypatch.context() as broken:
        broken.setattr(Manifest, "add", lambda *a: (_ for _ in ()).throw(OSError("no space")))
        with pytest.raises(OSError):
            store.add(spark, logs.folder + "/*.txt")
    assert store.tiles(spark, "client").count() == 0
    assert store.add(spark, logs.folder + "/*.txt") == 1
    assert store.tiles(spark, "article").count() == store.tiles(spark, "client").count() == 1


def test_windows_of_tiles_are_whole_hours():
    assert tiles.whole_hours("3 days") == "72 hours"
    assert tiles.whole_hours("1 week 1 day 2 hours") == "194 hours"
    for width in ("90 minutes", "1 day 30 seconds", "", "x"):
        with pytest.raises(ValueError):
            tiles.whole_hours(width)


def test_tile_and_snapshot_jobs(spark, folder, logs):
    logs.add(spark, [visit(at(1)), visit(at(1, 2))])
    run = lambda *a: cli.run(spark, cli.parser().parse_args([*a]))
    run("count_tiles", "--text", f"{logs.folder}/*.txt", "--tiles", f"{folder}/tiles")
    logs.add(spark, [visit(at(1, 3))])
    run("count_tiles", "--text", f"{logs.folder}/*.txt", "--tiles", f"{folder}/tiles")
    out = ["--out-snapshots", f"{folder}/out"]
    run("client_access", "--tiles", f"{folder}/tiles", *out)
    run("client_access", "--tiles", f"{folder}/tiles", *out)
    run("compact", "--tiles", f"{folder}/tiles")
    run("compact", *out)
    table = SnapshotTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
    day = datetime(2024, 1, 1).strftime("%Y-%m-%d %H:%M:%S")
    assert [r[:3] for r in rows(table.read(spark))] == [("10.0.0.1", 3, day)] * 2
    assert len(table.manifest.entries(spark)) == 1
    dim = spark.createDataFrame([(1, "one")], schemas.ARTICLE_DIM)
    dim.write.parquet(f"{folder}/dim")
    run("hot_article", "--tiles", f"{folder}/tiles", "--dim-files", f"{folder}/dim", "--out-snapshots", f"{folder}/hot")
    assert [r[:3] for r in rows(SnapshotTable(f"{folder}/hot", schemas.HOT_ARTICLE).read(spark))] == [(1, "one", 3)]
    assert rows(tiles.page_report(tiles.TileStore(f"{folder}/tiles"), dim, ARTICLE))[0][2] == 3
