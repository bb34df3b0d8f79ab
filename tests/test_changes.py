"""Dimensions as streams of changes."""

import random

import pytest
from test_streaming import LogFolder, at, rows, visit

from pagetally import schemas
from pagetally.config import JobConfig
from pagetally.plans.reports import ARTICLE, SECTION
from pagetally.sinks import FileTable, SnapshotTable
from pagetally.sources import lines
from pagetally.streaming import changes


class Pages:
    """A folder of changes, and the table that follows it."""

    def __init__(self, spark, folder, kind=ARTICLE):
        self.spark, self.folder, self.kind = spark, f"{folder}/changes", kind
        self.schema = changes.change_schema(kind)
        self.table = SnapshotTable(f"{folder}/pages", self.schema)
        self.checkpoint = f"{folder}/cp-pages"

    def change(self, *found):
        self.spark.createDataFrame(list(found), self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        stream = self.spark.readStream.schema(self.schema).parquet(self.folder)
        changes.start_dimension(stream, self.kind, self.table, self.checkpoint).awaitTermination()

    def known(self):
        return dict(map(tuple, changes.names(self.spark, self.table, self.kind).collect()))


def test_newest_versions_in_any_order(spark, folder):
    pages = Pages(spark, folder)
    assert pages.known() == {}
    pages.change((1, "a", 1), (1, "b", 3), (2, "x", 1), (2, "y", 1), (0, "zero", 9), (-1, "below", 9), (None, "none", 1))
    assert pages.known() == {1: "b", 2: "y"}
    pages.change((1, "old", 2), (2, "", 2), (3, None, 1), (4, "d", 1))
    assert pages.known() == {1: "b", 4: "d"}
    pages.change((2, "back", 3), (4, None, 2))
    assert pages.known() == {1: "b", 2: "back"}


def test_versions_equal_a_full_read_and_compaction_keeps_them(spark, folder):
    rnd, pages, want = random.Random(1), Pages(spark, folder, SECTION), {}
    for _ in range(4):
        found = [(rnd.randrange(1, 9), rnd.choice(["a", "b", "", None]), rnd.randrange(50)) for _ in range(20)]
        pages.change(*found)
        for i, name, version in found:
            want[i] = max(want.get(i, (-1, "")), (version, name or ""))
    known = {i: name for i, (_, name) in want.items() if name}
    assert pages.known() == known
    changes.compact(spark, pages.table, SECTION)
    pages.table.manifest.clean(spark, keep=1)
    assert len(pages.table.manifest.entries(spark)) == 2 and pages.known() == known
    pages.change((1, "new", 99))
    assert pages.known() == {**known, 1: "new"}


@pytest.fixture()
def logs(folder):
    return LogFolder(f"{folder}/logs")


def test_a_running_report_follows_changes(spark, folder, logs):
    """A title edited, a page created and one removed while the report runs; one counter each."""
    pages, table = Pages(spark, folder), FileTable(f"{folder}/out", schemas.HOT_ARTICLE)
    cfg = JobConfig(hot_window="1 day", top_n=3)
    page = lambda t, d: visit(at(d), page=f"mod=viewthread&tid={t}")
    pages.change((1, "one", 1), (2, "two", 1))
    logs.add([page(1, 1), page(2, 1), page(3, 1), page(1, 2)])
    stream = lines.text_line_stream(spark, str(logs.path))
    query = changes.start_hot_pages(
        stream, ARTICLE, pages.table, table, f"{folder}/cp", cfg, {"processingTime": "100 milliseconds"}
    )
    query.processAllAvailable()
    found = lambda: sorted((r.time_beg[8:10], r.article_id, r.subject, r.article_pv) for r in table.read(spark).collect())
    assert found() == [("01", 1, "one", 1), ("01", 2, "two", 1)]
    pages.change((1, "one, edited", 2), (2, None, 2), (3, "three", 1))
    logs.add([page(1, 2), page(2, 2), page(3, 2), page(9, 3)])
    query.processAllAvailable()
    query.stop()
    assert found()[2:] == [("02", 1, "one, edited", 2), ("02", 3, "three", 1)]
    assert rows(table.read(spark).where("subject is null")) == []
