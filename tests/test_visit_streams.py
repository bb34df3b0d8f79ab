"""Visits of a stream, late ones apart: every visit is counted or late."""

import pytest
from pyspark.sql import functions as F
from test_streaming import LogFolder, at, rows, visit

from pagetally import schemas
from pagetally.config import JobConfig
from pagetally.plans import reports
from pagetally.session import children, delete
from pagetally.sinks import FileTable
from pagetally.sources import lines
from pagetally.streaming import open_windows, runner, visits


@pytest.fixture()
def logs(folder):
    return LogFolder(f"{folder}/logs")


def land(spark, folder, logs, cfg=JobConfig(), **more):
    stream = lines.text_line_stream(spark, str(logs.path), max_files_per_trigger=1)
    visits.start_visits(stream, f"{folder}/v", f"{folder}/cp", cfg=cfg, **more).awaitTermination()


def late(spark, folder):
    return sorted((r.event_time, r.batch_id) for r in visits.late_visits(spark, f"{folder}/v").collect())


def test_late_visits_are_those_of_ended_windows(spark, folder, logs):
    assert late(spark, folder) == []
    logs.add([visit(at(2)), visit(at(1))])  # one micro-batch: not late
    logs.add([visit(at(1, 23)), visit(at(2, 1)), visit(at(3))])
    logs.add(["no record"])
    logs.add([visit(at(2, 23)), visit(at(3, 1))])
    land(spark, folder, logs)
    assert late(spark, folder) == [(at(1, 23), 1), (at(2, 23), 3)]
    logs.add([visit(at(1))])
    land(spark, folder, logs)
    assert late(spark, folder) == [(at(1), 4), (at(1, 23), 1), (at(2, 23), 3)]


@pytest.mark.parametrize(
    "cfg, width, want",
    [
        (JobConfig(watermark_delay="1 day"), None, []),
        (JobConfig(), "3 days", []),
        (JobConfig(window_start_time="16 hours"), None, []),
        (JobConfig(window_start_time="8 hours"), None, [(at(1, 7), 1)]),
    ],
)
def test_delay_width_and_start_decide(spark, folder, logs, cfg, width, want):
    logs.add([visit(at(2))])
    logs.add([visit(at(1, 7 if cfg.window_start_time == "8 hours" else 23))])
    land(spark, folder, logs, cfg, width=width)
    assert late(spark, folder) == want


def test_counted_and_late_are_all_visits(spark, folder, logs):
    for day in (1, 3, 2, 4, 1, 6, 5, 4):
        logs.add([visit(at(day, h), f"10.0.0.{h % 3}") for h in range(5)])
    table = FileTable(f"{folder}/out", schemas.CLIENT_IP_ACCESS)
    land(spark, folder, logs)
    for _ in range(2):
        stream = visits.visit_stream(spark, f"{folder}/v")
        query = visits.start_client_access(stream, table, f"{folder}/cp-report")
        query.awaitTermination()
        dropped = [s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators]
        assert sum(dropped) == 0
    still = open_windows.open_client_access(spark, f"{folder}/cp-report")
    every = table.read(spark).unionByName(still).unionByName(visits.corrections(spark, f"{folder}/v"))
    every = every.groupBy("client", "time_beg", "time_end").agg(F.sum("client_access_cnt").alias("n"))
    whole = reports.client_access(lines.text_lines(spark, str(logs.path)))
    assert rows(every.select("client", "n", "time_beg", "time_end")) == rows(whole)
    assert len(late(spark, folder)) == 20


def test_a_micro_batch_that_is_tried_again_is_stored_once(spark, folder, logs, monkeypatch):
    """Stopped after its folder was there, but before that was noted."""
    logs.add([visit(at(1))])
    logs.add([visit(at(3))])
    logs.add([visit(at(1)), visit(at(4))])

    def stop(spark, path, text, kept=visits.write_new):
        if path.endswith("greatest/1"):
            raise OSError("stopped")
        return kept(spark, path, text)

    with monkeypatch.context() as broken:
        broken.setattr(visits, "write_new", stop)
        with pytest.raises(Exception, match="stopped"):
            land(spark, folder, logs)
    assert len(children(spark, f"{folder}/v/visits")) == 2
    before = set(spark.read.parquet(f"{folder}/v/visits").inputFiles())
    land(spark, folder, logs)
    assert before <= set(spark.read.parquet(f"{folder}/v/visits").inputFiles())
    assert spark.read.parquet(f"{folder}/v/visits").count() == 4
    assert late(spark, folder) == [(at(1), 2)]
    # The checkpoint lost: the same micro-batches come again and are known.
    delete(spark, f"{folder}/cp")
    land(spark, folder, logs)
    assert spark.read.parquet(f"{folder}/v/visits").count() == 4
    assert runner.AVAILABLE_NOW == {"availableNow": True}
