"""Log files that grow, are rotated and cut, as a stream of their finished lines."""

import io
import os
import random
from collections import Counter

import pytest

from pagetally import cli
from pagetally.sources import tailing
from pagetally.streaming import runner


class Log:
    def __init__(self, folder):
        self.folder = f"{folder}/logs"
        os.mkdir(self.folder)

    def add(self, text, name="access_log"):
        with open(f"{self.folder}/{name}", "ab") as file:
            file.write(text if isinstance(text, bytes) else text.encode())

    def rename(self, old, new):
        os.rename(f"{self.folder}/{old}", f"{self.folder}/{new}")


@pytest.fixture()
def log(folder):
    return Log(folder)


def start(spark, folder, trigger=runner.AVAILABLE_NOW, **options):
    stream = tailing.tailed_lines(spark, f"{folder}/logs", **options)
    return runner.land_raw_logs(stream, f"{folder}/out", f"{folder}/cp", trigger)


def landed(spark, folder):
    return Counter(r.value for r in spark.read.parquet(f"{folder}/out").collect())


def test_a_file_that_grows_between_triggers(spark, folder, log):
    log.add("one\ntwo\nhal")
    log.add("no line yet", "other")
    query = start(spark, folder, {"processingTime": "100 milliseconds"})
    query.processAllAvailable()
    assert landed(spark, folder) == Counter(["one", "two"])
    log.add("f\r\n\nfive\n")
    query.processAllAvailable()
    assert landed(spark, folder) == Counter(["one", "two", "half", "", "five"])
    log.add("\n", "other")
    query.processAllAvailable()
    query.stop()
    assert landed(spark, folder) == Counter(["one", "two", "half", "", "five", "no line yet"])


def test_rotation_and_restart(spark, folder, log):
    log.add("first\nsecond\nthi")
    start(spark, folder).awaitTermination()
    log.add("rd\nfourth\n")
    log.rename("access_log", "access_log.1")
    log.add("fifth\nsixth\n")
    log.add("seventh\n", "access_log.1")  # a writer that still has the old file open
    log.add(b"\x1f\x8b packed\n", "access_log.2.gz")
    start(spark, folder).awaitTermination()
    want = Counter(["first", "second", "third", "fourth", "fifth", "sixth", "seventh"])
    assert landed(spark, folder) == want
    start(spark, folder).awaitTermination()
    assert landed(spark, folder) == want
    log.rename("access_log", "access_log.2")
    start(spark, folder).awaitTermination()
    assert landed(spark, folder) == want


def test_a_file_that_is_cut_begins_anew(spark, folder, log):
    log.add("first of the day\nx\ny\n")
    start(spark, folder).awaitTermination()
    with open(f"{log.folder}/access_log", "r+b") as file:
        file.truncate(0)
    log.add("first of the next day\nx\n")
    start(spark, folder).awaitTermination()
    assert landed(spark, folder) == Counter(["first of the day", "x", "y", "first of the next day", "x"])


def test_patterns_and_bytes_that_are_no_text(spark, folder, log):
    log.add(b"caf\xc3\xa9 \xff\n")
    log.add("not this\n", "error_log")
    log.add("nor this\n", ".access_log")
    start(spark, folder, pattern="*access_log").awaitTermination()
    assert landed(spark, folder) == Counter(["café �"])


def test_ranges_have_every_line_once(spark, folder, log):
    rnd = random.Random(1)
    texts = ["x" * rnd.randrange(40) + str(i) for i in range(400)]
    log.add("".join(t + "\n" for t in texts) + "open")
    query = start(spark, folder, bytes_per_task=100)
    query.awaitTermination()
    assert landed(spark, folder) == Counter(texts)
    reader = tailing.TailReader({"path": log.folder, "bytespertask": "100"})
    ranges = reader.partitions({}, reader.latestOffset())
    assert len(ranges) == -(-sum(len(t) + 1 for t in texts) // 100)
    assert max(r.end - r.begin for r in ranges) == 100


@pytest.mark.parametrize("width", [1, 3, 7, 1000])
def test_lines_from_cover_a_text_once(width):
    text = b"\n\na\nbcd\r\n\nefghij\nk\n"
    file = io.BytesIO(text)
    got = [x for a in range(0, len(text), width) for x in tailing.lines_from(file, a, min(a + width, len(text)))]
    assert got == [b"", b"", b"a", b"bcd", b"", b"efghij", b"k"]


def test_last_newline_is_found_over_blocks():
    file = io.BytesIO(b"a\n" + b"b" * (3 * tailing.BLOCK))
    size = len(file.getvalue())
    assert tailing.whole_lines(file, 0, size) == 2
    assert tailing.whole_lines(file, 2, size) is None


def test_a_file_that_is_gone_fails_loudly(folder, log):
    log.add("one\n")
    reader = tailing.TailReader({"path": log.folder})
    (part,) = reader.partitions({}, reader.latestOffset())
    log.rename("access_log", "moved")
    assert next(reader.read(part)).to_pylist() == [{"value": "one"}]
    os.remove(f"{log.folder}/moved")
    with pytest.raises(FileNotFoundError):
        next(reader.read(part))
    for _ in range(tailing.MISSING):
        assert len(reader.latestOffset()) == 1
    assert reader.latestOffset() == {}


def test_folders(folder):
    assert tailing.local_path("/var/log") == tailing.local_path("file:///var/log") == "/var/log"
    with pytest.raises(ValueError):
        tailing.local_path("hdfs://logs")


def test_landing_job_tails(spark, folder, log):
    log.add("one\ntw")
    args = ["land_raw_logs", "--tail", log.folder, "--tail-pattern", "access*", "--available-now"]
    args += ["--out-files", f"{folder}/out", "--checkpoint", f"{folder}/cp"]
    cli.run(spark, cli.parser().parse_args(args))
    assert landed(spark, folder) == Counter(["one"])
