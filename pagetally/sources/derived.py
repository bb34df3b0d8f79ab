"""Log lines and dimensions derived from general-purpose tables, for queries and benchmarks.

The lines carry every case the parser knows: section, article and other pages, failed
requests, text that is no record, dates without a zone, requests of four parts, page ids
beyond INT, both log formats, and referers whose page id must not be counted.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import once
from .tailing import local_path


def _address(key: str) -> str:
    """Client address that encodes the low 32 bits of a numeric key."""
    return (
        f"concat({key} div 16777216 % 256, '.', {key} div 65536 % 256, '.', "
        f"{key} div 256 % 256, '.', {key} % 256)"
    )


_FORUM_LINE = f"""
case when k = 99 then concat('malformed ', event_id)
else concat(
  {_address('user_id')}, ' - - [', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'),
  case when k = 96 then '' when event_type = 'purchase' then ' +0800' else ' +0000' end,
  '] "GET /forum.php', case when k = 98 then ' x' else '' end, '?mod=',
  case when k = 97 then 'forumdisplay&fid=99999999999'
       when event_type = 'click' then concat('forumdisplay&fid=', k div 3)
       when event_type in ('view', 'purchase')
         then concat('viewthread&tid=', user_id * 10 + k div 10, '&extra=page%3D1')
       else 'ajax&action=forumchecknew&fid=1' end,
  ' HTTP/1.1" ', case when event_type = 'error' then '404' else '200' end, ' ',
  case when event_type = 'signup' then '-' else cast(cast(value as bigint) as string) end,
  case when k < 50
    then concat(' "http://forum.example.com/forum.php?mod=forumdisplay&fid=41" "agent ', k, '"')
    else '' end)
end
"""


def _lines(table: DataFrame, expr: str) -> DataFrame:
    return once(table, "_line", F.expr(expr)).select(F.col("_line").alias("value"))


def forum_lines(events: DataFrame) -> DataFrame:
    """One line per event; works on a batch or a stream of events."""
    keyed = events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "ts",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )
    return _lines(keyed, _FORUM_LINE)


def shop_lines(lineitem: DataFrame) -> DataFrame:
    """One line per item sold: the supplier visits the article page of the part."""
    line = f"""concat(
      {_address('l_suppkey')}, ' - - [', date_format(l_shipdate, 'dd/MMM/yyyy:HH:mm:ss'),
      ' +0000] "GET /forum.php?mod=',
      case when l_returnflag = 'N' then concat('forumdisplay&fid=', l_linenumber)
           else concat('viewthread&tid=', l_partkey + 1) end,
      ' HTTP/1.1" ', case when l_returnflag = 'A' and l_linestatus = 'O' then '304' else '200' end,
      ' ', cast(l_extendedprice as bigint))"""
    return _lines(lineitem, line)


def crawl_lines(pages: DataFrame) -> DataFrame:
    """One combined-format line per web page, with its URL as request and as referer."""
    line = f"""concat(
      {_address('page_id')}, ' - - [',
      date_format(timestamp_seconds(1704067200 + page_id), 'dd/MMM/yyyy:HH:mm:ss'),
      ' +0000] "GET ', regexp_replace(url, '^https?://[^/]+', ''), ' HTTP/1.1" 200 ',
      length(html), ' "', url, '" "crawler/', page_id, '"')"""
    return _lines(pages, line)


def prose_lines(documents: DataFrame) -> DataFrame:
    """Every line of every document: text among which records have to be found."""
    return documents.select(F.explode(F.split("text", "\n")).alias("value"))


def section_table(nation: DataFrame) -> DataFrame:
    """Nations as sections, numbered from 1: id 0 means that a visit has no section."""
    fid = (F.col("n_nationkey") + 1).cast("int").alias("fid")
    return nation.select(fid, F.col("n_name").alias("name"))


def article_table(part: DataFrame) -> DataFrame:
    """Parts as articles, numbered from 1: small ones have an empty subject, and each id comes twice."""
    tid = (F.col("p_partkey") + 1).cast("int").alias("tid")
    subject = F.when(F.col("p_size") <= 5, "").otherwise(F.col("p_name"))
    second = F.when(F.col("p_size") <= 5, "").otherwise(F.concat_ws(" ", "p_name", "p_brand"))
    return part.select(tid, F.explode(F.array(subject, second)).alias("subject"))


def write_server_logs(stored: DataFrame, folder: str, grown: bool) -> None:
    """Stored lines as the logs of servers in a mounted folder, one server for each partition.

    First every other line and half of the next one, which is not ended; then, `grown`, the rest of
    that line, a rotation, and the other lines in a new file. A task that is tried again writes the
    same bytes to the same places.
    """
    folder = local_path(folder)
    os.makedirs(folder, exist_ok=True)

    def write(rows: Iterator) -> None:
        log, first, size = f"{folder}/server-{TaskContext.get().partitionId()}.log", b"", 0
        if grown and not os.path.exists(f"{log}.1"):
            os.rename(log, f"{log}.1")
        with open(log, "wb") as file:
            for i, row in enumerate(rows):
                line = row.value.encode() + b"\n"
                first = line if i == 1 else first
                size += len(line) if i % 2 == 0 else 0
                if i % 2 == 0 and not grown or i % 2 and i > 1 and grown:
                    file.write(line)
            if not grown:
                file.write(first[: len(first) // 2])
        if grown:
            with open(f"{log}.1", "r+b") as file:
                file.truncate(size + len(first) // 2)
                file.seek(0, os.SEEK_END)
                file.write(first[len(first) // 2 :])

    stored.foreachPartition(write)
