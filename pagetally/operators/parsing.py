"""Raw lines to parsed records to visits. Every function maps a DataFrame, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import patterns as P

_COMMON = {
    "client_ip": 1,
    "identity": 2,
    "remote_user": 3,
    "date_time": 4,
    "request": 5,
    "status": 7,
    "bytes": 8,
}
_COMBINED = {**_COMMON, "referer": 10, "user_agent": 12}


# The same matches as those of the patterns for lines, in time that grows with the line only.
#
# What stands before a date is settled by the place where it begins. The date ends at the first
# `] "` after its bracket, the request at the first quote after that which a status and a size
# follow, and the referer at the first quote, blank, quote. If one of these is missing for the
# first place where a record could begin, it is missing for all later ones, which look for it in
# less of the line. So every part is atomic, and no other place is tried. Line ends, which `.` does
# not match, would break that: text with one of them goes through the plain patterns.
_BEFORE = r"^(?>(?s:.*?)(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}) (\S+) (\S+) (?=\[))"
_DATED = _BEFORE + r"(?>(\[.+?\]) (?=\"))"
_LINEAR_LINE = _DATED + r"(?>(\"(.*?)\") (?=\d{3} \S))(\d{3}) (\S+)"
_LINEAR_COMBINED = (
    _DATED
    + r"(?>(\"(.*?)\") (?=\d{3} \S+ \"))(\d{3}) (\S+)"
    + r" (?>(\"(.*?)\") (?=\"))(\"(.*?)\")"
)
_LINEAR = {P.LOG_LINE: _LINEAR_LINE, P.COMBINED_LINE: _LINEAR_COMBINED}
_LINE_ENDS = "[\n\r\u0085\u2028\u2029]"


def _by_line_ends(plain: Column, linear: Column) -> Column:
    return F.when(F.col("value").rlike(_LINE_ENDS), plain).otherwise(linear)


def _matched(lines: DataFrame, pattern: str, groups: dict[str, int]) -> DataFrame:
    """Columns for the wanted groups of the first match in each line; other lines drop out.

    One replace packs the groups of the first match, each ended by a newline, so that a pattern
    runs once per line however many fields are read. This is exact:

    * no group can hold a newline, because neither `.` nor `\\S` matches one;
    * the lazy prefix is anchored at the start, so only the first match is replaced;
    * packed text equals the line only where nothing matched: a match begins with at least
      seven characters free of newlines, where packed text ends its first field.
    """
    replacement = "".join(f"${g}\n" for g in groups.values())
    pack = lambda pattern: F.regexp_replace("value", pattern, replacement)
    packed = C.once(
        lines.select("value"),
        "_packed",
        _by_line_ends(pack(r"(?s:^.*?)" + pattern), pack(_LINEAR[pattern])),
    ).where(F.col("_packed") != F.col("value"))
    fields = C.once(
        packed.select("_packed"), "_fields", F.split("_packed", "\n", len(groups) + 1)
    )
    return fields.select(*[F.col("_fields")[i].alias(n) for i, n in enumerate(groups)])


def parse_lines(lines: DataFrame, combined: bool = False) -> DataFrame:
    """Log records among the lines; text before or after a record is allowed."""
    if combined:
        return _matched(lines, P.COMBINED_LINE, _COMBINED)
    return _matched(lines, P.LOG_LINE, _COMMON)


def rejected_lines(lines: DataFrame, honor_offset: bool = False) -> DataFrame:
    """The lines that yield no visit for a formal reason, with that reason.

    `no_record`: not a log line. `bad_date`: a log line without a valid date. Log lines
    with another status than 200 are valid records and not listed.
    """
    date = lambda pattern: F.regexp_extract("value", pattern, 4)
    found = F.coalesce(_by_line_ends(date(P.LOG_LINE), date(_LINEAR_LINE)), F.lit(""))
    dated = C.once(lines.select("value"), "_date_time", found)
    no_date = C.event_time(F.col("_date_time"), honor_offset).isNull()
    reason = F.when(F.col("_date_time") == "", "no_record").when(no_date, "bad_date")
    checked = C.once(dated, "reason", reason).drop("_date_time")
    return checked.where(F.col("reason").isNotNull())


def successful(records: DataFrame) -> DataFrame:
    return records.where(F.col("status") == P.STATUS_OK)


def parsed_dates(records: DataFrame, honor_offset: bool = False) -> DataFrame:
    """Records with a valid date, as `event_time`, its text, and epoch milliseconds."""
    timed = C.once(records, "event_time", C.event_time(F.col("date_time"), honor_offset))
    return timed.where(F.col("event_time").isNotNull()).select(
        "*",
        C.time_text(F.col("event_time")).alias("event_time_text"),
        F.unix_millis("event_time").alias("event_ms"),
    )


def page_ids(records: DataFrame) -> DataFrame:
    request = F.col("request")
    return records.select(
        "*",
        C.page_id(request, P.SECTION_PAGE).alias("section_id"),
        C.page_id(request, P.ARTICLE_PAGE).alias("article_id"),
    )


def request_parts(records: DataFrame) -> DataFrame:
    """Method, URI and version without the quotes; NULL unless there are exactly three."""
    bare = F.regexp_extract("request", r'^"(.*)"$', 1)
    return records.select(
        "request",
        C.request_part(bare, 0).alias("method"),
        C.request_part(bare, 1).alias("uri"),
        C.request_part(bare, 2).alias("version"),
    )


def visit_facts(lines: DataFrame, honor_offset: bool = False) -> DataFrame:
    """Successful requests with a valid date: client_ip, event_time, section_id, article_id.

    Visits of other pages keep the ids 0/0, they count for the client report. A line without
    `" 200 ` holds no successful record, so a plain text test spares it the pattern.
    """
    maybe_ok = lines.where(F.col("value").contains(f'" {P.STATUS_OK} '))
    wanted = {n: _COMMON[n] for n in ("client_ip", "date_time", "request", "status")}
    ok = successful(_matched(maybe_ok, P.LOG_LINE, wanted))
    timed = C.once(ok, "event_time", C.event_time(F.col("date_time"), honor_offset))
    return page_ids(timed.where(F.col("event_time").isNotNull())).select(
        "client_ip", "event_time", "section_id", "article_id"
    )
