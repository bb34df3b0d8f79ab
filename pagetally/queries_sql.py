"""The same queries in DuckDB SQL, written independently over the same tables."""

from __future__ import annotations

from .functions import patterns as P


def _address(key: str) -> str:
    return (
        f"concat({key} // 16777216 % 256, '.', {key} // 65536 % 256, '.', "
        f"{key} // 256 % 256, '.', {key} % 256)"
    )


_FORUM = f"""
select case when k = 99 then concat('malformed ', event_id)
else concat(
  {_address('user_id')}, ' - - [', strftime(ts, '%d/%b/%Y:%H:%M:%S'),
  case when k = 96 then '' when event_type = 'purchase' then ' +0800' else ' +0000' end,
  '] "GET /forum.php', case when k = 98 then ' x' else '' end, '?mod=',
  case when k = 97 then 'forumdisplay&fid=99999999999'
       when event_type = 'click' then concat('forumdisplay&fid=', k // 3)
       when event_type in ('view', 'purchase')
         then concat('viewthread&tid=', user_id * 10 + k // 10, '&extra=page%3D1')
       else 'ajax&action=forumchecknew&fid=1' end,
  ' HTTP/1.1" ', case when event_type = 'error' then '404' else '200' end, ' ',
  case when event_type = 'signup' then '-' else cast(cast(trunc(value) as bigint) as varchar) end,
  case when k < 50
    then concat(' "http://forum.example.com/forum.php?mod=forumdisplay&fid=41" "agent ', k, '"')
    else '' end)
end as value
from (select *, cast(regexp_extract(props, '[0-9]+') as integer) as k from events)
"""

_SHOP = f"""
select concat(
  {_address('l_suppkey')}, ' - - [', strftime(l_shipdate, '%d/%b/%Y:%H:%M:%S'),
  ' +0000] "GET /forum.php?mod=',
  case when l_returnflag = 'N' then concat('forumdisplay&fid=', l_linenumber)
       else concat('viewthread&tid=', l_partkey + 1) end,
  ' HTTP/1.1" ', case when l_returnflag = 'A' and l_linestatus = 'O' then '304' else '200' end,
  ' ', cast(trunc(l_extendedprice) as bigint)) as value
from lineitem
"""

_CRAWL = f"""
select concat(
  {_address('page_id')}, ' - - [',
  strftime(to_timestamp(1704067200 + page_id) at time zone 'UTC', '%d/%b/%Y:%H:%M:%S'),
  ' +0000] "GET ', regexp_replace(url, '^https?://[^/]+', ''), ' HTTP/1.1" 200 ',
  length(html), ' "', url, '" "crawler/', page_id, '"') as value
from pages
"""

_MIXED = f"""
{_FORUM}
union all
select unnest(string_split(text, chr(10))) as value from documents
"""

_SECTIONS = "select n_nationkey + 1 as fid, max(n_name) as name from nation group by 1"
_ARTICLES = """
select tid, max(subject) as subject from (
  select cast(p_partkey + 1 as integer) as tid, p_name as subject from part where p_size > 5
  union all
  select cast(p_partkey + 1 as integer), concat(p_name, ' ', p_brand) from part where p_size > 5)
where subject <> '' group by 1
"""

_RECORD_COLUMNS = "r.client_ip, r.identity, r.remote_user, r.date_time, r.request, r.status, r.bytes"
_GROUPS = "['client_ip','identity','remote_user','date_time','request','bare','status','bytes'"


def _records(lines: str, combined: bool = False) -> str:
    pattern = P.COMBINED_LINE if combined else P.LOG_LINE
    groups = _GROUPS + (",'q1','referer','q2','user_agent']" if combined else "]")
    columns = _RECORD_COLUMNS + (", r.referer, r.user_agent" if combined else "")
    return (
        f"select {columns} from (select regexp_extract(value, '{pattern}', {groups}) as r "
        f"from ({lines}) where regexp_matches(value, '{pattern}'))"
    )


_DATE = f"try_strptime(regexp_extract(date_time, '{P.DATE_IN_BRACKETS}', 1), '%d/%b/%Y:%H:%M:%S')"
_SHIFT = """(case when date_time like '%-____]' then -1 else 1 end
  * (cast(regexp_extract(date_time, '[+-](\\d\\d)(\\d\\d)]', 1) as integer) * 60
     + cast(regexp_extract(date_time, '[+-](\\d\\d)(\\d\\d)]', 2) as integer)))"""
_ZONED = f"({_DATE} - to_minutes({_SHIFT}))"


def _id(pattern: str) -> str:
    return (
        "case when len(string_split(request, ' ')) = 3 then coalesce(try_cast(nullif("
        f"regexp_extract(string_split(request, ' ')[2], '{pattern}', 2), '') as bigint), 0) "
        "else cast(0 as bigint) end"
    )


_IDS = f"{_id(P.SECTION_PAGE)} as section_id, {_id(P.ARTICLE_PAGE)} as article_id"


def _visits(lines: str, time: str = _DATE) -> str:
    dated = f"{_DATE} is not null and status = '200'"
    return (
        f"select client_ip, {time} as event_time, {_IDS} from ({_records(lines)}) where {dated}"
    )


_VISITS = _visits(_FORUM)
_TEXT = "'%Y-%m-%d %H:%M:%S'"


def _bucket(days: int, shift_hours: int = 0) -> str:
    width, shift = days * 86_400_000_000, shift_hours * 3_600_000_000
    return f"make_timestamp((epoch_us(event_time) - {shift}) // {width} * {width} + {shift})"


def _bounds(days: int) -> str:
    return (
        f"strftime(w, {_TEXT}) as time_beg, "
        f"strftime(w + interval {days} day, {_TEXT}) as time_end"
    )


def _page_visits(visits: str, kind: str) -> str:
    if kind == "section":
        return (
            f"select section_id, name, event_time from ({visits}) "
            f"join ({_SECTIONS}) on section_id = fid"
        )
    return (
        f"select article_id, subject, event_time from ({visits}) "
        f"join ({_ARTICLES}) on article_id = tid"
    )


def _page_counts(visits: str, kind: str, shift: int = 0, days: int = 3) -> str:
    key, name = ("section_id", "name") if kind == "section" else ("article_id", "subject")
    return (
        f"select {key}, {name}, {_bucket(days, shift)} as w, count(*) as pv "
        f"from ({_page_visits(visits, kind)}) group by all"
    )


def _report(
    counts: str, kind: str, n: int | None = None, closed_by: str = "", days: int = 3
) -> str:
    key, name = ("section_id", "name") if kind == "section" else ("article_id", "subject")
    rank = f"row_number() over (partition by w order by pv desc, {key})"
    top = f"qualify {rank} <= {n}" if n else ""
    return (
        f"select {key}, {name}, pv as {kind}_pv, {_bounds(days)} from ({counts}) {closed_by} {top}"
    )


def _clients(visits: str, where: str = "", offset: int = 0, closed_by: str = "") -> str:
    counts = (
        f"select client_ip, {_bucket(1)} as w, count(*) + {offset} as pv "
        f"from ({visits}) {where} group by all"
    )
    return (
        f"select client_ip as client, pv as client_access_cnt, {_bounds(1)} "
        f"from ({counts}) {closed_by}"
    )


def _closed(rows: str, days: int) -> str:
    """Windows that end by the greatest event time."""
    return f"where w + interval {days} day <= (select max(event_time) from ({rows}))"


def _open(rows: str, days: int) -> str:
    """The other windows."""
    return _closed(rows, days).replace("where ", "where not (", 1) + ")"


def _twice(table: str) -> str:
    return f"with t as ({table}) select * from t union all select * from t"


# Where the restarted stream is stopped: half of the time that the events span.
MIDDLE = "min(ts) + (max(ts) - min(ts)) / 2"
_TIMED = f"strftime(event_time, {_TEXT}) as event_time"
_DATED = f"select *, {_DATE} as event_time from ({_records(_FORUM)}) where {_DATE} is not null"
_HOT_SECTION = _report(_page_counts(_VISITS, "section"), "section", 1)
_HOT_ARTICLE = _report(_page_counts(_VISITS, "article"), "article", 1)
_SHOP_VISITS = _visits(_SHOP)
_ITEMS = """
select cast(l_partkey + 1 as bigint) as article_id, l_shipdate as event_time from lineitem
"""
_SPLIT = "string_split(regexp_extract(request, '^\"(.*)\"$', 1), ' ')"

_EARLIER = f"({_page_visits(_VISITS, 'article')}) where event_time < (select {MIDDLE} from events)"
# Windows that the first run has closed keep the subjects of that time.
_RENAMED = f"""
select * exclude (closed)
         replace (case when closed then subject else concat(subject, ' (new)') end as subject)
from (select r.*, strptime(time_end, {_TEXT}) <= (select max(event_time) from {_EARLIER}) as closed
      from ({_report(
          _page_counts(_VISITS, "article"), "article", 3, _closed(_page_visits(_VISITS, "article"), 3)
      )}) as r)"""

# Every tenth event comes when all others have been read.
_FIRST, _THEN = (_visits(f"{_FORUM} where event_id % 10 {sign} 0") for sign in ("<>", "="))
_LATE = f"""
select * replace ({_TIMED[: -len(' as event_time')]} as event_time) from ({_THEN})
where {_bucket(1)} + interval 1 day <= (select max(event_time) from ({_FIRST}))"""

# Windows that the first half has closed are reported with the subjects of that time; later ones
# with the edited ones, and without the articles that have gone.
_PAGE_TIMES = f"select event_time from ({_VISITS}) where article_id > 0"
_CHANGED = f"""
with counts as ({_page_counts(_VISITS, "article")}),
marked as (
  select article_id, subject, w, pv, w + interval 3 day <= (
      select max(event_time) from ({_PAGE_TIMES}) where event_time < (select {MIDDLE} from events)) as early
  from counts),
named as (
  select article_id, w, pv, case when early or article_id % 2 = 0 then subject
                            else concat(subject, ' (new)') end as subject
  from marked where early or article_id % 10 <> 3)
{_report("select * from named", "article", 3, _closed(_PAGE_TIMES, 3))}"""

ORACLE: dict[str, str] = {
    "parse_lines": _records(_MIXED),
    "rejected_lines": f"""
        select value, reason from (
          select value, case when d = '' then 'no_record'
            when try_strptime(regexp_extract(d, '{P.DATE_IN_BRACKETS}', 1),
                              '%d/%b/%Y:%H:%M:%S') is null then 'bad_date' end as reason
          from (select value, regexp_extract(value, '{P.LOG_LINE}', 4) as d from ({_MIXED})))
        where reason is not null""",
    "successful_requests": f"select * from ({_records(_FORUM)}) where status = '200'",
    "combined_fields": _records(_FORUM, combined=True),
    "crawl_combined_fields": _records(_CRAWL, combined=True),
    "parse_dates": f"select client_ip, date_time, strftime(event_time, {_TEXT}) as event_time_text "
    f"from ({_DATED})",
    "epoch_millis": f"select client_ip, date_time, epoch_ms(event_time) as event_ms from ({_DATED})",
    "page_ids": f"select client_ip, request, {_IDS} from ({_records(_FORUM)})",
    "request_parts": "select request, "
    + ", ".join(
        f"case when len({_SPLIT}) = 3 then {_SPLIT}[{i}] end as {name}"
        for i, name in enumerate(("method", "uri", "version"), 1)
    )
    + f" from ({_records(_FORUM)})",
    "visit_facts": f"select * replace ({_TIMED[: -len(' as event_time')]} as event_time) "
    f"from ({_VISITS})",
    "dim_sections": _SECTIONS,
    "dim_articles": _ARTICLES,
    "section_visits": f"select section_id, name, {_TIMED} "
    f"from ({_page_visits(_VISITS, 'section')})",
    "article_visits": f"select article_id, subject, {_TIMED} "
    f"from ({_page_visits(_VISITS, 'article')})",
    "article_visits_bitmap": f"select article_id, subject, {_TIMED} "
    f"from ({_page_visits(_VISITS, 'article')})",
    "section_pv_3d": _report(_page_counts(_VISITS, "section"), "section"),
    "article_pv_3d": _report(_page_counts(_VISITS, "article"), "article"),
    "client_access_1d": _clients(_VISITS),
    "client_forum_access_1d": _clients(_VISITS, "where section_id > 0 or article_id > 0"),
    "client_access_zoned": _clients(_visits(_FORUM, _ZONED), offset=1),
    "hot_section": _HOT_SECTION,
    "hot_section_top3": _report(_page_counts(_VISITS, "section"), "section", 3),
    "hot_section_local_days": _report(_page_counts(_VISITS, "section", 16), "section", 1),
    "hot_article": _HOT_ARTICLE,
    "hot_article_shop": _report(_page_counts(_SHOP_VISITS, "article"), "article", 3),
    "client_access_shop": _clients(_SHOP_VISITS),
    "top_parts_3d": _report(_page_counts(_ITEMS, "article"), "article", 3),
    "top_parts_3d_large": _report(_page_counts(_ITEMS, "article"), "article", 5_000),
    "top_parts_year_large": _report(_page_counts(_ITEMS, "article", days=360), "article", 1_500, days=360),
    "client_access_from_table": _clients(_VISITS),
    "append_hot_section": _twice(_HOT_SECTION),
    "append_hot_article": _twice(_HOT_ARTICLE),
    "append_client_access": _twice(_clients(_VISITS)),
    "append_client_access_compacted": _twice(_clients(_VISITS)),
    "section_pv_3d_from_tiles": _report(_page_counts(_VISITS, "section"), "section"),
    "hot_article_from_tiles": _HOT_ARTICLE,
    "client_access_from_tiles": _clients(_VISITS, "where section_id > 0 or article_id > 0"),
    "stream_client_access_snapshots": _clients(_VISITS, closed_by=_closed(_VISITS, 1)),
    "stream_client_access": _clients(_VISITS, closed_by=_closed(_VISITS, 1)),
    "stream_open_client_windows": _clients(_VISITS, closed_by=_open(_VISITS, 1)),
    "stream_client_access_so_far": _clients(_VISITS),
    "stream_open_hot_article": _report(
        _page_counts(_VISITS, "article"), "article", 3, _open(_page_visits(_VISITS, "article"), 3)
    ),
    "stream_client_access_two_runs": _twice(_clients(_VISITS, closed_by=_closed(_VISITS, 1))),
    "stream_hot_section": _report(
        _page_counts(_VISITS, "section"), "section", 1, _closed(_page_visits(_VISITS, "section"), 3)
    ),
    "stream_hot_article": _report(
        _page_counts(_VISITS, "article"), "article", 3, _closed(_page_visits(_VISITS, "article"), 3)
    ),
    "stream_hot_article_renamed": _RENAMED,
    "stream_hot_article_changed": _CHANGED,
    "stream_late_rows": _LATE,
    "stream_client_access_corrected": _clients(_VISITS),
    "stream_client_access_rebased": _clients(_VISITS),
    "land_raw_logs": _FORUM,
    "land_tailed_logs": _FORUM,
    "client_access_from_text": _clients(_VISITS),
    "hot_article_from_landed": _HOT_ARTICLE,
    "stream_client_access_from_landed": _clients(
        _VISITS, "where section_id > 0 or article_id > 0", closed_by=_closed(_VISITS, 1)
    ),
}
