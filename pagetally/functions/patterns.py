"""Text patterns and formats that define the log format and its pages."""

# One log line in common format. Groups: 1 client, 2 identity, 3 user, 4 date with its
# brackets, 5 request with its quotes, 6 request without, 7 status, 8 bytes.
LOG_LINE = (
    r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}) (\S+) (\S+) (\[.+?\]) (\"(.*?)\") (\d{3}) (\S+)"
)
# The combined format adds groups 9-10 referer and 11-12 user agent.
COMBINED_LINE = LOG_LINE + r" (\"(.*?)\") (\"(.*?)\")"
# Date text before the zone, inside the brackets.
DATE_IN_BRACKETS = r"\[(.*?) .+]"
SECTION_PAGE = r"(\?mod=forumdisplay&fid=)(\d+)"
ARTICLE_PAGE = r"(\?mod=viewthread&tid=)(\d+)"
LOG_DATE = "dd/MMM/yyyy:HH:mm:ss"
LOG_DATE_WITH_ZONE = "dd/MMM/yyyy:HH:mm:ss Z"
RESULT_DATE = "yyyy-MM-dd HH:mm:ss"
STATUS_OK = "200"
