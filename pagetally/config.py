"""Settings shared by the three jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class JobConfig:
    """What a job counts and how.

    The defaults give true counts over UTC-aligned windows. The switches reproduce other
    conventions of the same reports:

    count_offset       added to every count (1 = counters that start at one)
    honor_offset       read the zone offset in the log's date instead of dropping it
    forum_pages_only   client report: count only section and article pages
    window_start_time  shift of the window grid, e.g. "16 hours" for UTC+8 local days
    lookup_salts       tasks that share a hot page where the dimension is too large to broadcast
    bitmap_bytes       most bytes of a bitmap of page ids that is broadcast in front of such a lookup
    watermark_delay    how late a row may be before its closed window ignores it (streams)
    """

    hot_window: str = "3 days"
    client_window: str = "1 day"
    top_n: int = 1
    lookup_salts: int = 8
    bitmap_bytes: int = 64 << 20
    watermark_delay: str = "0 seconds"
    count_offset: int = 0
    honor_offset: bool = False
    forum_pages_only: bool = False
    window_start_time: str | None = None

    def __post_init__(self):
        if self.top_n < 1:
            raise ValueError("top_n must be at least 1")
        if self.lookup_salts < 1:
            raise ValueError("lookup_salts must be at least 1")
