from .comments import (
    compact_mentions,
    read_comment_stream,
    read_mention_totals,
    stream_dedup,
    stream_mentions,
    stream_take,
    write_first,
)
from .metrics import BatchLog, observed, read_batch_log
from .pages import read_broken_pages, read_good_pages, stream_split_corrupt
from .running import (
    RUNNING_COUNTS,
    compact_running,
    read_running,
    running_first,
    running_mentions,
    stream_comments,
    stream_video_ids,
    write_running,
)

__all__ = [
    "RUNNING_COUNTS",
    "BatchLog",
    "compact_mentions",
    "compact_running",
    "observed",
    "read_batch_log",
    "read_broken_pages",
    "read_comment_stream",
    "read_good_pages",
    "read_mention_totals",
    "read_running",
    "running_first",
    "running_mentions",
    "stream_comments",
    "stream_dedup",
    "stream_mentions",
    "stream_split_corrupt",
    "stream_take",
    "stream_video_ids",
    "write_first",
    "write_running",
]
