from .comments import (
    extract_comments,
    extract_video_ids,
    parse_pages,
    read_comments,
    split_corrupt,
    video_places,
)
from .jdbc import jdbc_options, read_table_jdbc
from .rosters import (
    ManifestError,
    SeasonFile,
    check_manifest,
    expected_frame,
    manifest_frame,
    parse_manifest,
    read_manifest,
    read_roster_csv,
    season_digests,
)

__all__ = [
    "ManifestError",
    "SeasonFile",
    "check_manifest",
    "expected_frame",
    "extract_comments",
    "extract_video_ids",
    "jdbc_options",
    "manifest_frame",
    "parse_manifest",
    "parse_pages",
    "read_comments",
    "read_manifest",
    "read_roster_csv",
    "read_table_jdbc",
    "season_digests",
    "split_corrupt",
    "video_places",
]
