from .batches import compact, high_water, latest, open_batches, read_batches, write_batch
from .ingestion_log import append_log, log_ingestion
from .tables import (
    dump_comments,
    ensure_database,
    write_bucketed_roster,
    write_roster,
    write_roster_chunks,
    write_roster_jdbc,
)

__all__ = [
    "append_log",
    "compact",
    "dump_comments",
    "ensure_database",
    "high_water",
    "latest",
    "log_ingestion",
    "open_batches",
    "read_batches",
    "write_batch",
    "write_bucketed_roster",
    "write_roster",
    "write_roster_chunks",
    "write_roster_jdbc",
]
