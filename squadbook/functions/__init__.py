from .checksum import content_checksum, ingestion_metrics
from .cleaning import clean_numeric, clean_timestamp, coerce, digits_in, tolerant_integer
from .keys import composite_id
from .names import normalize_name
from .text import contains_phrase, escape_regex, segments, strip

__all__ = [
    "clean_numeric",
    "clean_timestamp",
    "coerce",
    "composite_id",
    "contains_phrase",
    "content_checksum",
    "digits_in",
    "escape_regex",
    "ingestion_metrics",
    "normalize_name",
    "segments",
    "strip",
    "tolerant_integer",
]
