from .align import (
    conform,
    ensure_entity_key,
    fallback_column,
    merge_aliases,
    normalize_columns,
    order_columns,
    tag_source,
    union_rosters,
)
from .dedup import dedup_first, split_missing_key
from .mentions import (
    AliasTable,
    EmptyResultError,
    all_mentions,
    build_alias_dim,
    count_mentions,
    match_mentions,
    mention_summary,
    prepare_aliases,
    top_mention,
)
from .ranking import (
    count_by,
    mode_per_partition,
    rank_groups_by_avg,
    roster_cohort,
    take_first,
    top_groups_by_count,
    unique_entity_histogram,
)

__all__ = [
    "AliasTable",
    "EmptyResultError",
    "all_mentions",
    "build_alias_dim",
    "conform",
    "count_by",
    "count_mentions",
    "dedup_first",
    "ensure_entity_key",
    "fallback_column",
    "match_mentions",
    "mention_summary",
    "merge_aliases",
    "mode_per_partition",
    "normalize_columns",
    "order_columns",
    "prepare_aliases",
    "rank_groups_by_avg",
    "roster_cohort",
    "split_missing_key",
    "tag_source",
    "take_first",
    "top_groups_by_count",
    "top_mention",
    "union_rosters",
    "unique_entity_histogram",
]
