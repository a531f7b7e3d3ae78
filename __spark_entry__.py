
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from squadbook.plans.table_queries import QUERIES  # noqa: E402

# A word character, as a class body and as its complement.
_W = r"[\p{L}\p{N}_]"
_N = r"[^\p{L}\p{N}_]"


def _marked(text: str) -> str:
    """SQL that puts chr(1) at every word boundary of a text.

    With its own boundaries marked, an alias occurs as whole words if and only if its
    marked spelling is a part of the marked text.
    """
    return rf"regexp_replace({text}, '({_W}+)', chr(1) || '\1' || chr(1), 'g')"


# Orders in the columns of a roster.
_ROSTER = """
    SELECT upper(substr(o_orderstatus, 1, 1)) || '_' || year(o_orderdate) || '_' || o_orderkey
               AS player_id,
           CAST(year(o_orderdate) AS INTEGER) AS year,
           lower(o_orderstatus) AS gender,
           o_custkey AS sofifa_id,
           'Order ' || o_orderkey AS short_name,
           'Club ' || o_custkey AS club_name,
           CAST(floor(o_totalprice / 10000) AS INTEGER) AS age,
           CAST(year(o_orderdate) + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS INTEGER)
               AS contract_valid_until,
           o_orderpriority AS nationality_name
    FROM orders
"""

# Names looked for in texts: alias, canonical, and the alias as ``_marked`` spells it.
_ALIASES = rf"""
    names AS (
        SELECT words[i] AS short_name, array_to_string(words[i : i + 1], ' ') AS long_name
        FROM (SELECT words, unnest(range(1, len(words) + 1)) AS i
              FROM (SELECT regexp_extract_all(text, '\S+') AS words FROM benchmark))
    ),
    spelled AS (
        SELECT lower(short_name) AS alias, short_name AS canonical FROM names WHERE short_name <> ''
        UNION ALL
        SELECT lower(long_name), short_name FROM names WHERE short_name <> '' AND long_name <> ''
    ),
    aliases AS (
        SELECT alias, min(canonical) AS canonical,
               CASE WHEN regexp_matches(alias, '^{_W}') THEN '' ELSE chr(1) END
               || {_marked("alias")} ||
               CASE WHEN regexp_matches(alias, '{_W}$') THEN '' ELSE chr(1) END AS marked
        FROM spelled GROUP BY alias
    )
"""


def _found(table: str, key: str) -> str:
    return f"""{_ALIASES},
    found AS (
        SELECT DISTINCT {key}, alias, canonical
        FROM (SELECT {key}, {_marked("lower(text)")} AS text FROM {table}) t
        JOIN aliases ON contains(t.text, marked)
    ),
    counts AS (SELECT canonical, count(*) AS mentions FROM found GROUP BY canonical)
"""


_TURNS = "WITH" + _found("conversations", "conv_id, turn")
_DOCUMENTS = "WITH" + _found("documents", "doc_id")


def _loosely_marked(text: str) -> str:
    """SQL that puts chr(1) between word and other characters, and chr(2) between others.

    Edges count as other characters. An alias occurs without touching a word character if
    and only if its own marked spelling is a part of the marked text.
    """
    others = rf"regexp_replace({_marked(text)}, '([^\p{{L}}\p{{N}}_\x01])', chr(2) || '\1' || chr(2), 'g')"
    single = f"replace({others}, chr(2) || chr(2), chr(2))"
    return f"replace(replace({single}, chr(2) || chr(1), chr(1)), chr(1) || chr(2), chr(1))"


_LOOSE = f"""WITH {_ALIASES},
    loose AS (SELECT alias, canonical, {_loosely_marked("alias")} AS spelled FROM aliases),
    found AS (
        SELECT doc_id, alias, canonical
        FROM (SELECT doc_id, {_loosely_marked("lower(text)")} AS text FROM documents) t
        JOIN loose ON contains(t.text, spelled)
    )
    SELECT canonical, count(*) AS mentions FROM found GROUP BY canonical
"""


def _ranked_quantity(direction: str) -> str:
    return f"""
    WITH g AS (
        SELECT l_suppkey, avg(l_quantity) AS average_quantity FROM lineitem
        WHERE year(l_shipdate) = 1998 AND l_quantity IS NOT NULL GROUP BY l_suppkey
    ), r AS (
        SELECT *, CAST(dense_rank() OVER
            (ORDER BY average_quantity {direction} NULLS LAST, l_suppkey ASC NULLS FIRST)
            AS INTEGER) AS rank FROM g
    )
    SELECT l_suppkey, round(average_quantity, 6) AS average_quantity, rank FROM r WHERE rank <= 10
    """


def _video_ids(cut: str) -> str:
    return f"""
    WITH pages AS (
        SELECT CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) AS term_no, doc_id AS page_no,
               string_split(text, chr(10)) AS lines
        FROM documents
    ), items AS (
        SELECT term_no, page_no, CAST(unnest(range(len(lines))) AS INTEGER) AS pos,
               unnest(lines) AS video_id FROM pages
    ), nth AS (
        SELECT *, row_number() OVER (PARTITION BY term_no ORDER BY page_no, pos) AS nth FROM items
    ), firsts AS (
        SELECT video_id, term_no, page_no, pos, row_number() OVER
            (PARTITION BY video_id ORDER BY term_no, page_no, pos) AS seen
        FROM nth WHERE {cut} AND video_id <> ''
    )
    SELECT video_id, term_no, page_no, pos FROM firsts WHERE seen = 1
    """


_HISTOGRAM = f"""
    WITH u AS (
        SELECT nationality_name, row_number() OVER (PARTITION BY sofifa_id
            ORDER BY year DESC, gender ASC, player_id ASC) AS p
        FROM ({_ROSTER}) WHERE sofifa_id IS NOT NULL
    )
    SELECT nationality_name, count(*) AS player_count FROM u WHERE p = 1 GROUP BY ALL
"""

_COMMENTS = """
    WITH t AS (SELECT *, string_split(text, chr(10)) AS lines FROM conversations),
    items AS (
        SELECT conv_id, turn, role, CAST(unnest(range(len(lines))) AS INTEGER) AS pos,
               unnest(lines) AS line FROM t
    )
    SELECT CAST(conv_id AS VARCHAR) AS video_id,
           conv_id || '-' || turn || '-' || pos AS comment_id,
           CASE WHEN role = 'system' OR role IS NULL THEN 'unknown' ELSE role END AS author,
           line AS text, conv_id AS video_ord, turn AS page_no, pos
    FROM items
"""

_COUNT_SEASONS = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, n_name, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
"""

_SUMMARY = """,
    top AS (SELECT * FROM counts ORDER BY mentions DESC, canonical LIMIT 1)
    SELECT (SELECT canonical FROM top) AS player, (SELECT mentions FROM top) AS player_mentions,
           canonical, mentions
    FROM counts
"""

ORACLES = {
    "top_groups_by_count": """
        WITH g AS (
            SELECT o_custkey, count(*) AS player_count FROM orders
            WHERE year(o_orderdate) = 1998 AND o_totalprice >= 100000 GROUP BY o_custkey
        ), r AS (
            SELECT *, CAST(dense_rank() OVER
                (ORDER BY player_count DESC NULLS LAST, o_custkey ASC NULLS FIRST) AS INTEGER) AS rank
            FROM g
        )
        SELECT * FROM r WHERE rank <= 10
    """,
    "large_groups_by_count": """
        SELECT l_partkey, player_count, CAST(row_number() OVER
            (ORDER BY player_count DESC, l_partkey) AS INTEGER) AS rank
        FROM (SELECT l_partkey, count(*) AS player_count FROM lineitem GROUP BY l_partkey)
        WHERE player_count >= 30 ORDER BY rank LIMIT 1000
    """,
    "top_segments_by_count": """
        WITH g AS (
            SELECT c_mktsegment, count(*) AS player_count
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
        ), r AS (
            SELECT *, CAST(dense_rank() OVER
                (ORDER BY player_count DESC NULLS LAST, c_mktsegment ASC NULLS FIRST) AS INTEGER)
                AS rank FROM g
        )
        SELECT * FROM r WHERE rank <= 3
    """,
    "rank_groups_by_avg_desc": _ranked_quantity("DESC"),
    "rank_groups_by_avg_asc": _ranked_quantity("ASC"),
    "mode_per_partition": f"""
        WITH r AS (
            SELECT year, n_name, n AS player_count, CAST(row_number() OVER
                (PARTITION BY year ORDER BY n DESC, n_name ASC NULLS LAST) AS INTEGER) AS rank
            FROM ({_COUNT_SEASONS})
        )
        SELECT year, n_name, CAST(player_count AS BIGINT) AS player_count, rank FROM r WHERE rank = 1
    """,
    "unique_entity_histogram": """
        WITH u AS (
            SELECT event_type, row_number() OVER
                (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id NULLS LAST) AS p
            FROM events WHERE user_id IS NOT NULL
        )
        SELECT event_type, count(*) AS player_count FROM u WHERE p = 1 GROUP BY event_type
    """,
    "count_by": """
        SELECT l_partkey, l_returnflag, count(*) AS n_lines FROM lineitem
        GROUP BY l_partkey, l_returnflag
    """,
    "roster_cohort": f"SELECT * FROM ({_ROSTER}) WHERE year = 1998 AND gender = 'f'",
    "take_first": "SELECT * FROM conversations ORDER BY conv_id, turn LIMIT 500",
    "dedup_first": """
        WITH p AS (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST,
                         l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST,
                         l_returnflag NULLS LAST, l_linestatus NULLS LAST, l_shipdate NULLS LAST
            ) AS p FROM lineitem
        )
        SELECT * EXCLUDE (p) FROM p WHERE p = 1
    """,
    "expiring_contracts": f"""
        WITH g AS (
            SELECT club_name, count(*) AS player_count FROM ({_ROSTER})
            WHERE year = 1998 AND contract_valid_until >= 2001 GROUP BY club_name
        ), r AS (
            SELECT *, CAST(dense_rank() OVER (ORDER BY player_count DESC, club_name ASC NULLS FIRST)
                AS INTEGER) AS rank FROM g
        )
        SELECT * FROM r WHERE rank <= 10
    """,
    "average_age_ranking": f"""
        WITH g AS (
            SELECT club_name, avg(age) AS average_age FROM ({_ROSTER})
            WHERE year = 1998 AND age IS NOT NULL GROUP BY club_name
        ), r AS (
            SELECT *, CAST(dense_rank() OVER (ORDER BY average_age ASC, club_name ASC NULLS FIRST)
                AS INTEGER) AS rank FROM g
        )
        SELECT club_name, round(average_age, 6) AS average_age, rank FROM r WHERE rank <= 10
    """,
    "popular_nationality": f"""
        WITH g AS (
            SELECT year, nationality_name, count(*) AS player_count FROM ({_ROSTER}) GROUP BY ALL
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY year
                ORDER BY player_count DESC, nationality_name ASC NULLS LAST) AS INTEGER) AS rank
            FROM g
        )
        SELECT * FROM r WHERE rank = 1
    """,
    "nationality_histogram": _HISTOGRAM,
    "bucketed_histogram": _HISTOGRAM,
    "clean_numbers": r"""
        SELECT o_orderkey,
               TRY_CAST(regexp_extract(o_orderpriority, '(-?\d+(?:\.\d+)?)', 1) AS INTEGER) AS priority,
               TRY_CAST(regexp_extract(o_orderstatus, '(-?\d+(?:\.\d+)?)', 1) AS INTEGER) AS status,
               o_totalprice AS price,
               CAST(trunc(o_totalprice) AS INTEGER) AS whole_price,
               o_totalprice AS price_in_text,
               o_custkey AS customer
        FROM orders
    """,
    "clean_timestamps": """
        SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE ts END AS ts
        FROM events
    """,
    "entity_key_from_url": r"""
        SELECT page_id,
               TRY_CAST(regexp_extract(url, '(\d+)', 1) AS BIGINT) AS sofifa_id,
               TRY_CAST(regexp_extract(url, '(\d+)', 1) AS BIGINT) AS from_url
        FROM pages
    """,
    "composite_ids": """
        SELECT o_orderkey, upper(substr(o_orderstatus, 1, 1)) || '_' || year(o_orderdate) || '_'
               || o_custkey AS player_id
        FROM orders
    """,
    "normalize_and_alias": """
        SELECT c_custkey AS cust_key, c_name AS name, c_acctbal AS acct_bal_pct,
               c_mktsegment AS club_name, c_nationkey AS nationality_name, c_name AS short_name
        FROM customer
    """,
    "union_conform": """
        SELECT 2021 AS year, 'male' AS gender, c_custkey AS sofifa_id, c_name AS short_name,
               c_mktsegment AS club_name, CAST(NULL AS VARCHAR) AS league_name, c_nationkey AS age,
               CAST(NULL AS DOUBLE) AS overall, c_acctbal AS value_eur,
               'M_2021_' || c_custkey AS player_id
        FROM customer
        UNION ALL
        SELECT 2022, 'female', s_suppkey, s_name, NULL, NULL, NULL, NULL, s_acctbal,
               'F_2022_' || s_suppkey
        FROM supplier
    """,
    "build_roster_from_files": """
        WITH p AS (
            SELECT upper(substr(o_orderstatus, 1, 1)) || '_' || year(o_orderdate) || '_' || o_custkey
                       AS player_id,
                   CAST(year(o_orderdate) AS INTEGER) AS year, lower(o_orderstatus) AS gender,
                   o_custkey AS sofifa_id, 'Order ' || o_orderkey AS short_name,
                   CAST(year(o_orderdate) + CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
                       AS INTEGER) AS contract_valid_until,
                   o_orderpriority AS nationality_name, o_totalprice AS value_eur,
                   date_trunc('day', o_orderdate)::TIMESTAMP AS dob,
                   row_number() OVER (PARTITION BY o_orderstatus, year(o_orderdate), o_custkey
                                      ORDER BY 'Order ' || o_orderkey) AS p
            FROM orders
        )
        SELECT * EXCLUDE (p) FROM p WHERE p = 1
    """,
    "load_roster_from_files": """
        WITH p AS (SELECT DISTINCT o_orderstatus, year(o_orderdate) AS year, o_custkey FROM orders)
        SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS rejected,
               string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years,
               count(*) AS rows_read, count(*) AS players_read, CAST(sum(o_custkey) AS BIGINT) AS ids_read
        FROM p
    """,
    "standardize_season": """
        SELECT 'M_1998_' || o_custkey AS player_id, o_custkey AS sofifa_id,
               min(CAST(o_orderkey AS VARCHAR)) AS short_name,
               arg_min(o_orderpriority, CAST(o_orderkey AS VARCHAR)) AS nationality_name,
               'male' AS gender, 1998 AS year
        FROM orders WHERE year(o_orderdate) = 1998 GROUP BY o_custkey
    """,
    "numeric_ids": """
        SELECT o_orderkey, o_orderkey * 1000 AS sofifa_id FROM orders
        UNION ALL SELECT o_orderkey, o_orderkey * 1000 FROM orders
    """,
    "manifest_gaps": """
        WITH expected AS (
            SELECT DISTINCT o_orderstatus AS "group",
                   CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS year
            FROM orders
        ), manifest AS (
            SELECT l_linestatus AS "group", CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS year
            FROM lineitem
        )
        SELECT * FROM expected ANTI JOIN manifest USING ("group", year)
    """,
    "write_read_roster": _ROSTER,
    "append_roster": _ROSTER,
    "replace_seasons": f"""
        SELECT * REPLACE (CASE WHEN year = 1998 THEN 'Other club' ELSE club_name END AS club_name)
        FROM ({_ROSTER})
    """,
    "replace_table": f"SELECT * FROM ({_ROSTER}) WHERE year = 1998",
    "write_chunks": f"""
        SELECT * REPLACE (CASE WHEN gender IN ('f', 'o') THEN club_name END AS club_name)
        FROM ({_ROSTER})
    """,
    "ingestion_log": """
        WITH r AS (
            SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS price,
                   o_orderpriority, year(o_orderdate) AS year FROM orders
        )
        SELECT count(*) AS row_count,
               string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years,
               '{"all": {"2001": "orders.parquet"}}' AS source_files,
               CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(1), o_orderkey, o_custkey,
                   o_orderstatus, price, o_orderpriority, year)), 1, 8) AS BIGINT)) AS VARCHAR) AS checksum
        FROM r
    """,
    "extract_video_ids": _video_ids("nth <= 25"),
    "extract_all_video_ids": _video_ids("TRUE"),
    "extract_comments": _COMMENTS,
    "split_corrupt": """
        SELECT CAST(conv_id AS VARCHAR) AS video_id, turn AS page_no,
               CASE WHEN role = 'assistant' THEN NULL
                    ELSE CAST(len(string_split(text, chr(10))) AS INTEGER) END AS items
        FROM conversations
    """,
    "dump_comments": "SELECT * FROM conversations",
    "alias_dim": """
        WITH spelled AS (
            SELECT lower(trim(p_brand)) AS alias, trim(p_brand) AS canonical
            FROM part WHERE trim(p_brand) <> ''
            UNION ALL
            SELECT lower(p_name), trim(p_brand) FROM part
            WHERE trim(p_brand) <> '' AND trim(p_name) <> ''
        )
        SELECT alias, min(canonical) AS canonical FROM spelled GROUP BY alias
    """,
    "whole_word_filter": f"""
        SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '(^|{_N})of the({_N}|$)')
    """,
    "escaped_phrase_filter": rf"""
        SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '(^|{_N})the\*\*\*({_N}|$)')
    """,
    "match_long_passages": f"""
        WITH passages AS (
            SELECT 'Passage ' || item_id AS canonical,
                   array_to_string(regexp_split_to_array(text, '[ \\n]+')[1 : 30], ' ') AS text FROM benchmark
        ), names AS (
            SELECT lower(text) AS alias, min(canonical) AS canonical FROM passages GROUP BY lower(text)
            UNION ALL SELECT lower(canonical), canonical FROM passages
        ), aliases AS (
            SELECT alias, canonical,
                   CASE WHEN regexp_matches(alias, '^{_W}') THEN '' ELSE chr(1) END || {_marked("alias")} ||
                   CASE WHEN regexp_matches(alias, '{_W}$') THEN '' ELSE chr(1) END AS marked
            FROM names
        ), texts AS (
            SELECT doc_id, {_marked("lower(regexp_replace(text, '[ \\n]+', ' ', 'g'))")} AS text FROM documents
        )
        SELECT doc_id, alias, canonical FROM texts JOIN aliases ON contains(text, marked)
    """,
    "match_mentions": _TURNS + "SELECT conv_id, turn, alias, canonical FROM found",
    "count_mentions": _TURNS + "SELECT * FROM counts",
    "count_mentions_by_key": "WITH" + _found("conversations", "conv_id") + "SELECT * FROM counts",
    "count_comments_without_id": "WITH comments AS ("
    "SELECT row_number() OVER () AS comment, unnest(string_split(text, chr(10))) AS text"
    " FROM conversations), lines AS (SELECT row_number() OVER () AS line, text FROM comments),"
    + _found("lines", "line")
    + "SELECT * FROM counts",
    "count_loose_mentions": _LOOSE,
    "count_document_mentions": _DOCUMENTS + "SELECT * FROM counts",
    "count_document_mentions_unbroadcast": _DOCUMENTS + "SELECT * FROM counts",
    "top_mention": _TURNS + "SELECT * FROM counts ORDER BY mentions DESC, canonical LIMIT 1",
    "mention_summary": _TURNS + _SUMMARY,
    "most_discussed_player": _TURNS + _SUMMARY,
    "stream_mentions": _TURNS + "SELECT * FROM counts",
    "stream_dump": "SELECT * FROM conversations",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_take": "SELECT least(count(*), 1000) AS n_events, least(count(*), 1000) AS n_distinct, least(count(*), 1000) AS n_known FROM events",
    "incremental_load": """
        WITH p AS (
            SELECT upper(substr(o_orderstatus, 1, 1)) || '_' || year(o_orderdate) || '_' || o_custkey
                       AS player_id,
                   CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) = 1995 THEN 'Changed'
                        ELSE o_orderpriority END AS nationality_name,
                   o_totalprice AS value_eur, CAST(year(o_orderdate) AS INTEGER) AS year,
                   lower(o_orderstatus) AS gender,
                   row_number() OVER (PARTITION BY o_orderstatus, year(o_orderdate), o_custkey
                                      ORDER BY 'Order ' || o_orderkey) AS p
            FROM orders WHERE NOT (o_orderstatus = 'O' AND year(o_orderdate) = 1997)
        )
        SELECT * EXCLUDE (p) FROM p WHERE p = 1
    """,
    "running_mentions": _TURNS + "SELECT * FROM counts",
    "compacted_mentions": _TURNS + "SELECT * FROM counts",
    "stream_dedup_within": "SELECT DISTINCT user_id, event_type, date_trunc('day', ts)::TIMESTAMP AS day FROM events",
    "stream_quarantine": """
        SELECT CAST(conv_id AS VARCHAR) AS video_id, turn AS page_no,
               CASE WHEN role IS DISTINCT FROM 'assistant'
                    THEN CAST(len(string_split(text, chr(10))) AS INTEGER) END AS items,
               coalesce(role = 'assistant', false) AS broken
        FROM conversations
    """,
    "stream_video_ids": _video_ids("TRUE"),
    "stream_comments": _COMMENTS,
    "stream_log": """
        SELECT count(*) AS row_count,
               string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years,
               CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(1), o_orderkey, o_custkey, year)), 1, 8)
                   AS BIGINT)) AS VARCHAR) AS checksum
        FROM (SELECT *, year(o_orderdate) AS year FROM orders)
    """,
}


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}
try:
    import corpus_pipeline
    from squadbook.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # The subpackage and its pipeline may be absent; a fault within them is an error.
    if missing.name not in ("corpus_pipeline", "squadbook.llm"):
        raise
else:
    LLM_QUERIES = llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    LLM_ORACLES = dict(llm_queries.ORACLES)
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: mentions of names in conversations, beside the most mentioned."""
    return QUERIES["mention_summary"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES | LLM_ORACLES
