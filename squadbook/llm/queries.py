"""The operators of this subpackage as queries over the tables, with SQL where it fits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squadbook.llm.decontaminate import _MARKS, NAME, NUMBER, UNIT, UNITS, contaminated
from squadbook.llm.language import identify_languages
from squadbook.llm.licenses import license_scan
from squadbook.llm.lines import fuzzy_line_dedup
from squadbook.llm.pieces import sample_pieces
from squadbook.llm.privacy import find_personal_data
from squadbook.llm.quality import quality_rules
from squadbook.llm.search import ranked_documents
from squadbook.llm.sharding import kd_shards
from squadbook.llm.similarity import similar_documents
from squadbook.llm.spelling import spelling_variants
from squadbook.llm.substrings import dedup_substrings
from squadbook.llm.tokens import read_token_index, write_token_ids
from squadbook.runtime import scratch_path

SHARDS = 40


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(read(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fuzzy_line_dedup(read(spark, sf_dir, "documents"), candidates="words")
    return kept.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """Where this machine keeps a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return contaminated(documents, benchmark).drop("row")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    documents = read(spark, sf_dir, "documents")
    shards = write_token_ids(documents, path, tokenizer_file("byte_bpe_50k.json"))
    return read_token_index(spark, path, shards)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return sample_pieces(documents, tokenizer_file("piece_bpe_32k.model"), with_ids=False)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"), spoil_every=199)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(read(spark, sf_dir, "documents"), shards=SHARDS)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_personal_data": op3_personal_data,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_token_output": op7_token_output,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_license_scan": op9_license_scan,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_sharding": op12_sharding,
    "op13_ranked_search": op13_ranked_search,
}

_WORD = r"[^\x20\x09-\x0D]"

# As ``decontaminate.template_tokens`` has it.
_MARKS_SQL = _MARKS.replace("'", "''")
_UNITS_SQL = ", ".join(f"'{u}'" for u in UNITS)
_SLOTS_SQL = f"'{NUMBER}', '{UNIT}', '{NAME}', '{NUMBER + UNIT}'"

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32_sql(blob: str) -> str:
    """SQL for the CRC-32 of a column of bytes, a byte at a time with the usual table."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ 0xEDB88320 * (value & 1)
        table.append(value)
    bytes_ = f"list_transform(range(1, octet_length({blob}) + 1), lambda i: ('0x' || hex({blob}[i : i]))::BIGINT)"
    step = f"lambda x, y: xor(x >> 8, ({table})[(xor(x, y) & 255) + 1])"
    return f"xor(list_reduce({bytes_}, {step}, 4294967295::BIGINT), 4294967295)"


def _one_to_one_sql(fills: str) -> str:
    """SQL for whether each value of an item stands for one of the document, and the other way."""

    def distinct(side: str) -> str:
        return f"len(list_distinct(list_transform({fills}, lambda f: {{'kind': f.kind, '{side}': f.{side}}})))"

    return f"({distinct('item')} = len({fills}) AND {distinct('doc')} = len({fills}))"


def _kd_levels(shards: int, dimensions: int = 4) -> str:
    """SQL that cuts all nodes of a level at once, by sorting them; a row keeps its node's shards."""
    widths = [f"max(x{d}) OVER w - min(x{d}) OVER w" for d in range(dimensions)]
    most = f"greatest({', '.join(widths)})"
    widest = " ".join(f"WHEN {w} = {most} THEN x{d}" for d, w in enumerate(widths))
    level = """
        k{i} AS (SELECT *, CASE {widest} END AS x FROM n{i} WINDOW w AS (PARTITION BY node)),
        s{i} AS (
            SELECT *, sum(size) OVER (PARTITION BY node ORDER BY x, tie) AS upto,
                   sum(size) OVER (PARTITION BY node) * (shards // 2) AS wanted FROM k{i}
        ), c{i} AS (
            SELECT *, upto * shards < wanted OR ((upto - size) * shards < wanted
                   AND (2 * upto - size) * shards <= 2 * wanted) AS left_side FROM s{i}
        ), n{j} AS (
            SELECT * EXCLUDE (x, upto, wanted, left_side) REPLACE (
                CASE WHEN left_side THEN node ELSE node + shards // 2 END AS node,
                CASE WHEN left_side THEN shards // 2 ELSE shards - shards // 2 END AS shards)
            FROM c{i}
        ),"""
    levels = (shards - 1).bit_length()
    return "".join(level.format(i=i, j=i + 1, widest=widest) for i in range(levels)).replace(
        f"n{levels} AS", "leaves AS"
    )


ORACLES: dict[str, str] = {
    "op11_spelling_variants": f"""
        WITH RECURSIVE runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                   unnest(regexp_extract_all({_LOWERED}, '[a-zÀ-ÿ]{{6,}}')) AS run FROM documents
        ), hashed AS (
            SELECT run, c, h, h % length(run) AS hole FROM (
                SELECT run, c, {_crc32_sql("b")} AS h
                FROM (SELECT run, encode(id || ':' || run) AS b, count(*) AS c FROM runs GROUP BY ALL))
        ), spoilt AS (
            SELECT CASE WHEN h % 199 = 0 THEN left(run, hole) || substr(run, hole + 2) ELSE run END AS word, c FROM hashed
        ), words AS (
            SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spoilt WHERE length(word) >= 6
            GROUP BY word HAVING sum(c) >= 5
        ), holes AS (
            SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS rest
            FROM (SELECT *, unnest(range(1, length(word) + 1)) AS p FROM words)
        ), shorter AS (
            SELECT DISTINCT h.word, h.n, w.word AS rest, w.n AS rest_n FROM holes h JOIN words w ON h.rest = w.word
        ), pairs AS (
            SELECT a.word AS a, b.word AS b, b.n FROM holes a JOIN holes b USING (p, rest) WHERE a.word <> b.word
            UNION ALL SELECT word, rest, rest_n FROM shorter
            UNION ALL SELECT rest, word, n FROM shorter
        ), near AS (
            SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS form, max(n) AS form_n
            FROM pairs GROUP BY a
        ), forms AS (
            SELECT word, form, form_n FROM near JOIN words USING (word) WHERE form_n >= 5 * n
        ), steps AS (
            SELECT word, word AS root, 0 AS step FROM words
            UNION ALL SELECT s.word, f.form, step + 1 FROM steps s JOIN forms f ON s.root = f.word
        ), roots AS (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word)
        SELECT w.word, f.form, r.root, w.n, coalesce(n_near, 0) AS n_near, f.form_n
        FROM words w JOIN roots r USING (word) LEFT JOIN near USING (word)
        LEFT JOIN forms f ON f.word = w.word
    """,
    "op12_sharding": f"""
        WITH d AS (
            SELECT doc_id, encode(coalesce(text, '')) AS text, source, lang, CAST(n_chars AS DOUBLE) AS a,
                   CAST(doc_id AS DOUBLE) AS b FROM documents
        ), n0 AS (
            SELECT doc_id, octet_length(text) + 16 AS size, {_crc32_sql("text")} AS text_crc32,
                   coalesce(('0x' || md5(source)[1 : 5])::BIGINT, 0) AS x0,
                   coalesce(('0x' || md5(lang)[1 : 5])::BIGINT, 0) AS x1,
                   coalesce(floor((a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()) * 1048575.0), 0) AS x2,
                   coalesce(floor((b - min(b) OVER ()) / (max(b) OVER () - min(b) OVER ()) * 1048575.0), 0) AS x3,
                   ('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1 : 7])::BIGINT >> 1 AS tie,
                   0 AS node, {SHARDS} AS shards
            FROM d
        ), {_kd_levels(SHARDS)}
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY node ORDER BY tie, doc_id) - 1 AS slot FROM leaves
        )
        SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(node AS INTEGER) AS shard, slot,
               CAST(NULL AS INTEGER) AS grown_shard
        FROM placed
    """,
    "op13_ranked_search": rf"""
        WITH source AS (
            SELECT 'doc' AS side, row_number() OVER () AS row, doc_id AS id, text FROM documents
            UNION ALL SELECT 'item', row_number() OVER (), item_id, text FROM benchmark
        ), t AS (
            SELECT side, row, id, unnest(regexp_extract_all({_LOWERED},
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM source
        ), counts AS (SELECT side, row, id, term, count(*) AS tf FROM t GROUP BY ALL),
        sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counts WHERE side = 'doc' GROUP BY row),
        totals AS (SELECT count(*) AS all_n, CAST(sum(n) AS BIGINT) AS all_l FROM sizes),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * all_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals WHERE side = 'doc' GROUP BY term, all_n
        ), lengths AS (SELECT row, 10 + (90 * n * all_n) // all_l AS m FROM sizes, totals),
        scores AS (
            SELECT i.row, i.id AS item_id, d.row AS doc_row, d.id AS doc_id,
                   CAST(sum(w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m))) AS BIGINT) AS score
            FROM counts i JOIN counts d USING (term) JOIN weights USING (term) JOIN lengths l ON d.row = l.row
            WHERE i.side = 'item' AND d.side = 'doc' GROUP BY ALL
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id NULLS LAST)
                           AS INTEGER) AS rank
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op1_suffix_dedup": """
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS b FROM documents
        ), p AS (
            SELECT row, b, unnest(range(1, octet_length(b) - 398)) AS p FROM d WHERE octet_length(b) >= 400
        ), h AS (
            SELECT row, p, md5_number(b[p : p + 399]) AS h FROM p
        ), r AS (
            SELECT row, p, coalesce(p > lag(p) OVER (PARTITION BY row ORDER BY p) + 400, true) AS first
            FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)
        ), n AS (
            SELECT row, p, sum(first::INT) OVER (PARTITION BY row ORDER BY p) AS span FROM r
        ), spans AS (
            SELECT row, span, min(p) AS lo, max(p) + 400 AS hi FROM n GROUP BY row, span
        ), gaps AS (
            SELECT row, coalesce(lag(hi) OVER (PARTITION BY row ORDER BY lo), 1) AS lo, lo AS hi FROM spans
            UNION ALL SELECT row, max(hi), 1000000000000 FROM spans GROUP BY row
        ), kept AS (
            SELECT row, string_agg(hex(b[lo : hi - 1]), '' ORDER BY lo) AS kept
            FROM gaps JOIN d USING (row) WHERE hi > lo GROUP BY row
        ), sums AS (
            SELECT row, CAST(sum(hi - lo) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY row
        )
        SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(kept, ''))) END
                   AS kept_sha256
        FROM d LEFT JOIN sums USING (row) LEFT JOIN kept USING (row)
    """,
    "op8_jaccard_join": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') AS words
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(words[p : p + 4], ' ') AS shingle
            FROM (SELECT *, unnest(range(1, greatest(len(words) - 3, 2))) AS p FROM w WHERE len(words) > 0)
        ), sizes AS (
            SELECT doc_id, count(shingle) AS n FROM w LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
        ), shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id
        ), links AS (
            SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
            WHERE 100 * c >= 80 * (x.n + y.n - c)
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        )
        SELECT s.doc_id, n AS n_shingles, min(b) AS component_id
        FROM sizes s JOIN reached ON s.doc_id = a GROUP BY s.doc_id, n
    """,
    "op6_decontamination": rf"""
        WITH source AS (
            SELECT 'doc' AS side, row_number() OVER () AS row, doc_id AS id, text FROM documents
            UNION ALL SELECT 'item', row_number() OVER (), item_id, text FROM benchmark
        ), w AS (
            SELECT side, row, id, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS words FROM source
        ), c AS (
            SELECT *, list_transform(words, lambda x: lower(trim(x, '{_MARKS_SQL}'))) AS cores,
                   list_transform(words, lambda x: x >= 'A' AND x < '[' AND x[2:2] >= 'a') AS capital,
                   list_transform(words, lambda x, i: coalesce(regexp_matches(words[i - 1], '[.!?:]\W*$'), true))
                       AS opens
            FROM w
        ), named AS (
            SELECT *, list_distinct(list_filter(cores, lambda x, i: capital[i] AND NOT opens[i])) AS names FROM c
        ), t AS (
            SELECT side, row, id, cores, list_transform(cores, lambda core, i: CASE
                WHEN ascii(core) BETWEEN 48 AND 57 THEN CASE
                    WHEN regexp_full_match(core, '[0-9][0-9.,:/-]*') THEN '{NUMBER}'
                    WHEN regexp_full_match(core, '[0-9][0-9.,]*[a-z%]+') THEN '{NUMBER + UNIT}'
                    ELSE core END
                WHEN capital[i] AND (NOT opens[i] OR list_contains(names, core)) THEN '{NAME}'
                WHEN ascii(words[i - 1]) BETWEEN 48 AND 57 AND core IN ({_UNITS_SQL}) THEN '{UNIT}'
                ELSE core END) AS tokens
            FROM named
        ), windows AS (
            SELECT *, array_to_string(tokens[p : p + 7], chr(1)) AS run FROM (
                SELECT *, unnest(range(1, len(tokens) - 6)) AS p FROM t WHERE len(tokens) >= 8)
        ), items AS (
            SELECT * FROM windows WHERE side = 'item' AND len(list_filter(
                tokens[p : p + 7], lambda x: x NOT IN ({_SLOTS_SQL}))) >= 5
        ), matched AS (
            SELECT d.row, d.id AS doc_id, i.row AS item_row, i.id AS item_id, d.p - i.p AS shift, i.p AS item_at,
                   list_transform(list_filter(range(0, 8), lambda k: i.tokens[i.p + k] IN ({_SLOTS_SQL})),
                       lambda k: {{'kind': i.tokens[i.p + k], 'item': i.cores[i.p + k],
                                  'doc': d.cores[d.p + k]}}) AS fills
            FROM windows d JOIN items i USING (run) WHERE d.side = 'doc'
        ), places AS (
            SELECT row, doc_id, item_row, item_id, shift, list_distinct(flatten(list(fills))) AS fills,
                   list_distinct(list(item_at)) AS places,
                   coalesce(list(DISTINCT item_at) FILTER (len(fills) = 0), []) AS plain
            FROM matched GROUP BY ALL
        ), weighed AS (
            SELECT *, CASE WHEN {_one_to_one_sql("fills")} THEN len(places) ELSE len(plain) END AS good FROM places
        ), shifts AS (
            SELECT row, doc_id, item_row, item_id,
                   list({{'places': places, 'plain': plain, 'fills': fills}}
                        ORDER BY good DESC, len(fills) DESC, shift) AS shifts
            FROM weighed GROUP BY ALL
        ), joined AS (
            SELECT *, list_reduce(shifts, lambda a, b: {{
                'places': list_distinct(list_concat(a.places, CASE
                    WHEN {_one_to_one_sql("list_distinct(list_concat(a.fills, b.fills))")}
                    THEN b.places ELSE b.plain END)),
                'plain': a.plain,
                'fills': CASE WHEN {_one_to_one_sql("list_distinct(list_concat(a.fills, b.fills))")}
                    THEN list_distinct(list_concat(a.fills, b.fills)) ELSE a.fills END
            }}, {{'places': shifts[1].places[1:0], 'plain': shifts[1].plain[1:0],
                  'fills': shifts[1].fills[1:0]}}) AS taken FROM shifts
        ), sizes AS (SELECT row AS item_row, count(*) AS item_windows FROM items GROUP BY row)
        SELECT doc_id, item_id, item_windows, CAST(len(taken.places) AS BIGINT) AS n_windows,
               CAST(CASE WHEN len(taken.fills) > 0 THEN len(taken.fills) ELSE len(shifts[1].fills) END
                    AS BIGINT) AS n_slots
        FROM joined JOIN sizes USING (item_row) WHERE len(taken.places) >= item_windows * 0.5
    """,
    "op5_quality_rules": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS host,
                   coalesce(text, '') AS text FROM documents
        ), w AS (
            SELECT *, regexp_extract_all(text, '{_WORD}+') AS words,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}'))
                       AS lines
            FROM d
        ), starts AS (
            SELECT row, unnest(range(1, len(words) - 6)) AS p, words FROM w WHERE len(words) >= 8
        ), windows AS (
            SELECT row, p, count(*) OVER
                (PARTITION BY row, array_to_string(words[p : p + 7], ' ')) AS n
            FROM starts
        ), steps AS (
            SELECT row, least(8, coalesce(lead(p) OVER (PARTITION BY row ORDER BY p) - p, 8)) AS step
            FROM windows WHERE n > 1
        ), repeats AS (
            SELECT row, CAST(sum(step) AS BIGINT) AS n_repeat_words FROM steps GROUP BY row
        ), l AS (
            SELECT row, host, unnest(lines) AS line FROM w
        ), k AS (
            SELECT row, host, lower(trim(regexp_replace(line, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))) AS h,
                   len(regexp_extract_all(line, '{_WORD}+')) AS n FROM l
        ), frequent AS (
            SELECT host, h FROM (SELECT host, h, count(DISTINCT row) AS documents FROM k GROUP BY ALL)
            JOIN (SELECT host, count(*) AS all_documents FROM d GROUP BY host) USING (host)
            WHERE documents >= 1000 OR (documents >= 20 AND documents * 100 >= all_documents * 5)
        ), removed AS (
            SELECT row, CAST(sum(n) AS BIGINT) AS n_removed_words, count(*) AS n_removed_lines
            FROM k JOIN frequent USING (host, h) GROUP BY row
        ), m AS (
            SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(n_removed_words, 0) AS n_removed_words,
                   coalesce(n_removed_lines, 0) AS n_removed_lines
            FROM w LEFT JOIN repeats USING (row) LEFT JOIN removed USING (row)
        ), f AS (
            SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM m
        )
        SELECT *, NOT base_failed AND (n_words - n_removed_words) * 100 >= n_words * 50 AS kept
        FROM f
    """,
}
