"""Every operator as a query over the benchmark tables.

The roster domain is mapped on ``orders``: the customer is the entity, the year of the
order the season, its status the group and its priority a small category. Comments are
the turns of ``conversations`` and the texts of ``documents``; the names looked for in
them are all words and two-word runs of ``benchmark`` passages.

Queries that write go through a fresh folder of the session's shared scratch space.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from .. import sinks, sources, streaming
from ..functions import (
    clean_numeric,
    clean_timestamp,
    composite_id,
    contains_phrase,
    digits_in,
)
from ..runtime import scratch_path, stored
from ..schema import COMMENT_PAGE_SCHEMA, CORE_COLUMNS
from . import reports
from .incremental import load_changed_seasons, read_roster
from .roster import build_roster, load_roster, sort_roster, standardize_roster

TURN = ["conv_id", "turn"]
# Seasons of orders, as a manifest would list them: each status has some in every year.
ORDER_SEASONS = {status: list(range(1995, 2002)) for status in "FOP"}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _in_year(column: str, year: int) -> Column:
    """A range rather than ``year(column)``, so that the file scan can skip row groups."""
    start, end = (F.to_timestamp_ntz(F.lit(f"{y}-01-01")) for y in (year, year + 1))
    return (F.col(column) >= start) & (F.col(column) < end)


def _names(spark: SparkSession, sf: str) -> DataFrame:
    """Names to look for: every word of a passage, with the next one as long name."""
    words = F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0))
    pairs = F.transform(
        F.array(words),
        lambda w: F.transform(
            w, lambda x, i: F.struct(x.alias("short_name"), F.concat_ws(" ", x, F.get(w, i + 1)).alias("long_name"))
        ),
    )
    names = _table(spark, sf, "benchmark").select(F.explode(F.flatten(pairs)).alias("name"))
    return names.select("name.*")


def _aliases(spark: SparkSession, sf: str) -> DataFrame:
    return op.build_alias_dim(_names(spark, sf))


def _roster(spark: SparkSession, sf: str, season: int | None = None) -> DataFrame:
    """Orders in the columns of a roster; of one season as a range that the scan can use."""
    year = F.year("o_orderdate")
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    orders = _table(spark, sf, "orders")
    if season is not None:
        orders = orders.where(_in_year("o_orderdate", season))
    return orders.select(
        composite_id(F.col("o_orderstatus"), year, F.col("o_orderkey")).alias("player_id"),
        year.alias("year"),
        F.lower("o_orderstatus").alias("gender"),
        F.col("o_custkey").alias("sofifa_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("short_name"),
        F.concat(F.lit("Club "), F.col("o_custkey")).alias("club_name"),
        F.floor(F.col("o_totalprice") / 10000).cast("int").alias("age"),
        (year + priority).alias("contract_valid_until"),
        F.col("o_orderpriority").alias("nationality_name"),
    )


# Rankings, counts, histograms


def top_groups_by_count(spark, sf):
    orders = _table(spark, sf, "orders")
    in_season = _in_year("o_orderdate", 1998) & (F.col("o_totalprice") >= 100000)
    return op.top_groups_by_count(orders, "o_custkey", 10, in_season)


def large_groups_by_count(spark, sf):
    return op.top_groups_by_count(_table(spark, sf, "lineitem"), "l_partkey", 1000, min_count=30)


def top_segments_by_count(spark, sf):
    # Orders are counted per customer first: a customer with a third of them joins as one row.
    counted = op.count_by(_table(spark, sf, "orders"), ["o_custkey"], "n")
    customer = _table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    rows = counted.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return op.top_groups_by_count(rows, "c_mktsegment", 3, weight="n")


def _rank_by_quantity(spark, sf, order):
    lineitem = _table(spark, sf, "lineitem")
    in_season = _in_year("l_shipdate", 1998)
    ranked = op.rank_groups_by_avg(
        lineitem, "l_suppkey", "l_quantity", 10, order, in_season, "average_quantity"
    )
    return ranked.withColumn("average_quantity", F.round("average_quantity", 6))


def rank_groups_by_avg_desc(spark, sf):
    return _rank_by_quantity(spark, sf, "desc")


def rank_groups_by_avg_asc(spark, sf):
    return _rank_by_quantity(spark, sf, "asc")


def mode_per_partition(spark, sf):
    by_customer = [F.year("o_orderdate").alias("year"), F.col("o_custkey")]
    counted = op.count_by(_table(spark, sf, "orders").select(*by_customer), ["year", "o_custkey"], "n")
    customer = _table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = _table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = counted.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return op.mode_per_partition(rows, "year", "n_name", weight="n")


def unique_entity_histogram(spark, sf):
    events = _table(spark, sf, "events")
    return op.unique_entity_histogram(events, "user_id", "event_type", ["ts", "event_id"])


def count_by(spark, sf):
    return op.count_by(_table(spark, sf, "lineitem"), ["l_partkey", "l_returnflag"], "n_lines")


def roster_cohort(spark, sf):
    return op.roster_cohort(_roster(spark, sf, 1998), 1998, "F")


def take_first(spark, sf):
    return op.take_first(_table(spark, sf, "conversations"), 500, TURN)


def dedup_first(spark, sf):
    return op.dedup_first(_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# The reports on a roster


def expiring_contracts(spark, sf):
    return reports.expiring_contracts(_roster(spark, sf, 1998), 1998, 10, 2001)


def average_age_ranking(spark, sf):
    ranked = reports.average_age_ranking(_roster(spark, sf, 1998), 1998, 10, "asc")
    return ranked.withColumn("average_age", F.round("average_age", 6))


def popular_nationality(spark, sf):
    return reports.popular_nationality(_roster(spark, sf))


def nationality_histogram(spark, sf):
    return reports.nationality_histogram(_roster(spark, sf))


def bucketed_histogram(spark, sf):
    """The histogram on a table in buckets of players: none of their rows is shuffled."""
    sinks.ensure_database(spark, "squadbook_queries")
    table = f"squadbook_queries.bucketed_{uuid.uuid4().hex}"
    sinks.write_bucketed_roster(_roster(spark, sf), table, 16)
    histogram = stored(reports.nationality_histogram(spark.table(table)), "histogram")
    spark.sql(f"DROP TABLE {table}")
    return histogram


def most_discussed_player(spark, sf):
    roster = op.tag_source(_names(spark, sf), 2022, "male")
    comments = _table(spark, sf, "conversations")
    return reports.most_discussed_player(roster, comments, 2022, "male")


# Cleaning and alignment


def clean_numbers(spark, sf):
    price = F.col("o_totalprice")
    return _table(spark, sf, "orders").select(
        "o_orderkey",
        clean_numeric(F.col("o_orderpriority"), "int").alias("priority"),
        clean_numeric(F.col("o_orderstatus"), "int").alias("status"),
        clean_numeric(price.cast("string"), "double").alias("price"),
        clean_numeric(price.cast("string"), "int").alias("whole_price"),
        clean_numeric(F.concat(F.lit("€"), price, F.lit("K")), "double").alias("price_in_text"),
        clean_numeric(F.concat(F.lit(" "), F.col("o_custkey")), "bigint").alias("customer"),
    )


def clean_timestamps(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", " ")
        .when(kind == "signup", "n/a")
        .otherwise(F.col("ts").cast("string"))
    )
    cleaned = clean_timestamp(text).cast("timestamp_ntz").alias("ts")
    return _table(spark, sf, "events").select("event_id", cleaned)


def entity_key_from_url(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", F.col("url").alias("player_url"))
    keyed = op.ensure_entity_key(pages)
    checked = keyed.withColumn("from_url", digits_in(F.col("player_url")))
    return checked.select("page_id", "sofifa_id", "from_url")


def composite_ids(spark, sf):
    orders = _table(spark, sf, "orders")
    player_id = composite_id(F.col("o_orderstatus"), F.year("o_orderdate"), F.col("o_custkey"))
    return orders.select("o_orderkey", player_id.alias("player_id"))


def normalize_and_alias(spark, sf):
    customer = _table(spark, sf, "customer")
    # The two club columns complete each other; the second has a value for all.
    building = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment"))
    messy = customer.select(
        F.col("c_custkey").alias(" Cust Key "),
        F.col("c_name").alias("Name"),
        F.col("c_acctbal").alias("Acct Bal (%)"),
        building.alias("Club Name"),
        F.col("c_mktsegment").alias("Club"),
        F.col("c_nationkey").alias("Nationality"),
    )
    aligned = op.merge_aliases(op.normalize_columns(messy))
    return op.fallback_column(aligned, "short_name", "name")


def union_conform(spark, sf):
    customer = _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("sofifa_id"),
        F.col("c_name").alias("short_name"),
        F.col("c_mktsegment").alias("club_name"),
        F.col("c_acctbal").cast("string").alias("value_eur"),
        F.col("c_nationkey").alias("age"),
    )
    supplier = _table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("sofifa_id"),
        F.col("s_name").alias("short_name"),
        F.col("s_acctbal").alias("value_eur"),
    )
    frames = [op.tag_source(customer, 2021, "Male"), op.tag_source(supplier, 2022, "Female")]
    types = {"sofifa_id": "bigint", "value_eur": "double", "age": "int", "overall": "double"}
    unified = op.conform(op.union_rosters(frames), ["overall", "league_name"], types)
    core = [c for c in CORE_COLUMNS if c in unified.columns]
    player_id = composite_id(F.col("gender"), F.col("year"), F.col("sofifa_id"))
    ordered = op.order_columns(unified, core).withColumn("player_id", player_id)
    return sort_roster(ordered)


# Ingestion and tables


def _season_files(spark, sf) -> tuple[list[sources.SeasonFile], dict[str, list[int]]]:
    """Orders as one folder of CSV files per status and year, under untidy headers."""
    folder = scratch_path(spark, "seasons")
    year = F.year("o_orderdate")
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    orders = _table(spark, sf, "orders").select(
        "o_orderstatus",
        year.alias("o_year"),
        F.col("o_custkey").alias("Sofifa ID"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("Name"),
        F.col("o_orderpriority").alias("Nationality"),
        F.col("o_totalprice").alias("Value (EUR)"),
        (year + priority).alias("Contract End Year"),
        F.col("o_orderdate").cast("date").alias("DOB"),
    )
    writer = orders.write.partitionBy("o_orderstatus", "o_year")
    writer.option("header", True).csv(folder)
    manifest = [
        sources.SeasonFile(s, y, f"{folder}/o_orderstatus={s}/o_year={y}")
        for s, seasons in ORDER_SEASONS.items()
        for y in seasons
    ]
    return manifest, ORDER_SEASONS


def build_roster_from_files(spark, sf):
    manifest, expected = _season_files(spark, sf)
    roster, _ = build_roster(spark, manifest, expected)
    columns = "player_id year gender sofifa_id short_name contract_valid_until nationality_name"
    dob = F.col("dob").cast("timestamp_ntz").alias("dob")
    return roster.select(*columns.split(), "value_eur", dob)


def load_roster_from_files(spark, sf):
    manifest, expected = _season_files(spark, sf)
    target, log = scratch_path(spark, "players"), scratch_path(spark, "log")
    load_roster(spark, manifest, target, log, expected)
    years = F.array_join(F.col("years").cast("array<string>"), ",").alias("years")
    logged = spark.read.parquet(log).select("row_count", years, "rejected")
    read = spark.read.parquet(target).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.countDistinct("player_id").alias("players_read"),
        F.sum("sofifa_id").alias("ids_read"),
    )
    return logged.join(read)


def incremental_load(spark, sf):
    """A whole load, then one after a season changed and another went: only these are touched."""
    manifest, _ = _season_files(spark, sf)
    folder = scratch_path(spark, "incremental")
    places = f"{folder}/players", f"{folder}/log", f"{folder}/seasons"
    first = load_changed_seasons(spark, manifest, *places, expected={})
    changed = next(e for e in manifest if (e.group, e.year) == ("F", 1995))
    rows = stored(spark.read.csv(changed.path, header=True), "changed")
    rows.withColumn("Nationality", F.lit("Changed")).write.mode("overwrite").csv(changed.path, header=True)
    left = [e for e in manifest if (e.group, e.year) != ("O", 1997)]
    second = load_changed_seasons(spark, left, *places, expected={})
    touched = [first.loaded, second.loaded, second.removed]
    if [len(t) for t in touched] != [len(manifest), 1, 1]:
        raise RuntimeError(f"seasons touched: {touched}")
    return read_roster(spark, places[0]).select("player_id", "nationality_name", "value_eur", "year", "gender")


def standardize_season(spark, sf):
    """One season's raw columns under untidy headers, on their own."""
    orders = _table(spark, sf, "orders").where(_in_year("o_orderdate", 1998))
    raw = orders.select(
        F.col("o_custkey").cast("double").alias("Sofifa ID"),
        F.col("o_orderkey").cast("string").alias("Name"),
        F.col("o_orderpriority").alias("Nationality"),
    )
    season = standardize_roster(raw, 1998, "Male")
    return season.select("player_id", "sofifa_id", "short_name", "nationality_name", "gender", "year")


def numeric_ids(spark, sf):
    """Ids as doubles and as texts with an exponent: none is lost."""
    orders = _table(spark, sf, "orders")
    number = (F.col("o_orderkey") * 1000).cast("double")
    doubles = op.ensure_entity_key(orders.select("o_orderkey", number.alias("sofifa_id")))
    texts = op.ensure_entity_key(orders.select("o_orderkey", number.cast("string").alias("sofifa_id")))
    return doubles.union(texts)


def manifest_gaps(spark, sf):
    def day(column):
        return F.date_format(column, "yyyyMMdd").cast("int").alias("year")

    orders = _table(spark, sf, "orders")
    lineitem = _table(spark, sf, "lineitem")
    expected = orders.select(F.col("o_orderstatus").alias("group"), day("o_orderdate")).distinct()
    manifest = lineitem.select(F.col("l_linestatus").alias("group"), day("l_shipdate"))
    return sources.check_manifest(expected, manifest)


def write_read_roster(spark, sf):
    target = scratch_path(spark, "roster")
    sinks.write_roster(_roster(spark, sf), target)
    return spark.read.parquet(target)


def write_chunks(spark, sf):
    target = scratch_path(spark, "chunks")
    roster = _roster(spark, sf)
    chunks = [roster.where(F.col("gender") == g) for g in ("f", "o")]
    rest = roster.where(~F.col("gender").isin("f", "o")).drop("club_name")
    sinks.write_roster_chunks([*chunks, rest], target)
    return spark.read.parquet(target)


def append_roster(spark, sf):
    target = scratch_path(spark, "appended")
    roster = _roster(spark, sf)
    sinks.write_roster(roster.where("gender = 'f'"), target)
    sinks.write_roster(roster.where("gender <> 'f'"), target, mode="append")
    return spark.read.parquet(target)


def replace_seasons(spark, sf):
    """Of a whole roster one season is written again, with other clubs."""
    target = scratch_path(spark, "replaced")
    sinks.write_roster(_roster(spark, sf), target)
    changed = _roster(spark, sf, 1998).withColumn("club_name", F.lit("Other club"))
    sinks.write_roster(changed, target, mode="replace_seasons")
    return spark.read.parquet(target)


def replace_table(spark, sf):
    """A table that exists is replaced; its database is made on the way."""
    sinks.ensure_database(spark, "squadbook_queries")
    table = f"squadbook_queries.players_{uuid.uuid4().hex}"
    sinks.write_roster(_roster(spark, sf, 1997), table)
    sinks.write_roster(_roster(spark, sf, 1998), table)
    stored_rows = stored(spark.table(table), "players")
    spark.sql(f"DROP TABLE {table}")
    return stored_rows


def ingestion_log(spark, sf):
    log = scratch_path(spark, "log")
    price = F.col("o_totalprice").cast("decimal(15,2)").alias("price")
    year = F.year("o_orderdate").alias("year")
    roster = _table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", price, "o_orderpriority", year
    )
    sinks.log_ingestion(roster, [sources.SeasonFile("all", 2001, "orders.parquet")], log)
    stored = spark.read.parquet(log)
    return stored.select(
        "row_count",
        F.array_join(F.col("years").cast("array<string>"), ",").alias("years"),
        "source_files",
        "checksum",
    )


# Comment pages


def _search_pages(spark, sf) -> DataFrame:
    """Each document as a landed page of its source's search: one result per line."""
    results = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.struct(line.alias("videoId")).alias("id"))
    )
    return _table(spark, sf, "documents").select(
        F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("term_no"),
        F.col("doc_id").alias("page_no"),
        F.to_json(F.struct(results.alias("items"))).alias("page"),
    )


def extract_video_ids(spark, sf):
    return sources.extract_video_ids(_search_pages(spark, sf), per_term=25)


def extract_all_video_ids(spark, sf):
    return sources.extract_video_ids(_search_pages(spark, sf))


def _comment_pages(spark, sf) -> DataFrame:
    """Each turn as a landed page: one comment per line, some without author or text."""
    author = F.when(F.col("role") != "system", F.col("role")).alias("authorDisplayName")

    def item(line, at):
        shown = F.when(line != "", line).alias("textDisplay")
        comment = F.struct(F.struct(author, shown).alias("snippet")).alias("topLevelComment")
        comment_id = F.concat_ws("-", "conv_id", "turn", at)
        return F.struct(comment_id.alias("id"), F.struct(comment).alias("snippet"))

    items = F.transform(F.split("text", "\n"), item)
    return _table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.col("conv_id").alias("video_ord"),
        F.col("turn").alias("page_no"),
        F.to_json(F.struct(items.alias("items"))).alias("page"),
    )


def extract_comments(spark, sf):
    return sources.extract_comments(_comment_pages(spark, sf))


def _damaged_pages(spark, sf) -> DataFrame:
    """Comment pages, of which those of assistant turns lose their last character."""
    cut_off = F.col("author").eqNullSafe("assistant")
    pages = _comment_pages(spark, sf).withColumn(
        "author", F.get_json_object("page", "$.items[0].snippet.topLevelComment.snippet.authorDisplayName")
    )
    shortened = F.expr("substring(page, 1, length(page) - 1)")
    return pages.withColumn("page", F.when(cut_off, shortened).otherwise(F.col("page"))).drop("author")


def split_corrupt(spark, sf):
    parsed = sources.parse_pages(_damaged_pages(spark, sf), COMMENT_PAGE_SCHEMA)
    items = F.when(~F.col("broken"), F.size("parsed.items")).alias("items")
    return parsed.select("video_id", "page_no", items)


def dump_comments(spark, sf):
    target = scratch_path(spark, "dump")
    conversations = _table(spark, sf, "conversations")
    sinks.dump_comments(conversations, target)
    return spark.read.schema(conversations.schema).json(target)


# Mentions


def alias_dim(spark, sf):
    return op.build_alias_dim(_table(spark, sf, "part"), "p_brand", "p_name")


def whole_word_filter(spark, sf):
    documents = _table(spark, sf, "documents")
    return documents.where(contains_phrase(F.col("text"), F.lit("Of the"))).select("doc_id")


def escaped_phrase_filter(spark, sf):
    """A phrase of characters that are operators in a pattern."""
    documents = _table(spark, sf, "documents")
    return documents.where(contains_phrase(F.col("text"), F.lit("the***"), "loose")).select("doc_id")


def match_mentions(spark, sf):
    return op.match_mentions(_table(spark, sf, "conversations"), _aliases(spark, sf), TURN)


def _turn_counts(spark, sf):
    return op.count_mentions(_table(spark, sf, "conversations"), _aliases(spark, sf))


def count_mentions(spark, sf):
    return _turn_counts(spark, sf)


def count_mentions_by_key(spark, sf):
    """Turns of one conversation are one comment."""
    return op.count_mentions(_table(spark, sf, "conversations"), _aliases(spark, sf), ["conv_id"])


def count_comments_without_id(spark, sf):
    """Landed pages whose comments have no id: each counts all the same."""
    no_ids = F.regexp_replace("page", r'"id":"[0-9-]*",', "")
    comments = sources.extract_comments(_comment_pages(spark, sf).withColumn("page", no_ids))
    return op.count_mentions(comments.where("comment_id = ''"), _aliases(spark, sf))


def count_loose_mentions(spark, sf):
    """Names end in a full stop where a passage does."""
    documents = _table(spark, sf, "documents")
    return op.count_mentions(documents, _aliases(spark, sf), boundary="loose")


def count_document_mentions(spark, sf):
    return op.count_mentions(_table(spark, sf, "documents"), _aliases(spark, sf))


def count_document_mentions_unbroadcast(spark, sf):
    documents = _table(spark, sf, "documents")
    return op.count_mentions(documents, _aliases(spark, sf), broadcast_bytes=0)


def match_long_passages(spark, sf):
    """The first 30 words of passages as names: many more segments than a run has."""
    words = F.split("text", r"[ \n]+", 31)
    passages = _table(spark, sf, "benchmark").select(
        F.concat_ws(" ", F.lit("Passage"), "item_id").alias("short_name"),
        F.array_join(F.slice(words, 1, 30), " ").alias("long_name"),
    )
    documents = _table(spark, sf, "documents")
    # A text is one line, as passages are.
    lines = documents.withColumn("text", F.regexp_replace("text", r"[ \n]+", " "))
    # Anchors decide about time alone, so a sample tells well enough what words are frequent.
    aliases = op.prepare_aliases(op.build_alias_dim(passages), texts=lines.sample(0.05, seed=1))
    return op.match_mentions(lines, aliases, ["doc_id"])


def top_mention(spark, sf):
    return op.top_mention(_turn_counts(spark, sf), on_empty="empty")


def mention_summary(spark, sf):
    return op.mention_summary(_turn_counts(spark, sf))


# Streams


def _stream(spark, sf, name) -> DataFrame:
    schema = _table(spark, sf, name).schema
    path = f"{sf}/{name}*.parquet"
    return streaming.read_comment_stream(spark, path, schema, 1000, file_format="parquet")


def _count_stream(spark, sf) -> tuple[str, str]:
    folder = scratch_path(spark, "stream")
    counts, dump = f"{folder}/counts", f"{folder}/dump"
    streaming.stream_mentions(
        _stream(spark, sf, "conversations"),
        _aliases(spark, sf),
        counts,
        f"{folder}/checkpoint",
        dump_path=dump,
    ).awaitTermination()
    return counts, dump


def stream_mentions(spark, sf):
    counts, _ = _count_stream(spark, sf)
    return streaming.read_mention_totals(spark, counts)


def stream_dump(spark, sf):
    _, dump = _count_stream(spark, sf)
    schema = _table(spark, sf, "conversations").schema
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(dump)


def _appended(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    folder = scratch_path(spark, label)
    writer = stream.writeStream.format("parquet").outputMode("append")
    query = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    query.start(f"{folder}/rows").awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


def stream_dedup(spark, sf):
    events = _stream(spark, sf, "events").select("user_id", "event_type", "event_id")
    unique = streaming.stream_dedup(events, ["user_id", "event_type"], spread_by=["event_id"])
    return _appended(unique.select("user_id", "event_type"), "unique")


def _landed(rows: DataFrame, label: str, batches: int = 4) -> DataFrame:
    """Rows as a stream of several micro-batches: written to a landing folder, some files at a time read.

    A micro-batch has as many files as it takes for each to be no more than a split of the input,
    so what one task writes does not grow with the tables.
    """
    spark = rows.sparkSession
    landing = scratch_path(spark, label)
    files = max(1, -(-rows.rdd.getNumPartitions() // batches))
    rows.repartition(batches * files).write.parquet(landing)
    return streaming.read_comment_stream(spark, landing, rows.schema, files, file_format="parquet")


def running_mentions(spark, sf):
    """Totals as they stand after the last micro-batch, kept in state and folded on the way."""
    folder = scratch_path(spark, "running")
    turns = _landed(_table(spark, sf, "conversations").select("text"), "turns")
    running = streaming.running_mentions(turns, _aliases(spark, sf))
    keys = ["canonical"]
    streaming.write_running(
        running, f"{folder}/totals", f"{folder}/checkpoint", keys, compact_every=3
    ).awaitTermination()
    return streaming.read_running(spark, f"{folder}/totals", running.schema, keys)


def compacted_mentions(spark, sf):
    """Counts of batches, of which the older ones are in a snapshot."""
    folder = scratch_path(spark, "compacted")
    turns = _landed(_table(spark, sf, "conversations").select("text"), "turns")
    streaming.stream_mentions(
        turns, _aliases(spark, sf), f"{folder}/counts", f"{folder}/checkpoint", compact_every=3
    ).awaitTermination()
    return streaming.read_mention_totals(spark, f"{folder}/counts")


def stream_dedup_within(spark, sf):
    """The first of each user's events of a kind a day; the days come one after another."""
    landing = scratch_path(spark, "events")
    events = _table(spark, sf, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("arrived_at")
    )
    for first in (1, 9, 17, 25):
        part = events.where(F.day("day").between(first, first + 7))
        part.write.mode("append").parquet(landing)
    stream = streaming.read_comment_stream(spark, landing, events.schema, 1, file_format="parquet")
    unique = streaming.stream_dedup(
        stream, ["user_id", "event_type", "day"], arrival="arrived_at", within="9 days"
    )
    rows = _appended(unique.drop("arrived_at"), "daily")
    return rows.withColumn("day", F.col("day").cast("timestamp_ntz"))


def stream_quarantine(spark, sf):
    """Pages parsed as they come, the broken ones set aside."""
    folder = scratch_path(spark, "quarantine")
    pages = _damaged_pages(spark, sf)
    query = streaming.stream_split_corrupt(
        _landed(pages, "pages"), COMMENT_PAGE_SCHEMA, f"{folder}/out", f"{folder}/checkpoint"
    )
    query.awaitTermination()
    place = (spark, f"{folder}/out", pages.schema, COMMENT_PAGE_SCHEMA)
    good = streaming.read_good_pages(*place).select(
        "video_id", "page_no", F.size("parsed.items").alias("items"), F.lit(False).alias("broken")
    )
    broken = streaming.read_broken_pages(*place).select(
        "video_id", "page_no", F.lit(None).cast("int").alias("items"), F.lit(True).alias("broken")
    )
    return good.union(broken)


def _running_rows(running: DataFrame, label: str, keys: list[str]) -> DataFrame:
    spark = running.sparkSession
    folder = scratch_path(spark, label)
    query = streaming.write_running(running, f"{folder}/rows", f"{folder}/checkpoint", keys, compact_every=3)
    query.awaitTermination()
    return streaming.read_running(spark, f"{folder}/rows", running.schema, keys)


def stream_video_ids(spark, sf):
    ids = streaming.stream_video_ids(_landed(_search_pages(spark, sf), "search"))
    return _running_rows(ids, "ids", ["video_id"])


def stream_comments(spark, sf):
    comments = streaming.stream_comments(_landed(_comment_pages(spark, sf), "pages"))
    return _running_rows(comments, "comments", ["video_id", "comment_id"])


def stream_log(spark, sf):
    """One record for each micro-batch; together they are what a load would log."""
    folder = scratch_path(spark, "stream-log")
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    log = streaming.BatchLog(spark, "orders", f"{folder}/log")
    spark.streams.addListener(log)
    try:
        watched = streaming.observed(_landed(orders, "orders"), "orders")
        writer = watched.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        query = writer.trigger(availableNow=True).start(f"{folder}/rows")
        query.awaitTermination()
        if not log.wait(query):
            raise TimeoutError("the log has not come as far as the stream")
    finally:
        spark.streams.removeListener(log)
    records = streaming.read_batch_log(spark, f"{folder}/log")
    years = F.array_sort(F.array_distinct(F.flatten(F.collect_list("years"))))
    return records.agg(
        F.sum("row_count").alias("row_count"),
        F.array_join(years.cast("array<string>"), ",").alias("years"),
        F.sum(F.col("checksum").cast("decimal(38,0)")).cast("string").alias("checksum"),
    )


def stream_take(spark, sf):
    folder = scratch_path(spark, "taken")
    events = _stream(spark, sf, "events").select("event_id")
    streaming.write_first(events, 1000, f"{folder}/rows", f"{folder}/checkpoint")
    taken = spark.read.parquet(f"{folder}/rows")
    known = _table(spark, sf, "events").select("event_id", F.lit(1).alias("known"))
    return taken.join(known, "event_id", "left").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.countDistinct("event_id").alias("n_distinct"),
        F.count("known").alias("n_known"),
    )


QUERIES = {
    query.__name__: query
    for query in (
        top_groups_by_count,
        large_groups_by_count,
        top_segments_by_count,
        rank_groups_by_avg_desc,
        rank_groups_by_avg_asc,
        mode_per_partition,
        unique_entity_histogram,
        count_by,
        roster_cohort,
        take_first,
        dedup_first,
        expiring_contracts,
        average_age_ranking,
        popular_nationality,
        nationality_histogram,
        clean_numbers,
        clean_timestamps,
        entity_key_from_url,
        composite_ids,
        normalize_and_alias,
        union_conform,
        build_roster_from_files,
        load_roster_from_files,
        standardize_season,
        numeric_ids,
        manifest_gaps,
        write_read_roster,
        append_roster,
        replace_seasons,
        replace_table,
        write_chunks,
        ingestion_log,
        extract_video_ids,
        extract_all_video_ids,
        extract_comments,
        split_corrupt,
        dump_comments,
        alias_dim,
        whole_word_filter,
        escaped_phrase_filter,
        match_mentions,
        match_long_passages,
        count_mentions,
        count_mentions_by_key,
        count_comments_without_id,
        count_loose_mentions,
        count_document_mentions,
        count_document_mentions_unbroadcast,
        top_mention,
        mention_summary,
        most_discussed_player,
        stream_mentions,
        stream_dump,
        stream_dedup,
        stream_take,
        running_mentions,
        compacted_mentions,
        stream_dedup_within,
        stream_quarantine,
        stream_video_ids,
        stream_comments,
        stream_log,
        incremental_load,
        bucketed_histogram,
    )
}
