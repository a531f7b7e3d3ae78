"""Benchmark questions in documents, also with other numbers, names and units.

Built-in functions only. Words become template tokens: numbers, numbers with a unit, units
behind a number and names turn into typed placeholders, all else is lower case without
punctuation. A name is a capitalised word inside a sentence; one that opens a sentence is a name
if the same word is one elsewhere in the text. Windows of ``WINDOW`` tokens are hashed and joined with those of
the benchmark. A document that was found to follow an item over enough windows must also
fill its slots consistently: along its alignments each value of the item stands for one value
in the document and each value in the document for one of the item.

Null and empty texts have no windows, nor have items and documents shorter than a window.
Rows with one id are documents of their own. Items that occur twice are found as two items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadbook.llm.filters import without_rows
from squadbook.runtime import stored

WINDOW = 8
# Of a window's tokens so many must be words, or any list of numbers would match any other.
MIN_LITERALS = 5
# Windows of the benchmark (32 bytes each) that are broadcast; beyond, both sides are shuffled.
MAX_BROADCAST_WINDOWS = 1_000_000

# Words that are units behind a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms "
    "pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons second "
    "seconds minute minutes hour hours day days week weeks month months year years percent "
    "dollar dollars cent cents euro euros degree degrees mph kmh watt watts volt volts"
).split()

NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
_MARKS = ".,;:!?\"'()[]{}<>*#$%&|~-_/\\\\"


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def bare(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(_MARKS)))


def template_tokens(words: str) -> Column:
    """One token for each word of an array; cheap comparisons come first, few words meet a pattern."""
    units = F.array(*[F.lit(u) for u in UNITS])

    def starts_with_digit(word: Column) -> Column:
        return F.ascii(word).between(48, 57)

    def capital(i: Column) -> Column:
        word = F.get(words, i)
        return (word >= "A") & (word < "[") & (F.substring(word, 2, 1) >= "a")

    def opens(i: Column) -> Column:
        """Whether a word opens the text or a sentence."""
        return F.coalesce(F.get(words, i - 1).rlike(r"[.!?:]\W*$"), F.lit(True))

    def tokens(cores: Column, names: Column) -> Column:
        def token(core: Column, i: Column) -> Column:
            number = F.when(core.rlike(r"^[0-9][0-9.,:/-]*$"), F.lit(NUMBER)).when(
                core.rlike(r"^[0-9][0-9.,]*[a-z%]+$"), F.lit(NUMBER + UNIT)
            )
            return (
                F.when(starts_with_digit(core), F.coalesce(number, core))
                .when(capital(i) & (~opens(i) | F.array_contains(names, core)), F.lit(NAME))
                .when(starts_with_digit(F.get(words, i - 1)) & F.array_contains(units, core), F.lit(UNIT))
                .otherwise(core)
            )

        return F.transform(cores, token)

    def named(cores: Column) -> Column:
        inside = F.array_distinct(F.filter(cores, lambda core, i: capital(i) & ~opens(i)))
        return F.get(F.transform(F.array(inside), lambda names: tokens(cores, names)), F.lit(0))

    # The bare words are a lambda's argument, so each is computed once; so are the names.
    return F.get(F.transform(F.array(F.transform(words, bare)), named), F.lit(0))


def windows(hashes: str, size: str) -> Column:
    """Hashes of all windows, each with its start; none for a shorter text."""
    every = (
        f"transform(sequence(1, {size} - {WINDOW - 1}), i -> xxhash64(slice({hashes}, i, {WINDOW})))"
    )
    return F.expr(f"if({size} >= {WINDOW}, {every}, cast(array() as array<bigint>))")


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, item_row, at, h, n, words, tokens``: a row for each distinct place of an item."""
    items = benchmark.select(
        F.monotonically_increasing_id().alias("item_row"),
        F.col(item_id).alias("item_id"),
        raw_words(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("words"),
    )
    items = items.withColumn("tokens", template_tokens("words"))
    items = items.withColumn("hashes", F.transform("tokens", lambda t: F.xxhash64(t)))
    cut = items.withColumn("windows", windows("hashes", "size(hashes)"))
    placed = cut.select(
        "item_row", "item_id", "words", "tokens", F.posexplode_outer("windows").alias("at", "h")
    )
    slots = F.array(F.lit(NUMBER), F.lit(UNIT), F.lit(NAME), F.lit(NUMBER + UNIT))
    placed = placed.select(
        "item_row",
        "item_id",
        "at",
        "h",
        F.slice("words", F.col("at") + 1, WINDOW).alias("item_words"),
        F.slice("tokens", F.col("at") + 1, WINDOW).alias("item_tokens"),
    )
    literal = F.size(F.filter("item_tokens", lambda t: ~F.array_contains(slots, t)))
    return placed.where(literal >= MIN_LITERALS)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_cover: float = 0.5,
    row: str | None = None,
    broadcast_windows: int = MAX_BROADCAST_WINDOWS,
) -> DataFrame:
    """``row, doc_id, item_id, n_windows, item_windows, n_slots`` of documents and items in them.

    ``row`` is the column of that name, or numbers the rows as they are read. An item is in a document if at
    least ``min_cover`` of its windows match and its slots are filled consistently, or if so
    many windows without slots match. An item's distinct windows are added up over all
    alignments whose fills agree, so that words put in or left out in the middle do not hide it.

    The benchmark's windows are stored and counted, and broadcast only within a bound; then
    documents are a scan that ends in the few matches. Beyond, windows of documents are
    shuffled by their hash, and words are fetched afterwards for the rows that matched.
    """
    items = stored(benchmark_windows(benchmark, item_id, item_text), "item-windows")
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(
        number.alias("row"),
        F.col(doc_id).alias("doc_id"),
        raw_words(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("words"),
    )
    small = items.count() <= broadcast_windows
    if not small:
        rows = stored(rows, "document-words")
    hashed = rows.withColumn(
        "hashes", F.transform(template_tokens("words"), lambda t: F.xxhash64(t))
    ).withColumn("windows", windows("hashes", "size(hashes)"))
    window = F.slice("words", F.col("pos") + 1, WINDOW).alias("doc_words")
    if small:
        placed = hashed.select("row", "doc_id", "words", F.posexplode_outer("windows").alias("pos", "h"))
        matched = placed.join(F.broadcast(items), "h").drop("h").withColumn("doc_words", window)
        matched = matched.drop("words")
    else:
        placed = hashed.select("row", F.posexplode_outer("windows").alias("pos", "h"))
        found = placed.join(items, "h").drop("h")
        matched = found.join(rows, "row").withColumn("doc_words", window).drop("words")
    matched = stored(matched, "matches")
    return _consistent(matched, items, min_cover)


def _one_to_one(fills: Column) -> Column:
    from_item = F.array_distinct(F.transform(fills, lambda f: F.struct(f["kind"], f["item"])))
    from_doc = F.array_distinct(F.transform(fills, lambda f: F.struct(f["kind"], f["doc"])))
    return (F.size(from_item) == F.size(fills)) & (F.size(from_doc) == F.size(fills))


def _over_shifts(by_place: DataFrame) -> DataFrame:
    """``row, doc_id, item_row, item_id, n_windows, n_slots``: alignments that agree as one.

    The alignment with most windows comes first; each further one whose fills agree with those
    taken adds its windows, any other only its windows without slots. If no fills are taken,
    the first alignment's are counted.
    """
    good = F.when(_one_to_one(F.col("fills")), F.size("places")).otherwise(F.size("plain_places"))
    shift = F.struct((-good).alias("order"), (-F.size("fills")).alias("slots"), "shift", "places", "plain_places", "fills")
    shifts = by_place.groupBy("row", "doc_id", "item_row", "item_id").agg(
        F.sort_array(F.collect_list(shift)).alias("shifts")
    )

    def add(taken: Column, each: Column) -> Column:
        # The joint fills are a lambda's argument, so they are computed once.
        joint = F.array(F.array_union(taken["fills"], each["fills"]))
        agree = F.get(F.transform(joint, _one_to_one), F.lit(0))
        return F.struct(
            F.array_union(
                taken["places"], F.when(agree, each["places"]).otherwise(each["plain_places"])
            ).alias("places"),
            F.when(agree, F.get(joint, F.lit(0))).otherwise(taken["fills"]).alias("fills"),
        )

    none = F.struct(
        F.slice(F.get("shifts.places", F.lit(0)), 1, 0).alias("places"),
        F.slice(F.get("shifts.fills", F.lit(0)), 1, 0).alias("fills"),
    )
    taken = shifts.withColumn("taken", F.aggregate("shifts", none, add))
    return taken.select(
        "row",
        "doc_id",
        "item_row",
        "item_id",
        F.size("taken.places").cast("bigint").alias("n_windows"),
        F.when(F.size("taken.fills") > 0, F.size("taken.fills"))
        .otherwise(-F.get("shifts.slots", F.lit(0)))
        .cast("bigint")
        .alias("n_slots"),
    )


def _consistent(matched: DataFrame, items: DataFrame, min_cover: float) -> DataFrame:
    slots = F.array(F.lit(NUMBER), F.lit(UNIT), F.lit(NAME), F.lit(NUMBER + UNIT))
    triples = F.filter(
        F.arrays_zip("item_tokens", "item_words", "doc_words"),
        lambda t: F.array_contains(slots, t["item_tokens"]),
    )

    fills = F.transform(
        triples,
        lambda t: F.struct(
            t["item_tokens"].alias("kind"),
            bare(t["item_words"]).alias("item"),
            bare(t["doc_words"]).alias("doc"),
        ),
    )
    aligned = ["row", "doc_id", "item_row", "item_id", "shift"]
    by_place = (
        matched.select(
            "row",
            "doc_id",
            "item_row",
            "item_id",
            (F.col("pos") - F.col("at")).alias("shift"),
            "at",
            fills.alias("fills"),
        )
        .groupBy(*aligned)
        .agg(
            F.array_distinct(F.flatten(F.collect_set("fills"))).alias("fills"),
            F.collect_set("at").alias("places"),
            F.collect_set(F.when(F.size("fills") == 0, F.col("at"))).alias("plain_places"),
        )
    )
    counts = items.groupBy("item_row").agg(F.count(F.lit(1)).alias("item_windows"))
    judged = _over_shifts(by_place).join(counts, "item_row")
    enough = judged.where(F.col("n_windows") >= F.col("item_windows") * min_cover)
    return enough.select("row", "doc_id", "item_id", "n_windows", "item_windows", "n_slots")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of the benchmark."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    )
    rows = stored(rows, "documents")
    doc_id, text = options.pop("doc_id", "doc_id"), options.pop("text", "text")
    searched = rows.select("row", F.col(f"doc.`{doc_id}`").alias("doc_id"), F.col(f"doc.`{text}`").alias("text"))
    found = contaminated(searched, benchmark, row="row", **options).select("row").distinct()
    return without_rows(rows, stored(found, "contaminated-rows"), "row").select("doc.*")
