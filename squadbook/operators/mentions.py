"""Whole-word mentions of aliases in texts, as an equi-join.

A text is cut at every word boundary. An alias occurs as whole words exactly where a
run of consecutive segments spells it, so joining the runs of a text with the aliases
by equality finds every mention and nothing else: no pattern is tried per alias. The
alias table has one row per alias, so a frequent word never meets more than one alias row.

Runs are spelled within the row, where some alias begins like that, and those that no alias has
by the flags of their hashes go before anything is joined. What is left is distinct within the row, so counting shuffles
names and numbers, never texts or rows of texts.

Runs have at most ``MAX_RUN`` segments, whatever the aliases: a longer alias is joined by an
anchor, the run of it that is rarest, and only the places found there are compared with the
rest of it. So long aliases that begin alike do not meet each other's texts.

A small alias table is broadcast. A large one meets counted runs (counting) or runs that are
salted by their comment (matching) in a shuffle.

With ``boundary="word"`` an alias stands between word boundaries, so one that ends in ``.``
needs a word character behind it. With ``"loose"`` it must not touch a word character on
either side. Then non-word characters are cut one by one and the neighbours are looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import segments, strip
from ..functions.text import WORD
from ..runtime import stored

ALIAS, CANONICAL, MENTIONS = "alias", "canonical", "mentions"
BOUNDARIES = ("word", "loose")

# Segments of a run; what goes beyond them is compared where a run has been found.
MAX_RUN = 8

# Alias bytes up to which the table is broadcast; a hash table takes several times this.
BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64

# There are 16 flags for each alias, up to this power of two (4 MB).
_MAX_FLAG_BITS = 22

# Words are counted in so many buckets of their hashes, to choose anchors by.
_BUCKETS = 1 << 13

# A frequent run is spread over this many tasks when matches are listed.
_SALTS = 32

_TEXT, _FLAGS, _PHRASE, _RUN, _SALT = "__text", "__flags", "__phrase", "__run", "__salt"


class EmptyResultError(RuntimeError):
    """A report has nothing to report on."""


def build_alias_dim(
    df: DataFrame, short: str = "short_name", long: str = "long_name"
) -> DataFrame:
    """``alias, canonical``: stripped short names, reached by short and by long name.

    Aliases are lower case; an alias of several canonical names keeps the smallest.
    """
    canonical = strip(F.col(short))
    long_alias = F.when(strip(F.col(long)) != "", F.lower(long))
    names = df.select(canonical.alias(CANONICAL), long_alias.alias("__long"))
    spelled = names.where(F.col(CANONICAL) != "").select(
        F.explode(F.array(F.lower(CANONICAL), F.col("__long"))).alias(ALIAS), CANONICAL
    )
    return spelled.where(F.col(ALIAS).isNotNull()).groupBy(ALIAS).agg(
        F.min(CANONICAL).alias(CANONICAL)
    )


def _is_word(segment: Column) -> Column:
    return segment.rlike(f"^[{WORD}]")


@dataclass(frozen=True)
class AliasTable:
    """Aliases made ready for mention joins: a stored table and what was measured on it.

    A shape is (starts with a word, ends with one, segments) of a run: a whole alias, or the
    anchor of a long one, whose end does not count; so there are few of them whatever the
    aliases. ``flags`` is a stored row that tells by their hashes what may be a run, or begin one.
    """

    names: DataFrame
    flags: DataFrame
    flag_bits: int
    boundary: str
    size: int
    shapes: tuple[tuple[bool, bool, int], ...]
    anchors: tuple[bool, ...]
    longest: int


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bucket(segment: Column) -> Column:
    return F.xxhash64(segment).bitwiseAND(F.lit(_BUCKETS - 1)).cast("int")


def _frequencies(cuts: Iterable[DataFrame]) -> Column:
    """How often segments of a bucket occur in the frames of ``cut`` arrays, as an array."""
    counts = [0] * _BUCKETS
    for cut in cuts:
        each = cut.select(F.explode("cut").alias("segment")).where(_is_word(F.col("segment")))
        for bucket, n in each.groupBy(_bucket(F.col("segment"))).count().collect():
            counts[bucket] += n
    # One foldable string, so the plan holds a single literal.
    return F.split(F.lit(",".join(map(str, counts))), ",").cast("array<bigint>")


def _anchor(cut: Column, frequencies: Column) -> Column:
    """Where the rarest ``MAX_RUN`` segments of a long alias are, judged by their rarest word.

    Anchors start with a word if there is one to start with; of equal ones the first is taken.
    """
    weighed = F.transform(
        cut, lambda x: F.when(_is_word(x), F.get(frequencies, _bucket(x))).otherwise(F.lit(1 << 62))
    )

    def judged(weights: Column) -> Column:
        places = F.transform(
            F.sequence(F.lit(0), F.size(weights) - MAX_RUN),
            lambda i: F.struct(
                (F.get(weights, i) == 1 << 62).alias("other"),
                F.least(*(F.get(weights, i + k) for k in range(MAX_RUN))).alias("weight"),
                i.alias("at"),
            ),
        )
        return F.array_min(places)["at"]

    return _let(weighed, judged)


def prepare_aliases(
    aliases: DataFrame, boundary: str = "word", texts: DataFrame | None = None, text: str = "text"
) -> AliasTable:
    """Group aliases by lower-cased spelling, cut them, and store them for several joins.

    Aliases that meet in one spelling become one, of the smallest canonical name; empty ones
    are dropped. The table lies in scratch space, see ``runtime.discard``.

    An alias longer than a run is looked for by an anchor, its rarest run. How frequent words
    are is taken from the aliases themselves, which tells common beginnings, and from ``texts``
    where they, or a sample of them, are given. Anchors decide about time, not results.
    """
    if boundary not in BOUNDARIES:
        raise ValueError(f"boundary must be one of {BOUNDARIES}")
    single = boundary == "loose"
    spelled = aliases.where(F.col(ALIAS) != "").groupBy(F.lower(ALIAS).alias(_PHRASE))
    names = spelled.agg(F.min(CANONICAL).alias(CANONICAL))
    names = stored(names.withColumn("cut", segments(F.col(_PHRASE), single)), "alias-cuts")
    longest = names.agg(F.max(F.size("cut"))).first()[0] or 0
    at = F.lit(0)
    if longest > MAX_RUN:
        cuts = [names.where(F.size("cut") > MAX_RUN).select("cut")]
        if texts is not None:
            cuts.append(texts.select(segments(F.lower(text), single).alias("cut")))
        at = F.when(F.size("cut") > MAX_RUN, _anchor(F.col("cut"), _frequencies(cuts))).otherwise(at)
    # An outer explode keeps the anchor from being computed for each use.
    names = names.withColumn("at", F.explode_outer(F.array(at))).select(
        _PHRASE,
        CANONICAL,
        F.size("cut").alias("n"),
        F.array_join(F.slice("cut", F.col("at") + 1, F.lit(MAX_RUN)), "").alias(_RUN),
        "at",
        F.get("cut", "at").alias("head"),
        _is_word(F.get("cut", "at")).alias("starts"),
        _is_word(F.element_at("cut", -1)).alias("ends"),
    )
    names = stored(names, "aliases")
    shape = F.struct("starts", "ends", "n")
    row = names.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length(_PHRASE) * 3 + F.octet_length(CANONICAL) + _ROW_OVERHEAD).alias("size"),
        F.collect_set(F.when(F.col("n") <= MAX_RUN, shape)).alias("shapes"),
        F.collect_set(F.when(F.col("n") > MAX_RUN, F.col("starts"))).alias("anchors"),
    ).first()
    flag_bits = min(max((16 * row["rows"]).bit_length(), 10), _MAX_FLAG_BITS)
    return AliasTable(
        names,
        stored(_flags(names, flag_bits), "alias-flags"),
        flag_bits,
        boundary,
        row["size"] or 0,
        tuple(sorted(map(tuple, row["shapes"]))),
        tuple(sorted(row["anchors"])),
        longest,
    )


def _prepared(aliases: DataFrame | AliasTable, boundary: str) -> AliasTable:
    return aliases if isinstance(aliases, AliasTable) else prepare_aliases(aliases, boundary)


def _slot(run: Column, flag_bits: int) -> Column:
    return F.hash(run).bitwiseAND(F.lit((1 << flag_bits) - 1))


def _flags(names: DataFrame, flag_bits: int) -> DataFrame:
    """One row with an array of flags: those of the hashes of runs and of their first segments."""
    each = names.select(F.explode(F.array(_RUN, "head")).alias("part"))
    slots = each.select(_slot(F.col("part"), flag_bits).cast("bigint").alias("id"), F.lit(True).alias("flag"))
    every = names.sparkSession.range(1 << flag_bits).join(slots.distinct(), "id", "left")
    ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("flag", F.lit(False)).alias("flag"))))
    return every.agg(F.transform(ordered, lambda x: x["flag"]).alias("flags"))


def _begins(cut: Column, table: AliasTable, starts: bool) -> Column:
    """Where in a cut text runs may begin, with a word or not.

    The blanks around a text make its first and last segment a non-word one each. Both are
    left out, as they touch no boundary on their outer side: in word mode the last one is cut
    off, so that a run beyond it is null.
    """
    last = F.size(cut) - _outer(table)
    first, step = 1, 1
    if table.boundary == "word":  # words and others take turns
        first, step = (1 if starts else 2), 2
    none = F.array().cast("array<int>")
    places = F.when(last >= first, F.sequence(F.lit(first), last, F.lit(step))).otherwise(none)
    if table.boundary == "word":
        return places
    if starts:
        return F.filter(places, lambda i: _is_word(F.get(cut, i)))
    return F.filter(places, lambda i: ~_is_word(F.get(cut, i)) & ~_is_word(F.get(cut, i - 1)))


def _outer(table: AliasTable) -> int:
    """Segments of a cut text that no run may hold."""
    return 1 if table.boundary == "word" else 2


def _fits(cut: Column, table: AliasTable, ends: bool | None, n: int, place: Column) -> Column:
    """Whether ``n`` segments from a place on are within the text and end right, or anyhow."""
    inside = place + n <= F.size(cut) - _outer(table) + 1
    if ends is None:
        return inside
    last, behind = _is_word(F.get(cut, place + (n - 1))), _is_word(F.get(cut, place + n))
    return inside & (last if ends else ~last & ~behind)


def _known(part: Column, flags: Column, table: AliasTable) -> Column:
    """Whether something is flagged by its hash; where not, no alias has such a run, or beginning."""
    return F.get(flags, _slot(part, table.flag_bits))


def _with_flags(comments: DataFrame, table: AliasTable) -> DataFrame:
    """Comments with the flags; whoever reads them once, in a selection, is given no copies."""
    return comments.withColumn(_FLAGS, table.flags.scalar())


def _spelled(cut: Column, place: Column, n: int) -> Column:
    # ``slice`` would copy the whole text for every run.
    return F.concat(F.get(cut, place), *(F.get(cut, place + k) for k in range(1, n)))


def _with_cut(table: AliasTable, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of the cut text and the flags, each as a value of its own: fields cost time."""
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(F.col(_TEXT), F.lit(""))), F.lit(" "))
    cut = segments(padded, table.boundary == "loose")
    if table.boundary == "word":
        cut = _let(cut, lambda c: F.slice(c, F.lit(1), F.size(c) - 1))
    return _let(cut, lambda c: _let(F.col(_FLAGS), lambda f: body(c, f)))


def _begun(cut: Column, flags: Column, table: AliasTable, starts: bool) -> Column:
    """The places at which some alias may begin, by the flag of their segment."""
    return F.filter(_begins(cut, table, starts), lambda i: _known(F.get(cut, i), flags, table))


def _short_runs(
    comments: DataFrame, key: Sequence[str], table: AliasTable, each_place: bool
) -> DataFrame:
    """``*key, __run``: runs that have the shape, and a flag, of an alias; distinct unless asked."""

    def of_shape(cut: Column, flags: Column, places: Column, ends: bool, n: int) -> Column:
        if table.boundary == "loose":
            places = F.filter(places, lambda i: _fits(cut, table, ends, n, i))
        spelled = F.transform(places, lambda i: _spelled(cut, i, n))
        # A single segment has been looked up as a beginning.
        return spelled if n == 1 else F.filter(spelled, lambda r: _known(r, flags, table))

    def started(cut: Column, flags: Column, starts: bool) -> Column:
        shapes = [(e, n) for s, e, n in table.shapes if s == starts]
        return _let(
            _begun(cut, flags, table, starts),
            lambda places: F.flatten(F.array(*(of_shape(cut, flags, places, *shape) for shape in shapes))),
        )

    kinds = sorted({starts for starts, _, _ in table.shapes})
    found = _with_cut(table, lambda c, f: F.flatten(F.array(*(started(c, f, s) for s in kinds))))
    found = found if each_place else F.array_distinct(found)
    # Outer explodes: else what they unfold would be computed again to rule out empty arrays.
    rows = _with_flags(comments, table).select(*key, found.alias("runs"))
    return rows.select(*key, F.explode_outer("runs").alias(_RUN)).where(F.col(_RUN).isNotNull())


def _anchor_runs(comments: DataFrame, key: Sequence[str], table: AliasTable) -> DataFrame:
    """``*key, __run, places, cut`` for each run of a text that may be the anchor of an alias."""

    def places(cut: Column, flags: Column) -> Column:
        at = F.flatten(F.array(*(_begun(cut, flags, table, starts) for starts in table.anchors)))
        fitting = F.filter(at, lambda i: _fits(cut, table, None, MAX_RUN, i))
        placed = F.transform(fitting, lambda i: F.struct(_spelled(cut, i, MAX_RUN).alias("run"), i.alias("at")))
        met = F.filter(placed, lambda r: _known(r["run"], flags, table))
        return F.struct(met.alias("met"), cut.alias("cut"))

    def grouped(found: Column) -> Column:
        return F.transform(
            F.array_distinct(F.transform(found["met"], lambda m: m["run"])),
            lambda r: F.struct(
                r.alias("run"),
                F.transform(F.filter(found["met"], lambda m: m["run"] == r), lambda m: m["at"]).alias("places"),
                found["cut"].alias("cut"),
            ),
        )

    met = _let(_with_cut(table, places), grouped)
    met = _with_flags(comments, table).select(*key, met.alias("met"))
    met = met.select(*key, F.explode_outer("met").alias("met")).where(F.col("met").isNotNull())
    return met.select(*key, F.col("met.run").alias(_RUN), "met.places", "met.cut")


def _long_found(
    comments: DataFrame, key: Sequence[str], table: AliasTable, names: DataFrame, each_place: bool
) -> DataFrame:
    """Mentions of aliases longer than a run: where an anchor is, the whole is compared."""
    joined = _anchor_runs(comments, key, table).join(names, _RUN)
    cut, n = F.col("cut"), F.col("n")

    def whole(place: Column) -> Column:
        start = place - F.col("at")
        same = (start >= 1) & (start + n <= F.size(cut) - _outer(table) + 1)
        spelled = F.array_join(F.slice(cut, start + 1, n), "")
        same = same & (F.when(same, spelled) == F.col(_PHRASE))
        if table.boundary == "loose":
            before, after = F.get(cut, start - 1), F.get(cut, start + n)
            begins = _is_word(F.substring(_PHRASE, 1, 1))
            same = same & (begins | ~_is_word(before)) & (F.col("ends") | ~_is_word(after))
        return F.coalesce(same, F.lit(False))

    found = joined.where(F.exists("places", whole))
    if each_place:
        found = found.withColumn("__place", F.explode(F.filter("places", whole)))
    return found.select(*key, _PHRASE, CANONICAL)


def _found(
    comments: DataFrame, key: Sequence[str], table: AliasTable, broadcast: bool, each_place: bool
) -> DataFrame:
    """``*key, __phrase, canonical`` of mentions: every place, or once a row.

    All is found within the row, so nothing has to be told apart behind the join, and batches
    of a stream can be joined alike.
    """
    names = table.names
    short, long = (names.where(c) for c in (F.col("n") <= MAX_RUN, F.col("n") > MAX_RUN))
    parts = []
    if table.shapes:
        runs = _short_runs(comments, key, table, each_place)
        if broadcast:
            parts.append(runs.join(F.broadcast(short), _RUN).select(*key, _PHRASE, CANONICAL))
        else:
            salts = F.sequence(F.lit(0).cast("bigint"), F.lit(_SALTS - 1).cast("bigint"))
            salted = short.withColumn(_SALT, F.explode(salts))
            salt = F.pmod(F.xxhash64(*(key or [F.monotonically_increasing_id()])), F.lit(_SALTS))
            met = runs.withColumn(_SALT, salt).join(salted, [_RUN, _SALT])
            parts.append(met.select(*key, _PHRASE, CANONICAL))
    if table.anchors:
        long = F.broadcast(long) if broadcast else long
        parts.append(_long_found(comments, key, table, long, each_place))
    if not parts:
        nothing = [F.lit("").alias(_PHRASE), F.lit("").alias(CANONICAL)]
        return comments.where(F.lit(False)).select(*key, *nothing)
    return reduce(DataFrame.union, parts)


def match_mentions(
    comments: DataFrame,
    aliases: DataFrame | AliasTable,
    key: Sequence[str] | None = ("comment_id",),
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    boundary: str = "word",
) -> DataFrame:
    """``*key, alias, canonical`` for each comment and alias found in it as whole words.

    ``key`` tells comments apart; with ``None`` every row is a comment, and the result has
    no key columns. ``aliases`` may be prepared already, then its boundary holds.
    """
    table = _prepared(aliases, boundary)
    columns = list(key or ())
    rows = comments.select(*columns, F.col(text).alias(_TEXT))
    found = _found(rows, columns, table, table.size <= broadcast_bytes, False)
    # Rows that share a key are one comment.
    found = found if key is None else found.distinct()
    return found.select(*columns, F.col(_PHRASE).alias(ALIAS), CANONICAL)


def all_mentions(
    comments: DataFrame,
    aliases: DataFrame | AliasTable,
    key: Sequence[str] | None = ("comment_id",),
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    boundary: str = "word",
) -> DataFrame:
    """As ``match_mentions``, one row for every place an alias occurs at."""
    table = _prepared(aliases, boundary)
    columns = list(key or ())
    rows = comments.select(*columns, F.col(text).alias(_TEXT))
    found = _found(rows, columns, table, table.size <= broadcast_bytes, True)
    return found.select(*columns, F.col(_PHRASE).alias(ALIAS), CANONICAL)


def found_names(
    comments: DataFrame,
    aliases: DataFrame | AliasTable,
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    boundary: str = "word",
) -> DataFrame:
    """``canonical``: a row for each comment and alias of the name found in it, uncounted.

    Texts are not shuffled and nothing is told apart behind the join, so ``comments`` may be a
    stream, whatever the size of the alias table.
    """
    table = _prepared(aliases, boundary)
    rows = comments.select(F.col(text).alias(_TEXT))
    names = table.names
    short, long = (names.where(c) for c in (F.col("n") <= MAX_RUN, F.col("n") > MAX_RUN))
    if table.size <= broadcast_bytes:
        short, long = F.broadcast(short), F.broadcast(long)
    parts = []
    if table.shapes:
        runs = _short_runs(rows, [], table, False)
        parts.append(runs.join(short, _RUN).select(CANONICAL))
    if table.anchors:
        parts.append(_long_found(rows, [], table, long, False).select(CANONICAL))
    return reduce(DataFrame.union, parts) if parts else rows.where(F.lit(False)).select(F.lit("").alias(CANONICAL))


def count_mentions(
    comments: DataFrame,
    aliases: DataFrame | AliasTable,
    key: Sequence[str] | None = None,
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    boundary: str = "word",
) -> DataFrame:
    """``canonical, mentions``: one for each comment and alias of the name found in it.

    A repeated alias counts once per comment; two aliases of one name count twice. Every row
    is a comment, unless ``key`` names columns whose equal values make rows one comment.

    Runs are counted before they meet a large alias table, so a frequent word is a row a task;
    only long aliases, which are compared in the row, meet the texts themselves.
    """
    table = _prepared(aliases, boundary)
    columns = list(key or ())
    rows = comments.select(*columns, F.col(text).alias(_TEXT))
    broadcast = table.size <= broadcast_bytes

    def once(found: DataFrame) -> DataFrame:
        return found if key is None else found.distinct()

    names = table.names
    short, long = (names.where(c) for c in (F.col("n") <= MAX_RUN, F.col("n") > MAX_RUN))
    counted = []
    if table.shapes:
        runs = _short_runs(rows, columns, table, False)
        if broadcast:
            counts = once(runs).join(F.broadcast(short), _RUN).groupBy(CANONICAL)
            counted.append(counts.agg(F.count(F.lit(1)).alias(MENTIONS)))
        else:
            counts = once(runs).groupBy(_RUN).agg(F.count(F.lit(1)).alias(MENTIONS)).join(short, _RUN)
            counted.append(counts.groupBy(CANONICAL).agg(F.sum(MENTIONS).alias(MENTIONS)))
    if table.anchors:
        found = _long_found(rows, columns, table, F.broadcast(long) if broadcast else long, False)
        counts = once(found).groupBy(CANONICAL)
        counted.append(counts.agg(F.count(F.lit(1)).alias(MENTIONS)))
    if not counted:
        return comments.where(F.lit(False)).select(F.lit("").alias(CANONICAL), F.lit(0).cast("bigint").alias(MENTIONS))
    if len(counted) == 1:
        return counted[0]
    return reduce(DataFrame.union, counted).groupBy(CANONICAL).agg(F.sum(MENTIONS).alias(MENTIONS))


def top_mention(counts: DataFrame, on_empty: str = "error") -> DataFrame:
    """The most mentioned name (ties: the smallest); an empty count is an error or no row.

    To tell an empty count the row is computed, once, and returned as a table of one row.
    """
    if on_empty not in ("error", "empty"):
        raise ValueError("on_empty must be 'error' or 'empty'")
    top = counts.orderBy(F.desc(MENTIONS), F.asc(CANONICAL)).limit(1)
    if on_empty == "empty":
        return top
    row = top.first()
    if row is None:
        raise EmptyResultError("no mentions found")
    return counts.sparkSession.createDataFrame([row], top.schema)


def mention_summary(counts: DataFrame) -> DataFrame:
    """The top name beside all counts: ``player, player_mentions, canonical, mentions``.

    One row per name rather than one row with a map: the map would grow with the names.
    """
    best = F.struct(F.col(CANONICAL).alias("player"), F.col(MENTIONS).alias("player_mentions"))
    top = top_mention(counts, on_empty="empty").select(best.alias("top")).scalar()
    return counts.withColumn("top", top).select("top.*", CANONICAL, MENTIONS)
