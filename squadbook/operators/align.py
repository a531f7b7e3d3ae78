"""Bring differing season files to one schema. All are narrow projections."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce, digits_in, normalize_name, tolerant_integer
from ..schema import CORE_COLUMNS, ENTITY_KEY, GENDER, SYNONYMS, URL_COLUMN, YEAR


def normalize_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Rename every column but ``keep`` to its canonical name; no two may meet in one."""
    names = [header if header in keep else normalize_name(header) for header in df.columns]
    seen = Counter(names)
    clashing = [old for old, new in zip(df.columns, names) if seen[new] > 1]
    if clashing:
        raise ValueError(f"headers with the same canonical name: {clashing}")
    return df.toDF(*names)


def merge_aliases(df: DataFrame, aliases: Mapping[str, str] = SYNONYMS) -> DataFrame:
    """Fold synonym columns into their canonical column, first value wins.

    The canonical column itself comes before its synonyms; these are dropped.
    """
    present = set(df.columns)
    sources: dict[str, list[str]] = {}
    for source, target in aliases.items():
        if source in present and source != target:
            sources.setdefault(target, [target] if target in present else []).append(source)
    target_of = {name: target for target, names in sources.items() for name in names}

    types = {field.name: field.dataType for field in df.schema}
    merged: dict[str, Column] = {}
    for name in df.columns:
        target = target_of.get(name, name)
        if target in merged:
            continue
        members = sources.get(target, [name])
        mixed = len({types[m] for m in members}) > 1
        cells = [F.col(m).cast("string") if mixed else F.col(m) for m in members]
        merged[target] = (F.coalesce(*cells) if len(cells) > 1 else cells[0]).alias(target)
    return df.select(*merged.values())


def tag_source(df: DataFrame, year: int, group: str) -> DataFrame:
    """Add the season and the lower-cased group a file stands for."""
    return df.withColumns({YEAR: F.lit(int(year)), GENDER: F.lit(group.lower())})


def ensure_entity_key(
    df: DataFrame, key: str = ENTITY_KEY, url_col: str = URL_COLUMN
) -> DataFrame:
    """Give ``df`` a bigint key, from the digits of its URL where the column is missing."""
    if key in df.columns:
        return df.withColumn(key, tolerant_integer(F.col(key), "bigint", df.schema[key].dataType))
    if url_col in df.columns:
        return df.withColumn(key, digits_in(F.col(url_col)))
    raise ValueError(f"neither '{key}' nor '{url_col}' is among the columns {df.columns}")


def fallback_column(df: DataFrame, target: str, source: str) -> DataFrame:
    """Copy ``source`` to ``target`` where the latter is missing; ``source`` stays."""
    if target in df.columns or source not in df.columns:
        return df
    return df.withColumn(target, F.col(source))


def conform(df: DataFrame, required: Iterable[str], type_map: Mapping[str, str]) -> DataFrame:
    """Add missing required columns as typed NULLs and coerce every known column.

    One projection for all columns; columns outside ``type_map`` pass unchanged.
    """
    present = [
        coerce(F.col(f.name), f.dataType, type_map[f.name]).alias(f.name)
        if f.name in type_map
        else F.col(f.name)
        for f in df.schema
    ]
    missing = [
        F.lit(None).cast(type_map.get(name, "string")).alias(name)
        for name in required
        if name not in df.columns
    ]
    return df.select(*present, *missing)


def order_columns(df: DataFrame, core: Sequence[str] = CORE_COLUMNS) -> DataFrame:
    """Core columns first, all others after them by name."""
    return df.select(*core, *sorted(set(df.columns) - set(core)))


def union_rosters(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column a frame lacks is NULL there.

    A column whose type differs between frames becomes a string in all of them, so
    the union means the same with ANSI mode on and off.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("no rosters to union")
    types: dict[str, set[T.DataType]] = {}
    for df in frames:
        for field in df.schema:
            types.setdefault(field.name, set()).add(field.dataType)
    mixed = {name for name, kinds in types.items() if len(kinds - {T.NullType()}) > 1}

    def as_text(df: DataFrame) -> DataFrame:
        cells = {c: F.col(c).cast("string") for c in df.columns if c in mixed}
        return df.withColumns(cells) if cells else df

    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        map(as_text, frames),
    )
