"""Python code over Arrow batches inside Spark tasks."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SHIPPED = "squadbook_llm_shipped"


def ship(spark: SparkSession) -> None:
    """Give executors this package, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    folder = tempfile.mkdtemp(prefix="squadbook-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    root = Path(__file__).resolve().parents[2]
    archive = shutil.make_archive(os.path.join(folder, "squadbook"), "zip", root, "squadbook")
    context.addPyFile(archive)
    setattr(context, _SHIPPED, True)


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece have about ``limit`` bytes, one row at least."""
    import numpy as np

    from squadbook.llm.arrays import text_bytes

    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Consecutive rows of one key, as tables, from batches that are sorted by it."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        ends = np.append(starts[1:], len(keys))
        for lo, hi in zip(starts.tolist(), ends.tolist()):
            if held and keys[lo] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = keys[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield current, pa.Table.from_batches(held)
