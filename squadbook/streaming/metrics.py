"""The ingestion log of a stream: one record for each micro-batch.

Spark measures the rows of a batch on their way (``observe``) and reports it when the batch is
done. A listener writes that as the batch's record, which replaces an earlier one of the same
batch, so the log holds every batch once however often it ran.
"""

from __future__ import annotations

from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import ingestion_metrics
from ..sinks.batches import BATCH, read_batches, write_batch

LOG_SCHEMA = "row_count bigint, years array<int>, checksum string, logged_at timestamp"
_WAIT_SECONDS = 60.0


def observed(stream: DataFrame, name: str, year: str = "year") -> DataFrame:
    """The stream, with the metrics of an ingestion record measured on each batch under a name."""
    return stream.observe(name, *ingestion_metrics(stream, year))


class BatchLog(StreamingQueryListener):
    """Writes what ``observed`` measured below ``path``; add it before the query starts.

    ``spark.streams.addListener(log)`` makes it listen, ``log.wait(query)`` waits until it has
    the last batch of a query, and ``read_batch_log`` reads the records.
    """

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path
        self._seen: dict[str, int] = {}
        self._news = Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is not None:
            record = (row["row_count"], row["years"], row["checksum"])
            log = self.spark.createDataFrame([record], "row_count bigint, years array<int>, checksum string")
            stamped = log.withColumn("logged_at", F.current_timestamp()).coalesce(1)
            write_batch(stamped, self.path, progress.batchId)
        with self._news:
            self._seen[str(progress.id)] = progress.batchId
            self._news.notify_all()

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, query: StreamingQuery, seconds: float = _WAIT_SECONDS) -> bool:
        """Whether the log has come as far as the query within the time."""
        last = query.lastProgress
        if last is None:
            return True
        with self._news:
            return self._news.wait_for(lambda: self._seen.get(str(query.id), -1) >= last["batchId"], seconds)


def read_batch_log(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, row_count, years, checksum, logged_at``, one row for each batch."""
    return read_batches(spark, path, LOG_SCHEMA).select(BATCH, "row_count", "years", "checksum", "logged_at")
