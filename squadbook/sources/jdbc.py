"""JDBC connection options and partitioned table reads."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import parse_qsl, quote, unquote, urlencode, urlsplit

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the supported backend.
BACKEND = "postgresql"
DRIVER = "org.postgresql.Driver"
DEFAULT_HOST = "localhost"
DEFAULT_PORT = 5432
DEFAULT_PARAMETERS = {"stringtype": "unspecified"}


def jdbc_options(url: str, schema: str | None = None) -> dict[str, str]:
    """Options for ``format("jdbc")`` from ``postgresql[+client]://user:pass@host:port/db?k=v``.

    URL parameters are kept. User and password appear only if the URL holds them.
    """
    parts = urlsplit(url)
    if parts.scheme.partition("+")[0] != BACKEND:
        raise ValueError(f"unsupported database backend '{parts.scheme}'")
    database = parts.path.lstrip("/")
    if not database:
        raise ValueError("the connection URL names no database")
    parameters = DEFAULT_PARAMETERS | dict(parse_qsl(parts.query, keep_blank_values=True))
    host = parts.hostname or DEFAULT_HOST
    address = f"{f'[{host}]' if ':' in host else host}:{parts.port or DEFAULT_PORT}"
    optional = {
        "currentSchema": schema,
        "user": unquote(parts.username or ""),
        "password": unquote(parts.password or ""),
    }
    return {
        "url": f"jdbc:{BACKEND}://{address}/{database}?{urlencode(parameters, quote_via=quote)}",
        "driver": DRIVER,
        **{name: value for name, value in optional.items() if value},
    }


def read_table_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition_by: tuple[str, object, object, int] | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A database table, read in parallel.

    ``partition_by`` is ``(column, lower, upper, partitions)``, for a numeric or time
    column spread evenly between the bounds. For a column with hot values give
    ``predicates`` instead, one SQL condition per partition (such as ranges of a hash).
    With neither, the whole table is read by one task, as the database driver does it.
    """
    options = {**options, "fetchsize": str(fetch_size)}
    if predicates is not None:
        url = options.pop("url")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_by is not None:
        column, lower, upper, partitions = partition_by
        reader = reader.options(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()
