"""Reading relations over JDBC: endpoints, options, addresses."""

from __future__ import annotations

from typing import Any
from urllib.parse import quote, urlencode

from pyspark.sql import DataFrame, SparkSession

from ..config import Settings
from ..functions.names import qualified

#: How sessions name themselves, and how long connecting may take (fixed values).
APPLICATION, CONNECT_SECONDS = "weirflow", 30


def endpoint(settings: Settings, primary: bool = False) -> tuple[str, int]:
    """Host and port: the replica for reads if there is one to use, the primary for all else."""
    if settings.use_secondary and not primary:
        return str(settings.secondary_host), int(settings.secondary_port)
    return settings.host, settings.port


def parameters(settings: Settings, primary: bool = False, dbname: str | None = None, options: str | None = None) -> dict[str, Any]:
    """What a connection is opened with."""
    host, port = endpoint(settings, primary)
    out = {"host": host, "port": port, "user": settings.user, "password": settings.password, "dbname": dbname or settings.dbname, "application_name": APPLICATION, "connect_timeout": CONNECT_SECONDS}
    if settings.ssl:
        out["sslmode"] = "require"
    if options:
        out["options"] = options
    return out


def uri(settings: Settings, primary: bool = False, dbname: str | None = None) -> str:
    """The connection's address, percent-encoded."""
    p = parameters(settings, primary, dbname)
    query = {k: str(p[k]) for k in ("application_name", "connect_timeout", "sslmode") if k in p}
    user, password, host, base = (quote(str(p[k]), safe="") for k in ("user", "password", "host", "dbname"))
    return f"postgresql://{user}:{password}@{host}:{p['port']}/{base}?{urlencode(query, quote_via=quote)}"


def options(settings: Settings, schema: str, table: str, primary: bool = False, dbname: str | None = None) -> dict[str, str]:
    """Options of Spark's JDBC reader for one relation."""
    host, port = endpoint(settings, primary)
    base = quote(dbname or settings.dbname, safe="")
    out = {
        "url": f"jdbc:postgresql://{host}:{port}/{base}",
        "dbtable": qualified(schema, table),
        "user": settings.user,
        "password": settings.password,
        "fetchsize": str(settings.fetch_rows),
        "ApplicationName": APPLICATION,
        "connectTimeout": str(CONNECT_SECONDS),
        "loginTimeout": str(CONNECT_SECONDS),
    }
    if settings.ssl:
        out |= {"ssl": "true", "sslmode": "require"}
    return out


def read(spark: SparkSession, given: dict[str, str], column: str | None = None, low: Any = None, high: Any = None, partitions: int = 1, custom_schema: str | None = None) -> DataFrame:
    """A relation as a DataFrame; with a numeric or date column and its bounds, in so many parallel parts."""
    reader = spark.read.format("jdbc").options(**given)
    if custom_schema:
        reader = reader.option("customSchema", custom_schema)
    if column is not None:
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions))
    return reader.load()


def scalar(df: DataFrame) -> Any:
    """The first value of the one row that is expected."""
    row = df.first()
    if row is None:
        raise LookupError("the query gave no row")
    return row[0]
