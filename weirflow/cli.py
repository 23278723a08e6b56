"""The command line: discovery, or a run over a catalog."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .config import Settings
from .plans.catalog import catalog_json
from .plans.run import Run
from .plans.state import State
from .sources.relations import Fact, JdbcSource, ParquetSource, Split
from .streaming.runner import LogRunner

LOG = logging.getLogger("weirflow")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="weirflow", description=__doc__)
    parser.add_argument("-c", "--config", required=True, help="JSON file of settings")
    parser.add_argument("-s", "--state", help="JSON file of bookmarks; read again while a log is consumed")
    parser.add_argument("--catalog", help="JSON file of streams with what is selected")
    parser.add_argument("-d", "--discover", action="store_true", help="write the catalog and end")
    return parser.parse_args(argv)


def run(argv: list[str] | None = None, spark: SparkSession | None = None, out=None) -> State | None:
    """Discovers or reads; does nothing, with success, if neither is asked for."""
    given, out = arguments(argv), out or sys.stdout
    raw = json.loads(Path(given.config).read_text())
    settings = Settings.of(raw)
    if not given.discover and not given.catalog:
        LOG.info("neither discovery nor a catalog was asked for")
        return None
    spark = spark or SparkSession.builder.appName("weirflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()

    def emit(line: str) -> None:
        out.write(line + "\n")
        out.flush()

    facts = {t: Fact(tuple(x.get("keys", ())), x.get("watermark"), bool(x.get("is_view"))) for t, x in raw.get("facts", {}).items()}
    current_xid = None
    if raw.get("parquet_root"):
        source = ParquetSource(spark, raw["parquet_root"], tuple(raw.get("tables", ())), facts=facts)
        if raw.get("current_xid") is not None:
            current_xid = lambda: int(raw["current_xid"])
    else:
        splits = {t: Split(x["column"], int(x["parts"])) for t, x in raw.get("splits", {}).items()}
        source = JdbcSource(spark, settings, tuple(tuple(t) for t in raw.get("tables", ())), facts, splits=splits, types=raw.get("column_types", {}))
        current_xid = source.current_xid
    log = raw.get("change_log")
    reader = LogRunner(spark, settings, log["path"], log["checkpoint"], log.get("confirm"), given.state) if log else None
    job = Run(spark, source, settings, emit, reader, reader.current_lsn if reader else None, current_xid)
    if given.discover:
        emit(catalog_json(job.discovered()))
        return None
    state = State(json.loads(Path(given.state).read_text()) if given.state else None)
    return job.sync(json.loads(Path(given.catalog).read_text()), state)


def main() -> None:
    logging.basicConfig(level=logging.INFO, stream=sys.stderr)
    try:
        run()
    except Exception as error:
        LOG.critical("%s", error)
        raise


if __name__ == "__main__":
    main()
