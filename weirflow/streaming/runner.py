"""Connects a run to a change log: where the log ends now, and how its streams are consumed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.names import slot_candidates
from ..operators import messages
from ..operators.changelog import LogStream
from ..plans import servers
from ..plans.run import now
from ..plans.state import State
from ..sources import change_log
from . import session


@dataclass
class LogRunner:
    """A change log in a folder; checkpoints go below ``checkpoint``, one for each session.

    A session starts from its streams' committed positions, so it never needs an older checkpoint.
    ``confirm_path`` is where confirmed positions go, ``state_path`` the file with what the consumer has.
    """

    spark: SparkSession
    settings: Settings
    path: str
    checkpoint: str
    confirm_path: str | None = None
    state_path: str | None = None

    def slot(self) -> str | None:
        """The replication slot that feeds the log; None where the log's owner says nothing of its server.

        Fails where the server's version has no usable log, and where none of the names that are looked for exists.
        """
        facts = change_log.server_facts(self.path)
        if facts is None:
            return None
        servers.require(int(facts["version"]))
        names = slot_candidates(self.settings.dbname, self.settings.pipeline_id, self.settings.slot_prefixes)
        return servers.first_slot(names, facts.get("slots", ()))

    def current_lsn(self) -> int:
        """The highest position now in the log; 0 for an empty one."""
        self.slot()
        change_log.register(self.spark)
        return self.spark.read.format(change_log.NAME).load(self.path).agg(F.coalesce(F.max("lsn"), F.lit(0))).first()[0]

    def __call__(self, streams: Sequence[LogStream], state: State, end_lsn: int, emit: Callable[[str], None], refresh: Callable | None = None) -> None:
        def write(lines: DataFrame) -> int:
            n = 0
            for row in lines.toLocalIterator():
                emit(messages.record_line(row))
                n += 1
            return n

        bounded = self.settings.break_at_end
        s = session.LogSession(streams, state, now(), write, lambda m: emit(messages.dumps(m)), end_lsn if bounded else None, self.settings.debug_lsn, refresh)
        session.run(
            self.spark, s, self.path, f"{self.checkpoint.rstrip('/')}/{uuid.uuid4().hex}", self.confirm_path, self.state_path,
            max_seconds=self.settings.max_run_seconds, idle_seconds=self.settings.idle_seconds, continuous=not bounded,
        )
