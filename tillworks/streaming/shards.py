"""One stream per shard: a failing shard is noted and taken up again from its checkpoint, while the others go on."""

from __future__ import annotations

import json
import logging
import re
import threading
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tillworks.layout import Layout
from tillworks.session import write_text
from tillworks.streaming.bronze_stream import start_bronze_stream

log = logging.getLogger(__name__)

FAILURES = "shard string, attempt int, error string"


@dataclass
class ShardState:
    """How one shard is doing."""

    attempts: int = 0
    errors: list[str] = field(default_factory=list)
    finished: bool = False  # everything available was landed
    given_up: bool = False
    query: StreamingQuery | None = None
    not_before: float = 0.0


class _Ends(StreamingQueryListener):
    """Wakes the supervisor when a query ends; logs how."""

    def __init__(self):
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.warning("stream %s failed: %s", event.id, event.exception.splitlines()[0])
        self.ended.set()


def _short(error: BaseException) -> str:
    """The last cause that a stream's long message names, else its first line."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()] or [type(error).__name__]
    causes = [line for line in lines if re.match(r"(Caused by: )?[\w.$]+(Exception|Error)\b", line)]
    return (causes or lines[:1])[-1][:500]


class Supervisor:
    """Lands shards side by side, each as the stream ``{source}-{shard}`` with a checkpoint of its own.

    ``shards`` gives, by name, a function that opens the shard's message stream; opening may fail as well. A shard
    that fails is started again after a pause that doubles, up to ``attempts`` starts in this run; what it had
    committed stays committed and is not read again. Failures are noted under ``layout.shard_failures``, a file per
    shard and run. Rows that one shard can't land never hold up another shard's.
    """

    def __init__(
        self,
        spark: SparkSession,
        layout: Layout,
        shards: Mapping[str, Callable[[], DataFrame]],
        source: str = "sales",
        attempts: int = 3,
        pause: float = 1.0,
        available_now: bool = True,
        **options,
    ):
        self.spark, self.layout, self.source = spark, layout, source
        self._open, self._attempts, self._pause = dict(shards), attempts, pause
        self._options = options | {"available_now": available_now}
        self.states = {name: ShardState() for name in shards}
        self._stopping = threading.Event()

    def run(self) -> dict[str, ShardState]:
        """Go on until every shard has finished or was given up (or, for unending streams, until ``stop``)."""
        ends = _Ends()
        self.spark.streams.addListener(ends)
        try:
            while not self._stopping.is_set():
                ends.ended.clear()
                open_shards = [name for name, s in self.states.items() if not (s.finished or s.given_up)]
                if not open_shards:
                    break
                for name in open_shards:
                    self._look_after(name)
                waits = [s.not_before - time.monotonic() for s in self.states.values() if s.query is None and not (s.finished or s.given_up)]
                # The listener may hear of an end late, so look by ourselves as well.
                ends.ended.wait(max(0.05, min([1.0, *waits])))
        finally:
            for state in self.states.values():
                if state.query is not None:
                    state.query.stop()
            self.spark.streams.removeListener(ends)
        return self.states

    def stop(self) -> None:
        self._stopping.set()

    def _look_after(self, name: str) -> None:
        state = self.states[name]
        if state.query is None:
            if time.monotonic() >= state.not_before:
                state.attempts += 1
                try:
                    state.query = start_bronze_stream(self._open[name](), self.layout, source=f"{self.source}-{name}", **self._options)
                except Exception as error:  # whatever keeps a shard from being opened is that shard's failure
                    self._failed(name, error)
        elif not state.query.isActive:
            error, state.query = state.query.exception(), None
            if error is None:
                state.finished = True
            else:
                self._failed(name, error)

    def _failed(self, name: str, error: BaseException) -> None:
        state = self.states[name]
        state.errors.append(_short(error))
        state.not_before = time.monotonic() + self._pause * 2 ** (state.attempts - 1)
        state.given_up = state.attempts >= self._attempts
        log.warning("shard %s, attempt %d: %s", name, state.attempts, state.errors[-1])
        lines = [json.dumps({"shard": name, "attempt": k, "error": e}) for k, e in enumerate(state.errors, 1)]
        write_text(self.spark, f"{self.layout.shard_failures}/{self.source}-{name}.json", "\n".join(lines))


def run_shards(spark: SparkSession, layout: Layout, shards: Mapping[str, Callable[[], DataFrame]], **options) -> dict[str, ShardState]:
    """Land what is available in every shard; see ``Supervisor``."""
    return Supervisor(spark, layout, shards, **options).run()


def shard_failures(spark: SparkSession, layout: Layout) -> DataFrame:
    """``shard, attempt, error`` of the last run in which each shard failed."""
    return spark.read.schema(FAILURES).json(layout.shard_failures)
