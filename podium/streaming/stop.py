"""Streams that end between two epochs."""

from __future__ import annotations

import signal
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from podium.shared import Folder
from podium.streaming.console import Sink


class Stopped(Exception):
    """An epoch was not begun, because a stop was asked for."""


class Stop:
    """A request to stop, made by ``request``, by a signal or by a file at ``marker``.

    The epoch that is running is finished, noted in the checkpoint and not run again; the
    next one is refused before any sink sees it, and runs first when the query is started
    anew. So no epoch is repeated and none is left out.
    """

    def __init__(self, marker: str | None = None):
        self.marker = marker
        self._asked = threading.Event()
        self._gated = False
        self._refused = threading.Event()

    def request(self) -> None:
        self._asked.set()

    def requested(self, spark: SparkSession) -> bool:
        if not self._asked.is_set() and self.marker is not None:
            *folder, name = self.marker.rsplit("/", 1)
            if Folder(spark, folder[0] if folder else ".").exists(name):
                self._asked.set()
        return self._asked.is_set()

    @contextmanager
    def on_signals(self, *numbers: int) -> Iterator[Stop]:
        """While this lasts, the signals (by default SIGTERM and SIGINT) ask for a stop.

        Only the main thread may set that up, as Python has it.
        """
        numbers = numbers or (signal.SIGTERM, signal.SIGINT)
        before = {n: signal.signal(n, lambda *_: self.request()) for n in numbers}
        try:
            yield self
        finally:
            for number, handler in before.items():
                signal.signal(number, handler)

    def gate(self, sink: Sink) -> Sink:
        """``sink``, but for epochs after the request."""
        self._gated = True

        def write(batch: DataFrame, epoch_id: int) -> None:
            if self.requested(batch.sparkSession):
                self._refused.set()
                raise Stopped(f"epoch {epoch_id} is left to the next start")
            sink(batch, epoch_id)

        return write

    def wait(self, query: StreamingQuery, spark: SparkSession, poll: float = 0.5) -> bool:
        """Wait for the end of ``query``; whether it was stopped by request.

        A query without ``gate`` is one that writes files through Spark's own sink, which
        drops what an interrupted epoch has written: it is stopped at once.
        """
        try:
            while not query.awaitTermination(poll):
                if self.requested(spark) and not (
                    self._gated and query.status["isTriggerActive"]
                ):
                    query.stop()
                    return True
        except StreamingQueryException:
            if not self._refused.is_set():
                raise
        return self._refused.is_set()
