"""Hand-over between a stream that writes a table and one that reads it."""

from __future__ import annotations

from datetime import datetime, timezone
from threading import Event

from pyspark.sql.streaming import StreamingQueryListener


class HandOver(StreamingQueryListener):
    """Hears when the stream named ``reader`` has read what the one named ``writer`` committed.

    ``landed`` is set by the writer's first batch with rows, or its end. ``caught_up`` is set by a
    trigger of the reader that began after the writer had ended and found nothing new, or by the
    reader's own end. No counts of rows are compared, so restarts and batches that run again do not
    matter.
    """

    def __init__(self, writer: str, reader: str):
        self.writer, self.reader = writer, reader
        self.landed, self.caught_up = Event(), Event()
        self._names: dict = {}
        self._writer_ended: str | None = None

    def onQueryStarted(self, event) -> None:
        self._names[event.runId] = event.name

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.writer and event.progress.numInputRows > 0:
            self.landed.set()

    def onQueryIdle(self, event) -> None:
        """The time of the event is that at which its trigger began."""
        ended = self._writer_ended
        if self._names.get(event.runId) == self.reader and ended and event.timestamp > ended:
            self.caught_up.set()

    def onQueryTerminated(self, event) -> None:
        name = self._names.pop(event.runId, None)
        if name == self.writer:
            now = datetime.now(timezone.utc).isoformat(timespec="milliseconds")
            self._writer_ended = now.replace("+00:00", "Z")
            self.landed.set()
        elif name == self.reader:
            self.caught_up.set()
