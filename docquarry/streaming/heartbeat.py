"""Liveness of running streams by their progress."""

from __future__ import annotations

import time

from pyspark.sql.streaming import StreamingQueryListener


class Heartbeat(StreamingQueryListener):
    """Remembers when each query last made progress; ``stale`` names those that
    have not for ``limit`` seconds."""

    def __init__(self, limit: float = 300):
        self.limit, self.last = limit, {}

    def onQueryStarted(self, event) -> None:
        self.last[str(event.id)] = time.time()

    def onQueryProgress(self, event) -> None:
        self.last[str(event.progress.id)] = time.time()

    def onQueryIdle(self, event) -> None:
        self.last[str(event.id)] = time.time()

    def onQueryTerminated(self, event) -> None:
        self.last.pop(str(event.id), None)

    def stale(self, now: float | None = None) -> list[str]:
        now = time.time() if now is None else now
        return sorted(k for k, t in self.last.items() if now - t > self.limit)
