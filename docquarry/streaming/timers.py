"""Wall-clock timers: work that stays silent for longer than its stage may take."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docquarry.functions.states import IN_FLIGHT, TEXT_STATES

#: How long a document may stay in a stage, and how long a finished one is known.
TEXT_MS, EXTRACT_MS, KNOWN_MS = 30_000, 1_500_000, 3_600_000
REPORT = "doc_id long, state string, waited_ms long, reports int"


class StageTimer(StatefulProcessor):
    """Reports a document each time it was silent for as long as its stage may take,
    by the clock of the micro-batches.  Word from it, a repeated state too, starts
    the time anew.  A finished document leaves but its last order, and that only
    for ``known_ms``, so that older word that comes late does not bring it back."""

    def __init__(self, text_ms: int = TEXT_MS, extract_ms: int = EXTRACT_MS, known_ms: int = KNOWN_MS) -> None:
        self.text_ms, self.extract_ms, self.known_ms = text_ms, extract_ms, known_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "state string, seq long, since long, reports int")
        self.done = handle.getValueState("done", "seq long", self.known_ms)

    def _limit(self, state: str) -> int:
        return self.text_ms if state in TEXT_STATES else self.extract_ms

    def _rows(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["doc_id", "state", "waited_ms", "reports"]).astype({"doc_id": "int64", "state": "object", "waited_ms": "int64", "reports": "int32"})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last = pd.concat(list(rows)).sort_values("seq").iloc[-1]
        seq, state, now = int(last["seq"]), str(last["state"]), int(timerValues.getCurrentProcessingTimeInMs())
        known, done = self.open.get(), self.done.get()
        if seq >= max(int(known[1]) if known is not None else seq, int(done[0]) if done is not None else seq):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if state in IN_FLIGHT:
                self.open.update((state, seq, now, 0))
                self.handle.registerTimer(now + self._limit(state))
                self.done.clear()
            else:
                self.open.clear()
                self.done.update((seq,))
        yield self._rows([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        known, now = self.open.get(), int(timerValues.getCurrentProcessingTimeInMs())
        if known is None:
            yield self._rows([])
            return
        state, seq, since, reports = known
        self.open.update((state, seq, since, reports + 1))
        self.handle.registerTimer(now + self._limit(state))
        yield self._rows([(key[0], state, now - since, reports + 1)])

    def close(self) -> None:
        pass


def silent_documents(stream: DataFrame, text_ms: int = TEXT_MS, extract_ms: int = EXTRACT_MS, known_ms: int = KNOWN_MS) -> DataFrame:
    """Reports of ``stream`` (``doc_id``, ``seq``, ``state``); needs the state store of
    ``stateful.STORE`` and a trigger that goes on, since timers run in batches."""
    return stream.groupBy("doc_id").transformWithStateInPandas(
        StageTimer(text_ms, extract_ms, known_ms), outputStructType=REPORT, outputMode="Update", timeMode="ProcessingTime"
    )
