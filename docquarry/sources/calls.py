"""Calls to slow services from tasks: several at a time, at a bounded pace, and each
made once, whatever happens to the task."""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow.fs as pafs

#: (fault or None, status or None, body).
Told = tuple[str | None, int | None, str]


class Pace:
    """A token bucket: ``per_second`` calls on average, ``burst`` at once.  One bucket
    serves the threads of a task, so a stage of n tasks makes n times as many."""

    def __init__(self, per_second: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.per_second, self.burst, self.clock, self.sleep = per_second, burst, clock, sleep
        self.tokens, self.at, self.lock = float(burst), clock(), threading.Lock()

    def take(self) -> None:
        with self.lock:
            now = self.clock()
            self.tokens = min(self.burst, self.tokens + (now - self.at) * self.per_second)
            self.at = now
            self.tokens -= 1  # may be owed, so that those who wait queue up
            wait = -self.tokens / self.per_second
        if wait > 0:
            self.sleep(wait)


class ReplyLog:
    """Replies by key, an object each, in a folder that all tasks reach.  An object
    appears whole, by a rename; of two writers of a key either may stay."""

    def __init__(self, folder: str):
        self.folder = folder

    def _open(self) -> tuple[pafs.FileSystem, str]:
        plain = self.folder.removeprefix("file:") if "://" not in self.folder else self.folder
        return pafs.FileSystem.from_uri(plain)

    def _place(self, root: str, key: tuple) -> str:
        digest = hashlib.sha256(json.dumps([str(k) for k in key]).encode()).hexdigest()
        return f"{root}/{digest[:2]}/{digest[2:]}.json"

    def get(self, key: tuple) -> Told | None:
        system, root = self._open()
        place = self._place(root, key)
        if system.get_file_info(place).type != pafs.FileType.File:
            return None
        with system.open_input_file(place) as source:
            return tuple(json.loads(source.read()))

    def put(self, key: tuple, told: Told) -> None:
        system, root = self._open()
        place = self._place(root, key)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        fresh = f"{place}.{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as out:
            out.write(json.dumps(told).encode())
        system.move(fresh, place)


def ask_all(
    asked: list[tuple[tuple, Callable[[], Told], str]], concurrency: int = 4, paces: dict[str, Pace] | None = None, log: ReplyLog | None = None
) -> list[Told]:
    """The replies of all (key, call, service), in order.  At most ``concurrency`` calls
    run at a time, each service at its pace; what the log has is not asked again,
    and a reply is logged before the next call of its thread."""

    def one(item: tuple[tuple, Callable[[], Told], str]) -> Told:
        key, call, service = item
        known = log.get(key) if log else None
        if known is not None:
            return known
        if paces and service in paces:
            paces[service].take()
        told = call()
        if log:
            log.put(key, told)
        return told

    if concurrency <= 1 or len(asked) <= 1:
        return [one(item) for item in asked]
    with ThreadPoolExecutor(concurrency) as pool:
        return list(pool.map(one, asked))
