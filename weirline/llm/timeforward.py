"""Time-forward processing: nodes in the order of their labels, messages in a queue.

A node that has been worked out sends its result to nodes that come later, by putting
it under their label into a priority queue; a node whose turn it is takes out what was
sent to it. The queue keeps a bounded number of messages in memory. Those for the
latest labels go to sorted runs on the task's own disk, as a sort's spill does: the
files have no name, no other task reads them, and they are gone with the task.
"""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import Any

CHUNK = 512  # messages of a run that are read at a time
MAX_RUNS = 32  # more are merged into one


class MessageQueue:
    """Messages by label, the least label first, those of a label in the order sent."""

    def __init__(self, capacity: int = 1 << 17):
        if capacity < 2:
            raise ValueError("a queue needs room for two messages")
        self.capacity, self.sent = capacity, 0
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # place of the first entry, number, first entry, the rest

    def send(self, label: Any, message: Any) -> None:
        heapq.heappush(self.heap, (label, self.sent, message))
        self.sent += 1
        if len(self.heap) > self.capacity:
            self.heap.sort()
            late = self.heap[self.capacity // 2 :]
            del self.heap[self.capacity // 2 :]
            self._keep(late)
            if len(self.runs) > MAX_RUNS:
                parts, self.runs = self.runs, []
                self._keep(heapq.merge(*(chain([first], rest) for _, _, first, rest in parts)))

    def _keep(self, entries: Iterable[tuple]) -> None:
        self.sent += 1
        self._open(_written(entries), self.sent)

    def _open(self, run: Iterator[tuple], number: int) -> None:
        first = next(run, None)
        if first is not None:
            heapq.heappush(self.runs, (first[:2], number, first, run))

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)

    def _in_run(self) -> bool:
        return bool(self.runs) and (not self.heap or self.runs[0][0] < self.heap[0][:2])

    def least(self) -> Any:
        """The least label; there has to be one."""
        return self.runs[0][0][0] if self._in_run() else self.heap[0][0]

    def pop(self) -> tuple[Any, Any]:
        """Label and message of the least label; there has to be one."""
        if not self._in_run():
            label, _, message = heapq.heappop(self.heap)
            return label, message
        _, number, (label, _, message), run = heapq.heappop(self.runs)
        self._open(run, number)
        return label, message

    def receive(self, label: Any) -> list[Any]:
        """All messages for a label that no later one has been read of."""
        found = []
        while self and self.least() == label:
            found.append(self.pop()[1])
        return found


def _written(entries: Iterable[tuple]) -> Iterator[tuple]:
    """Entries by way of an unnamed file."""
    file = tempfile.TemporaryFile()  # noqa: SIM115  closed once it is read, or with the task
    some = []
    for entry in entries:
        some.append(entry)
        if len(some) == CHUNK:
            pickle.dump(some, file)
            some = []
    pickle.dump(some, file)
    file.seek(0)

    def read() -> Iterator[tuple]:
        with file:
            while chunk := pickle.load(file):
                yield from chunk
                if len(chunk) < CHUNK:
                    return

    return read()
