"""A key's rows in order within a stateful operator, without holding them all."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T

#: Map state that the rows wait in: pieces of sorted runs.
PIECE_KEY = T.StructType([T.StructField("run", T.LongType()), T.StructField("place", T.LongType())])
PIECE = T.StructType([T.StructField("rows", T.BinaryType())])


def _tail(frame: pd.DataFrame, by: list[str]) -> tuple:
    return tuple(frame[c].iloc[-1] for c in by)


class SortedFrames:
    """Sorts frames of one key by way of map state, which is empty again afterwards.

    Frames are gathered up to ``fan`` * ``rows`` rows, and each gathered frame becomes a sorted run, kept in
    pieces of ``rows`` rows; as soon as there are ``fan`` runs of a level they are merged to one of the
    next.  So ``fan`` pieces and one gathered frame are in memory at a time.  The columns of ``by`` are not
    null.  A single gathered frame, the common case, is sorted as it is.
    """

    def __init__(self, state, by: list[str], rows: int = 2_000, fan: int = 16) -> None:
        self.state, self.by, self.rows, self.fan = state, by, rows, fan
        self._runs: dict[int, list[tuple[int, int]]] = {}  # by level: number of a run, its pieces
        self._made = 0

    def take(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows of ``frames`` as frames that follow each other in order."""
        frames = self._gathered(frames)
        first = next(frames, None)
        second = next(frames, None)
        if second is None:
            if first is not None:
                yield self._sorted(first)
            return
        self._add(0, iter([self._sorted(first)]))
        del first
        while second is not None:
            self._add(0, iter([self._sorted(second)]))
            second = next(frames, None)
        left = [run for level in sorted(self._runs) for run in self._runs[level]]
        while len(left) > self.fan:  # the shortest runs come first
            left = left[self.fan :] + [self._store(self._merge(left[: self.fan]))]
        yield from self._merge(left)

    def _gathered(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            if held and sum(map(len, held)) + len(frame) > self.fan * self.rows:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(frame)
        if held:
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]

    def _sorted(self, frame: pd.DataFrame) -> pd.DataFrame:
        return frame.sort_values(self.by, ignore_index=True)

    def _add(self, level: int, frames: Iterator[pd.DataFrame]) -> None:
        runs = self._runs.setdefault(level, [])
        runs.append(self._store(frames))
        if len(runs) == self.fan:
            self._runs[level] = []
            self._add(level + 1, self._merge(runs))

    def _store(self, frames: Iterator[pd.DataFrame]) -> tuple[int, int]:
        run, pieces = self._made, 0
        self._made += 1
        for frame in frames:
            for begin in range(0, len(frame), self.rows):
                piece = frame.iloc[begin : begin + self.rows]
                self.state.updateValue((run, pieces), (pickle.dumps(piece, protocol=5),))
                pieces += 1
        return run, pieces

    def _load(self, run: int, place: int) -> pd.DataFrame:
        frame = pickle.loads(self.state.getValue((run, place))[0])
        self.state.removeKey((run, place))
        return frame

    def _merge(self, runs: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
        """Rows up to the least last row of the loaded pieces are complete and leave together."""
        places = {run: 0 for run, _ in runs}
        lengths = dict(runs)
        heads = {run: self._load(run, 0) for run in places}
        while heads:
            bound = min(_tail(head, self.by) for head in heads.values())
            ready = []
            for run, head in list(heads.items()):
                end = self._up_to(head, bound)
                ready.append(head.iloc[:end])
                heads[run] = head.iloc[end:]
                if end == len(head):
                    places[run] += 1
                    if places[run] < lengths[run]:
                        heads[run] = self._load(run, places[run])
                    else:
                        del heads[run]
            yield self._sorted(pd.concat(ready, ignore_index=True))

    def _up_to(self, head: pd.DataFrame, bound: tuple) -> int:
        """How many rows of a sorted piece are not behind ``bound``."""
        low, high = 0, len(head)
        for column, value in zip(self.by, bound):
            part = head[column].iloc[low:high]
            before = low + int(np.searchsorted(part, value, "left"))
            high = low + int(np.searchsorted(part, value, "right"))
            low = before
        return high
