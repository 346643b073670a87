"""Rows that wait in keyed state: sorted runs, cut into pages.

New rows are sorted some at a time and written as a run of pages, each a state value of its
own. Taken out, runs are merged with one page of each in memory. What is held at a time is
thus a matter of the sizes below, not of how many rows wait or how dense they are.

A row is a time and a rank, both 64-bit integers; ranks sort as the values do, missing
first. A block of rows is an array of two lines, times above ranks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

# Sizes of working memory: rows sorted at once, rows of a page, runs that are merged at once.
RUN_ROWS = 1 << 18
PAGE_ROWS = 1 << 12
MOST_RUNS = 64

_LAST = np.iinfo(np.int64).max
# What is known of a run: its number, its first page and the rows of that already taken,
# the rows left, the time of the first of them.
_RUN, _PAGE, _TAKEN, _LEFT, _TIME = range(5)


def ranks(values: np.ndarray) -> np.ndarray:
    """Integers in the order of the values, missing ones first."""
    bits = np.ascontiguousarray(values, np.float64).view(np.int64)
    return np.where(np.isnan(values), ~_LAST, bits ^ (bits >> 63 & _LAST))


def values(ranks: np.ndarray) -> np.ndarray:
    """What ``ranks`` was made from; not a number where it was missing."""
    return np.ascontiguousarray(ranks ^ (ranks >> 63 & _LAST)).view(np.float64)


def ordered(blocks: Sequence[np.ndarray]) -> np.ndarray:
    rows = np.concatenate(blocks, axis=1)
    return rows[:, np.lexsort((rows[1], rows[0]))]


class SortedRuns:
    """``pages`` maps (run, page) to the bytes of a page, as map state does; ``stored`` is
    what ``stored()`` gave before."""

    def __init__(self, pages, stored: Sequence[int] = ()):
        self.pages = pages
        self.runs = [list(stored[i : i + 5]) for i in range(0, len(stored), 5)]

    def stored(self) -> list[int]:
        return [x for run in self.runs for x in run]

    def first(self) -> int | None:
        """Earliest time of a row that waits."""
        return min((run[_TIME] for run in self.runs), default=None)

    def add(self, blocks: Iterable[np.ndarray]) -> None:
        held, n = [], 0
        for block in blocks:
            for i in range(0, block.shape[1], RUN_ROWS):
                part = block[:, i : i + RUN_ROWS]
                if n + part.shape[1] > RUN_ROWS:
                    self._write([ordered(held)])
                    held, n = [], 0
                held.append(part)
                n += part.shape[1]
        # small runs at the end are taken in, so that many small batches make few runs
        while n and self.runs and self.runs[-1][_LEFT] <= min(n, RUN_ROWS - n):
            run = self.runs.pop()
            n += run[_LEFT]
            held += self._merged([run], _LAST)
        if n:
            self._write([ordered(held)])

    def take(self, until: int) -> Iterator[np.ndarray]:
        """Blocks of the rows up to that time, in order; they wait no longer."""
        yield from self._merged([run for run in self.runs if run[_TIME] <= until], until)
        self.runs = [run for run in self.runs if run[_LEFT]]

    def _write(self, blocks: Iterable[np.ndarray]) -> None:
        """A run of the rows of sorted blocks. Where there are too many, the shorter half becomes one."""
        number = 1 + max((run[_RUN] for run in self.runs), default=-1)
        page, n, first, rest = 0, 0, None, np.empty((2, 0), np.int64)
        for block in blocks:
            first = int(block[0, 0]) if first is None else first
            n += block.shape[1]
            rest = np.concatenate([rest, block], axis=1)
            while rest.shape[1] >= PAGE_ROWS:
                self.pages.updateValue((number, page), (rest[:, :PAGE_ROWS].tobytes(),))
                rest, page = rest[:, PAGE_ROWS:], page + 1
        if rest.shape[1]:
            self.pages.updateValue((number, page), (rest.tobytes(),))
        self.runs = [*(run for run in self.runs if run[_LEFT]), [number, 0, 0, n, first]]
        if len(self.runs) > MOST_RUNS:
            by_size = sorted(self.runs, key=lambda run: run[_LEFT])
            self._write(self._merged(by_size[: MOST_RUNS // 2 + 1], _LAST))

    def _page(self, run: list[int]) -> np.ndarray:
        rows = np.frombuffer(self.pages.getValue((run[_RUN], run[_PAGE]))[0], np.int64).reshape(2, -1)[:, run[_TAKEN] :]
        run[_TIME] = int(rows[0, 0])
        return rows

    def _merged(self, runs: Sequence[list[int]], until: int) -> Iterator[np.ndarray]:
        """Blocks of the rows up to that time, in order; pages that were read go."""
        open_ = [(run, self._page(run)) for run in runs]
        while open_:
            # nothing that is still to be read comes before the end of a page
            time, rank = min((int(rows[0, -1]), int(rows[1, -1])) for _, rows in open_)
            if time > until:
                time, rank = until, _LAST
            taken, still = [], []
            for run, rows in open_:
                a, b = np.searchsorted(rows[0], time, "left"), np.searchsorted(rows[0], time, "right")
                n = int(a + np.searchsorted(rows[1, a:b], rank, "right"))
                taken.append(rows[:, :n])
                rows = rows[:, n:]
                run[_TAKEN] += n
                run[_LEFT] -= n
                if rows.shape[1]:
                    run[_TIME] = int(rows[0, 0])
                else:
                    self.pages.removeKey((run[_RUN], run[_PAGE]))
                    run[_PAGE], run[_TAKEN] = run[_PAGE] + 1, 0
                    rows = self._page(run) if run[_LEFT] else rows
                if run[_LEFT] and run[_TIME] <= until:
                    still.append((run, rows))
            open_ = still
            yield ordered(taken)
