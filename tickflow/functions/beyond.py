"""Nearest later row with a larger value, inside a group and a time limit.

Rows come sorted by group and then by falling time, so everything later than a
row has been seen already. `Scan` takes them batch by batch and keeps, between
batches, only the rows that can still answer a question: those larger than
every row after them in the scan. Memory is one batch plus that staircase,
however long a group is.
"""

from __future__ import annotations

import numpy as np

_EMPTY_TIMES = np.empty(0, dtype=np.int64)
_EMPTY_VALUES = np.empty(0, dtype=np.float64)


def nearest_larger(values: np.ndarray, asked: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Per row i the last j in [first[i], end[i]) with values[j] > asked[i], or -1.

    Walks back from `end` in steps of falling powers of two over running
    maxima of that length, all rows at once: n log n, no pairs.
    """
    longest = int((end - first).max(initial=0))
    maxima = [values]
    while 2 << (len(maxima) - 1) <= longest:
        step = 1 << (len(maxima) - 1)
        last = maxima[-1]
        wider = last.copy()
        np.maximum(last[step:], last[:-step], out=wider[step:])
        maxima.append(wider)
    at = end.copy()
    for level in range(len(maxima) - 1, -1, -1):
        step = 1 << level
        skip = (at - step >= first) & (maxima[level][at - 1] <= asked)
        at[skip] -= step
    return np.where(at > first, at - 1, -1)


class Scan:
    """State of one direction (larger, or smaller by negating) over a partition."""

    def __init__(self, limit: int):
        self.limit = limit
        self._forget()

    def _forget(self):
        # Staircase, nearest row first: times and values both rise.
        self.stair_times, self.stair_values = _EMPTY_TIMES, _EMPTY_VALUES
        # Largest value at the last time seen, which is no answer at that time.
        self.tie_time, self.tie_value = None, None

    def answers(self, groups: np.ndarray, times: np.ndarray, values: np.ndarray, continued: bool) -> np.ndarray:
        """Time from each row to its answer, or -1. `groups` counts up from 0;
        `continued` tells whether group 0 is the last group of the batch before."""
        if not continued:
            self._forget()
        asked = np.where(np.isnan(values), np.inf, values)
        values = np.where(np.isnan(values), -np.inf, values)
        pending = self.tie_time is not None
        if pending:
            groups = np.concatenate([groups[:1], groups])
            times = np.concatenate([[self.tie_time], times])
            values = np.concatenate([[self.tie_value], values])
            asked = np.concatenate([[np.inf], asked])
        n = len(times)
        new_group = np.empty(n, dtype=bool)
        new_group[0] = True
        new_group[1:] = groups[1:] != groups[:-1]
        new_time = new_group.copy()
        new_time[1:] |= times[1:] != times[:-1]
        rows = np.arange(n)
        first = np.maximum.accumulate(np.where(new_group, rows, 0))
        end = np.maximum.accumulate(np.where(new_time, rows, 0))

        found = nearest_larger(values, asked, first, end)
        gap = np.where(found >= 0, times[found] - times, -1)
        if len(self.stair_times):
            open_rows = np.flatnonzero((found < 0) & (groups == groups[0]))
            step = np.searchsorted(self.stair_values, asked[open_rows], side="right")
            hit = step < len(self.stair_values)
            gap[open_rows[hit]] = self.stair_times[step[hit]] - times[open_rows[hit]]
        gap[gap >= self.limit] = -1

        self._keep(times, values, int(first[-1]), int(end[-1]), same_group=groups[-1] == groups[0])
        return gap[1:] if pending else gap

    def _keep(self, times, values, first, end, same_group):
        near_values, near_times = values[first:end][::-1], times[first:end][::-1]
        if len(near_values):
            top = np.maximum.accumulate(near_values)
            record = near_values > np.concatenate([[-np.inf], top[:-1]])
            near_times, near_values = near_times[record], near_values[record]
        if same_group:
            above = 0
            if len(near_values):
                above = np.searchsorted(self.stair_values, near_values[-1], side="right")
            near_times = np.concatenate([near_times, self.stair_times[above:]])
            near_values = np.concatenate([near_values, self.stair_values[above:]])
        self.tie_time, self.tie_value = times[-1], values[end:].max()
        reach = np.searchsorted(near_times, self.tie_time + self.limit, side="left")
        self.stair_times, self.stair_values = near_times[:reach], near_values[:reach]
