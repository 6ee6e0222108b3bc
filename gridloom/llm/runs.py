"""Runs between white space as numbers: what is computed for a run is computed once while it stays cached."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from itertools import islice

import numpy as np

MOST_RUNS = 120_000
NEW_RUNS = 8_192


class RunTable:
    """Rows of a feature matrix by run. ``compute(runs)`` gives the rows of new ones; the table starts anew when full."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], most: int = MOST_RUNS):
        self.compute, self.most = compute, most
        self.index: dict[str, int] = defaultdict()
        self.start()

    def start(self) -> None:
        self.index.default_factory = None  # it refers to the index, which would not be freed
        self.index = defaultdict()
        self.index.default_factory = self.index.__len__
        self.rows: np.ndarray | None = None

    def look_up(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(row number of every run of all texts, the rows)."""
        if len(self.index) > self.most:
            self.start()
        have = len(self.index)
        numbers = np.fromiter((i for runs in texts for i in map(self.index.__getitem__, runs)), np.int64, sum(map(len, texts)))
        if len(self.index) > have:
            new = list(islice(self.index, have, None))
            parts = [self.compute(new[i : i + NEW_RUNS]) for i in range(0, len(new), NEW_RUNS)]  # bounds what computing takes
            self.rows = np.concatenate(parts if self.rows is None else [self.rows, *parts])
        return numbers, self.rows if self.rows is not None else self.compute([])
