"""Union-find over numpy arrays, for links found inside one task."""

from __future__ import annotations

import numpy as np


class Forest:
    """Disjoint sets of 0..n-1; add() joins many pairs at once."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.parent[at]
        while True:
            up = self.parent[r]
            if np.array_equal(up, r):
                return r
            r = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            open_ = ra != rb
            if not open_.any():
                return
            a, b = ra[open_], rb[open_]
            high, low = np.maximum(a, b), np.minimum(a, b)
            np.minimum.at(self.parent, high, low)  # each root hangs below its smallest partner, so there are no cycles
            flat = self.parent[self.parent]
            while not np.array_equal(flat, self.parent):
                self.parent = flat
                flat = flat[flat]
