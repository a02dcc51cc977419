"""A minimal perfect hash over 128-bit digests, built and asked with numpy.

Levels of bit tables: a digest that has a cell of its level to itself stays
there, the others go on to the next level.  Its slot is the rank of its cell, so
n digests have the slots 0 to n - 1.  Cells say nothing about digests that were
not put in; every answer is therefore verified against the digest in the slot.
"""

from __future__ import annotations

#: Cells per digest of a level; more cells, fewer levels.
CELLS = 2.0


def _cell(first, second, level: int, cells: int):
    """The cell of each digest in a level: its two halves, mixed anew for every level."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = first.view(np.uint64) + np.uint64(2 * level + 1) * second.view(np.uint64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(cells)).astype(np.int64)


class Slots:
    """Slots of the distinct digests among (first, second), two equally long int64 arrays."""

    def __init__(self, first, second):
        import numpy as np

        pairs = np.unique(np.stack([first, second], axis=1), axis=0)
        todo = np.arange(len(pairs))
        a, b = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
        self.levels, self.before, ranked = [], [], 0
        slot = np.empty(len(pairs), dtype=np.int64)
        while len(todo):
            cells = max(2, int(CELLS * len(todo)))
            at = _cell(a[todo], b[todo], len(self.levels), cells)
            alone = np.bincount(at, minlength=cells) == 1
            rank = np.cumsum(alone) - 1 + ranked
            placed = alone[at]
            slot[todo[placed]] = rank[at[placed]]
            self.levels.append(alone)
            self.before.append(rank)
            ranked += int(alone.sum())
            todo = todo[~placed]
        self.first, self.second = np.empty_like(a), np.empty_like(b)
        self.first[slot], self.second[slot] = a, b

    def __len__(self) -> int:
        return len(self.first)

    def of(self, first, second):
        """The slot of each digest, -1 for digests that are not in the table."""
        import numpy as np

        found, todo = np.full(len(first), -1, dtype=np.int64), np.arange(len(first))
        for level, (alone, rank) in enumerate(zip(self.levels, self.before)):
            at = _cell(first[todo], second[todo], level, len(alone))
            hit = alone[at]
            found[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
        known = found >= 0
        same = (self.first[found[known]] == first[known]) & (self.second[found[known]] == second[known])
        found[np.flatnonzero(known)[~same]] = -1
        return found
