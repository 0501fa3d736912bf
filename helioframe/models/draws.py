"""Row samples of exact size, known at every position without a pass over the rows.

A sample of ``size`` out of ``n`` positions is a tree of counts: how many of a
range's draws fall in its left half is a binomial (with replacement) or
hypergeometric (without) number, drawn from a generator seeded by the sample
and the range. The leaves are blocks of ``BLOCK`` positions, in which the draws
are dealt out one by one. Any task can compute the counts of its own rows by
walking down to their blocks, so the counts of all rows always sum to ``size``,
whatever the partitioning, and nothing is collected or shuffled.

A sample of a sample (the bootstrap of a forest inside a bag) draws from the
first sample's positions; a row that was drawn twice holds two of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Positions dealt with together; only the cost depends on it once it is fixed.
BLOCK = 1024
#: NumPy draws hypergeometric numbers of populations below this; beyond it a
#: normal of the same mean and variance is rounded (sizes stay exact).
POPULATION = 1_000_000_000


def mixed(*parts) -> np.ndarray:
    """64-bit hash of integers or arrays of integers (SplitMix64 steps)."""
    with np.errstate(over="ignore"):
        h = np.uint64(0x9E3779B97F4A7C15)
        for part in parts:
            z = (np.asarray(part).astype(np.uint64) ^ h) + np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = z ^ (z >> np.uint64(31))
    return h


def uniform(hashed: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit hashes."""
    return (hashed >> np.uint64(11)).astype(np.float64) * 2.0**-53


@dataclass(frozen=True)
class Sample:
    """``size`` of ``n`` positions, of the positions of ``of`` if that is given."""

    n: int
    size: int
    replace: bool
    seed: int
    of: Sample | None = None

    def counts(self, positions: np.ndarray) -> np.ndarray:
        """How often each position was drawn."""
        blocks, place = np.unique(positions // BLOCK, return_inverse=True)
        drawn = [_block(self, int(b))[1] for b in blocks]
        begin = np.cumsum([0, *map(len, drawn)])[:-1]
        return np.concatenate([*drawn, np.empty(0, np.int64)])[begin[place] + positions % BLOCK]

    def _rows(self, low: int, high: int) -> int:
        """Positions to draw from in a range of blocks."""
        if self.of:
            return _before(self.of, high) - _before(self.of, low)
        return min(high * BLOCK, self.n) - low * BLOCK

    def _blocks(self) -> int:
        return self.of._blocks() if self.of else -(-self.n // BLOCK)

    def _generator(self, low: int, high: int) -> np.random.Generator:
        return np.random.default_rng([self.seed & (1 << 64) - 1, low, high])


@lru_cache(maxsize=1 << 16)
def _left(sample: Sample, low: int, high: int, size: int) -> int:
    """Of the ``size`` draws in blocks ``low`` to ``high``, those in the first half."""
    middle = (low + high) // 2
    here, left = sample._rows(low, high), sample._rows(low, middle)
    rng = sample._generator(low, high)
    if not size or not left:
        return 0
    if sample.replace:
        return int(rng.binomial(size, left / here))
    if here < POPULATION:
        return int(rng.hypergeometric(left, here - left, size))
    share = left / here
    spread = (size * share * (1 - share) * (here - size) / (here - 1)) ** 0.5
    return int(min(max(round(rng.normal(size * share, spread)), size - (here - left), 0), left, size))


def _down(sample: Sample, block: int) -> tuple[int, int]:
    """Draws before a block, and in it."""
    low, high, before, size = 0, sample._blocks(), 0, sample.size
    while high - low > 1:
        middle, left = (low + high) // 2, _left(sample, low, high, size)
        if block < middle:
            high, size = middle, left
        else:
            low, before, size = middle, before + left, size - left
    return before, size


def _before(sample: Sample, block: int) -> int:
    return sample.size if block >= sample._blocks() else _down(sample, block)[0]


@lru_cache(maxsize=1 << 12)
def _block(sample: Sample, block: int) -> tuple[int, np.ndarray]:
    """Draws before a block, and the count of each of its positions."""
    before, size = _down(sample, block)
    rng = sample._generator(block, block)
    if sample.of:
        held = _block(sample.of, block)[1]
    else:
        held = np.ones(min(BLOCK, sample.n - block * BLOCK), np.int64)
    total = int(held.sum())
    if not size:
        return before, np.zeros(len(held), np.int64)
    if sample.replace:
        return before, rng.multinomial(size, held / total)
    chosen = np.zeros(total, np.int64)
    chosen[rng.choice(total, size, replace=False)] = 1
    ends = np.cumsum(held)
    upto = np.concatenate([[0], np.cumsum(chosen)])
    return before, upto[ends] - upto[ends - held]


def weighted_counts(weights: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """``size`` draws with replacement by weight, by inverting the running weight."""
    running = np.cumsum(weights)
    if not size or not len(running) or running[-1] <= 0:
        return np.zeros(len(weights), np.int64)
    at = np.searchsorted(running, rng.random(size) * running[-1], side="right")
    # A draw on the last edge belongs to the last row that has weight.
    last = int(np.flatnonzero(weights > 0)[-1])
    return np.bincount(np.minimum(at, last), minlength=len(weights))
