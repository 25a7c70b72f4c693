"""Burrows-Wheeler transforms of sets of byte strings, and their merge without sorting again.

A string is followed by an end mark and read as a ring, so rows are rotations and the row that begins
with some characters is found from the row that follows them. Merging refines the interleaving of two
sets of rows: starting with all rows of the first set before those of the second, each round
replays the transform once (Holt and McMillan 2014), here by the four characters before each row at a time, or two
where there are too many different fours. The same replay tells common prefixes: rows that
agree are a block, and a round cuts a block where the characters before its rows, or the blocks that follow those, differ.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


#: Most different groups of four that are numbered: so that numbers have 16 bits, and from a table of at most so many pairs of twos.
KINDS, PAIRS = 1 << 16, 1 << 24


@dataclass
class Shard:
    """Strings laid end to end: symbols (0: end mark, else byte + 1; UTF-8 has no byte 255), and rows in order."""

    symbols: np.ndarray
    rows: np.ndarray

    @property
    def before(self) -> np.ndarray:
        """The transform: the symbol before each row."""
        return _before(self.symbols)[0][self.rows]


def _ring(lengths: np.ndarray, step: int) -> np.ndarray:
    """For each place the place ``step`` further on its own ring."""
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    length = np.repeat(lengths, lengths)
    return first + (np.arange(len(first)) - first + step) % length


def shard(strings: list[bytes]) -> Shard:
    """Rows sorted by prefix doubling on the rings, eight symbols at first; equal strings in the order given."""
    lengths = np.array([len(s) + 1 for s in strings], np.int64)
    ends = np.cumsum(lengths) - 1
    symbols = np.zeros(int(lengths.sum()), np.uint8)
    at = np.ones(len(symbols), bool)
    at[ends] = False
    symbols[at] = np.frombuffer(b"".join(strings), np.uint8) + 1
    key = symbols.astype(np.uint64)
    one = _ring(lengths, 1)
    depth, head = 1, key
    while depth < 8:
        head = head[one]
        key = key << np.uint64(8) | head
        depth += 1
    longest = int(lengths.max())
    while True:
        order = np.argsort(key)
        ordered = key[order]
        fresh = np.empty(len(key), bool)
        fresh[0] = False
        np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
        rank = np.cumsum(fresh)
        if rank[-1] == len(key) - 1:
            break
        if depth >= longest:  # only equal strings are left
            order = np.argsort(key, kind="stable")
            break
        place = np.empty(len(key), np.int64)
        place[order] = rank
        key = place * (rank[-1] + 1) + place[_ring(lengths, depth)]
        depth *= 2
    return Shard(symbols, order)


def _numbered(values: np.ndarray, bound: int) -> tuple[np.ndarray, int]:
    """Each value's number among the different ones, in their order, and how many there are; ``bound`` is above all values."""
    present = np.zeros(bound, bool)
    present[values] = True
    number = np.cumsum(present, dtype=np.int32) - 1
    return number[values], int(number[-1]) + 1


def _before(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each place the symbol before it on its ring; what stands in the ``step`` places before it, as a number of 16 bits; ``step``."""
    ends = np.flatnonzero(symbols == 0)
    previous = np.arange(-1, len(symbols) - 1)
    previous[np.append(0, ends[:-1] + 1)] = ends
    second = previous[previous]
    one = symbols[previous]
    two, kinds = _numbered(symbols[second].astype(np.int32) << 8 | one, 1 << 16)
    if kinds * kinds <= PAIRS:
        four, n = _numbered(two[second] * kinds + two, kinds * kinds)
        if n <= KINDS:
            return one, four.astype(np.uint16), 4
    return one, two.astype(np.uint16), 2


def merge(a: Shard, b: Shard, depth: int) -> Shard:
    """One shard of both sets of strings, its rows sorted by their first ``depth`` characters at least."""
    symbols = np.concatenate([a.symbols, b.symbols])
    rows_a, rows_b = a.rows, b.rows + len(a.symbols)
    _, before, step = _before(symbols)
    before_a, before_b = before[rows_a], before[rows_b]
    from_b = np.zeros(len(symbols), bool)
    from_b[len(rows_a) :] = True
    for _ in range(-(-depth // step)):
        before[~from_b] = before_a
        before[from_b] = before_b
        refined = from_b[np.argsort(before, kind="stable")]
        if np.array_equal(refined, from_b):
            break
        from_b = refined
    rows = np.empty(len(from_b), np.int64)
    rows[~from_b] = rows_a
    rows[from_b] = rows_b
    return Shard(symbols, rows)


def merge_all(shards: list[Shard], depth: int) -> Shard:
    """Pairwise, so that each string is merged a logarithmic number of times."""
    while len(shards) > 1:
        shards = [merge(*pair, depth) if len(pair) == 2 else pair[0] for pair in (shards[i : i + 2] for i in range(0, len(shards), 2))]
    return shards[0]


def blocks(merged: Shard, depth: int) -> np.ndarray:
    """For each row the number of its block: rows whose first ``depth`` characters are equal."""
    one, many, step = _before(merged.symbols)
    block = np.zeros(len(merged.rows), np.int32)
    for kind, rounds in ((one, depth % step), (many, depth // step)):
        if not rounds:
            continue
        before = kind[merged.rows]
        order = np.argsort(before, kind="stable")
        ordered = before[order]
        cut = np.append(False, ordered[1:] != ordered[:-1])
        for _ in range(rounds):
            followed = block[order]
            fresh = cut.copy()
            fresh[1:] |= followed[1:] != followed[:-1]
            block = np.cumsum(fresh, dtype=np.int32)
    return block


def repeated(merged: Shard, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose string goes on for ``depth`` bytes, in order, and for each the number of its interval of equal prefixes."""
    ends = np.flatnonzero(merged.symbols == 0)
    lengths = np.diff(ends, prepend=-1)
    room = np.repeat(ends, lengths) - np.arange(len(merged.symbols))
    long = room[merged.rows] >= depth
    return merged.rows[long], blocks(merged, depth)[long]
