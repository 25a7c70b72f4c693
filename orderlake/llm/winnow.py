"""Anchors: positions chosen by content alone, so that equal stretches of bytes share one.

The smallest hash of ``GRAM`` bytes in each stretch of ``length`` bytes is its anchor (the first
of equals). Two equal stretches, wherever they are, have their anchor at the same offset.
"""

from __future__ import annotations

import numpy as np

GRAM = 32
#: Bytes hashed at once; a longer text is read in overlapping chunks.
CHUNK = 1 << 18
#: Low bits of a key: the place in the chunk, which settles ties.
PLACE = 20

_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_ODD, CHUNK + 1), _powers(_INVERSE, CHUNK + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def _chunk_anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors in texts laid end to end (``ends``: where each stops): place, hash, hash of what is around, its first and last place."""
    n, reach = len(data), length - GRAM
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
    grams = _mix((sums[GRAM:] - sums[:-GRAM]) * _DOWN[: n - GRAM + 1])
    places = np.arange(n - GRAM + 1, dtype=np.uint64)
    keys = (grams >> np.uint64(PLACE)) << np.uint64(PLACE) | places
    least = _sliding_least(keys, reach + 1)
    lengths = np.diff(ends, prepend=0)
    end_of = np.repeat(ends, lengths)[: len(least)]
    inside = np.arange(len(least)) + length <= end_of
    chosen = np.zeros(n, bool)
    chosen[(least[inside] & np.uint64((1 << PLACE) - 1)).astype(np.int64)] = True
    at = np.flatnonzero(chosen)
    text = np.searchsorted(ends, at, "right")
    first = np.maximum(at - reach, (ends - lengths)[text])
    last = np.minimum(at + length, ends[text])
    around = _mix((sums[last] - sums[first]) * _DOWN[first] ^ _mix(((at - first) * 4096 + (last - at)).astype(np.uint64)))
    return text, at, grams[at], around


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(number of the text, place in it, hash, hash of the bytes around it that an equal stretch can cover)."""
    out: list[tuple[np.ndarray, ...]] = []
    group: list[tuple[int, int, bytes, int, int]] = []  # (text, where it starts in the text, bytes, its own places: from, to)
    held = 0

    def flush() -> None:
        if group:
            data = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
            ends = np.cumsum([len(g[2]) for g in group])
            text, at, gram, around = _chunk_anchors(data, ends, length)
            start = ends - np.array([len(g[2]) for g in group])
            number, base = np.array([g[0] for g in group]), np.array([g[1] for g in group])
            place = at - start[text] + base[text]
            low, high = (np.array([g[k] for g in group])[text] for k in (3, 4))
            own = (low <= place) & (place < high)
            out.append((number[text][own], place[own], gram[own], around[own]))
            group.clear()

    reach = length - GRAM
    for number, text in enumerate(texts):
        if len(text) < length:
            continue
        for start in range(0, max(1, len(text) - 2 * (reach + length)), CHUNK // 2):
            end = start + CHUNK // 2 + 2 * (reach + length)
            part = text[start:end]
            if held + len(part) > CHUNK:
                flush()
                held = 0
            # the surroundings of a chunk's own anchors lie whole in it, or end where the text does
            group.append((number, start, part, start + reach if start else 0, start + CHUNK // 2 + reach if end < len(text) else len(text)))
            held += len(part)
    flush()
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))
