"""Words of whole texts as arrays: where they begin and end, and a 64-bit hash of each.

A word is a run of bytes outside space and \\x09-\\x0D; A-Z hash like a-z. The hash is a polynomial over random byte
values modulo 2**64, taken from one running sum over the buffer, so a batch costs a few array operations whatever the
number of words. Texts are worked on in blocks, so memory follows the block and the longest single text's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: White space between words, and the same with everything else in ASCII but letters and digits.
WHITE = _SPACE
SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_random = np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE = _random.copy()
_VALUE[65:91] = _random[97:123]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, BLOCK + 1), _powers(_INVERSE, BLOCK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _block(data: np.ndarray, cuts: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one block; ``cuts`` are the places where a text begins."""
    n = len(data)
    inside = np.empty(n + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(gap[data], out=inside[1:-1])
    begins = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    at = cuts[(cuts > 0) & (cuts < n)]
    begins[at] = inside[at + 1]
    ends[at] = inside[at]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = (_UP, _DOWN) if n <= BLOCK else (_powers(_BASE, n), _powers(_INVERSE, n))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:n], out=sums[1:])
    return start, end, mix((sums[end] - sums[start]) * down[start])


def blocks(column: pa.Array, limit: int = BLOCK, gap: np.ndarray = WHITE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole rows as (first row, words per row, word hashes). ``gap``: the bytes between words.

    A run holds up to ``limit`` bytes or one longer text, which is hashed in pieces cut at white space.
    """
    data, offsets = text_buffers(column)
    row, rows = 0, len(column)
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        low, high = int(offsets[row]), int(offsets[stop])
        if high - low <= limit:
            start, _, hashes = _block(data[low:high], offsets[row:stop] - low, gap)
            yield row, np.diff(np.searchsorted(start, offsets[row : stop + 1] - low)), hashes
        else:
            parts = [_block(data[a:b], np.zeros(0, np.int64), gap)[2] for a, b in _pieces(data, low, high, limit)]
            hashes = np.concatenate(parts)
            yield row, np.array([len(hashes)]), hashes
        row = stop


def _pieces(data: np.ndarray, low: int, high: int, limit: int) -> Iterator[tuple[int, int]]:
    """Cut a long text at white space into pieces of about ``limit`` bytes; a longer word stays whole."""
    while low < high:
        end = min(low + limit, high)
        while end < high:
            gaps = np.flatnonzero(_SPACE[data[end : min(end + 4096, high)]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + 4096, high)
        yield low, end
        low = end


def spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in some bytes; a word also ends at ``cuts``, where a text begins."""
    parts = [(s + a, e + a, h) for a, b in _pieces(data, 0, len(data), BLOCK) for s, e, h in [_block(data[a:b], cuts - a)]]
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(3))


def runs(hashes: np.ndarray, width: int, start: int = 0) -> np.ndarray:
    """Hash of every ``width`` neighbouring values, in order; empty if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(start), np.uint64)
    for k in range(width):
        out = out * _BASE + hashes[k : k + n]
    return mix(out)


def stretch(same: np.ndarray, share: float) -> tuple[int, int]:
    """Longest [from, to) that begins and ends where ``same`` holds and has at least ``share`` of it; of equals the first."""
    at = np.flatnonzero(same)
    if not len(at):
        return 0, 0
    # from the i-th place to the j-th: j - i + 1 of at[j] - at[i] + 1, enough if gain[j] - gain[i] >= share - 1
    gain = np.arange(len(at)) - share * at
    first = np.searchsorted(-np.minimum.accumulate(gain), -(gain + 1 - share) - 1e-9)
    size = at - at[first] + 1
    j = int(size.argmax())
    return int(at[first[j]]), int(at[j]) + 1
