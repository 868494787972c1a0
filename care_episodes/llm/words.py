"""Hashes of words and word sequences of many texts at once."""

from __future__ import annotations

import numpy as np

_SEED = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so its powers never vanish

#: Bytes outside words, for the two kinds of words in use.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    filled = 1
    with np.errstate(over="ignore"):
        while filled < n:
            step = min(filled, n - filled)
            out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
            filled += step
    return out[:n]


#: Bytes worked on at a time; a longer word is a piece of its own.
PIECE = 1 << 20


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, end byte, row) of every word; a word is a run of bytes marked in `inside` within one row."""
    if len(data) <= PIECE:
        return _word_hashes(data, offsets, inside)
    gaps = np.flatnonzero(~inside[data])
    cuts = [0]
    while len(data) - cuts[-1] > PIECE:  # at the last gap of a piece, or the first one after it
        k = np.searchsorted(gaps, cuts[-1] + PIECE, side="right") - 1
        k = k if k >= 0 and gaps[k] > cuts[-1] else k + 1
        if k >= len(gaps):
            break
        cuts.append(int(gaps[k]))
    cuts.append(len(data))
    found = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        h, s, e, r = _word_hashes(data[a:b], np.clip(offsets, a, b) - a, inside)
        row = np.searchsorted(offsets, s + a, side="right") - 1
        found.append((h, s + a, e + a, row))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _word_hashes(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    mask = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], mask[:-1]]) if len(mask) else mask
    starts = np.flatnonzero(mask & (~before | edge[: len(mask)]))
    after = np.concatenate([mask[1:], [False]]) if len(mask) else mask
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    length = ends - starts
    # Only bytes of words count: gaps add nothing to the running sum.
    place = np.arange(len(data), dtype=np.int64)
    first = np.repeat(starts, np.diff(np.append(starts, len(data))))
    lead = int(starts[0])
    inside_word = place[lead:] - first
    inside_word[~mask[lead:]] = 0
    table = powers(int(length.max()))
    value = (data[lead:].astype(np.uint64) + np.uint64(1)) * table[inside_word]
    value[~mask[lead:]] = 0
    total = np.add.reduceat(value, starts - lead)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return mixed(total + length.astype(np.uint64) * _SEED), starts, ends, row


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive hashes (across rows too; callers mask those)."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    n = len(hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * np.uint64(pow(_BASE, 2 * k + 1, 1 << 64))
    return mixed(total)


def sequence_hash(hashes: np.ndarray, seed: int) -> int:
    """Hash of a whole sequence."""
    with np.errstate(over="ignore"):
        total = (hashes * powers(len(hashes))).sum(dtype=np.uint64) + np.uint64(len(hashes)) * _SEED
    return int(mixed(np.array([total ^ np.uint64(seed)]))[0])
