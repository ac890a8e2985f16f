"""Words of many texts at once, as 64-bit term ids (numpy; no per-word Python)."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
#: One random 64-bit value per byte.
_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 20)
        for name, b in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix(a: np.ndarray) -> np.ndarray:
    """Running polynomial sums (modulo 2**64), one longer than ``a`` (bytes)."""
    out = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_VALUE[a] * _powers(len(a))[0], out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial value over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_ids(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every byte span [start, end): equal spans have equal ids wherever they stand."""
    down = _powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_table(pattern_bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(pattern_bytes)] = True
    return t


#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
ALNUM = word_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: ``[^\\x20\\x09-\\x0D]+``
NONSPACE = word_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})


def spans(a: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(a) + 2, np.int8)
    inside[1:-1] = table[a]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def words_of(texts: list, table: np.ndarray, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Term ids of all words of the texts in order, and the number of words of each text.
    Work arrays cover ``block`` bytes at a time; longer texts are cut between words."""
    gap = b"\n"  # in neither word class
    data = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    ids, counts = [np.empty(0, np.uint64)], np.zeros(len(data), np.int64)
    at = 0
    while at < len(data):
        stop, size = at, 0
        while stop < len(data) and (stop == at or size + len(data[stop]) < block):
            size += len(data[stop]) + 1
            stop += 1
        if stop == at + 1 and size > block:
            for piece in _cut(data[at], table, block):
                a = np.frombuffer(piece, np.uint8)
                s, e = spans(a, table)
                ids.append(span_ids(prefix(a), s, e))
                counts[at] += len(s)
        else:
            a = np.frombuffer(gap.join(data[at:stop]), np.uint8)
            s, e = spans(a, table)
            ids.append(span_ids(prefix(a), s, e))
            edges = np.cumsum([0, *(len(d) + 1 for d in data[at:stop])])
            counts[at:stop] = np.diff(np.searchsorted(s, edges))
        at = stop
    return np.concatenate(ids), counts


def _cut(data: bytes, table: np.ndarray, block: int):
    """Pieces of about ``block`` bytes that end between words (a longer word stays whole)."""
    a = np.frombuffer(data, np.uint8)
    at = 0
    while at < len(a):
        stop = min(at + block, len(a))
        if stop < len(a):
            free = np.flatnonzero(~table[a[at:stop]])
            if len(free):
                stop = at + int(free[-1]) + 1
            else:
                while stop < len(a) and table[a[stop]]:
                    stop += 1
        yield data[at:stop]
        at = stop
