"""64-bit hashes of words, shingles and windows over whole batches of texts, with numpy.

Words are runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``.  A word's hash is
a polynomial over random 64-bit values of its bytes, taken from prefix sums, so
a batch costs a few passes over its bytes and no step per word in Python.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Bytes hashed at once (a longer run without white space is taken whole).
_CHUNK = 1 << 20
_ODD, _ODD_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(fold: bool) -> np.ndarray:
    at = np.arange(256, dtype=np.uint64)
    if fold:
        at[65:91] += np.uint64(32)
    out = mix((at + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
    out[_SPACE] = 0
    return out


_TABLES = {fold: _table(fold) for fold in (False, True)}
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_ODD, _ODD_INVERSE)):
            steps = np.full(max(n, _CHUNK + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


def word_hashes(texts: list[bytes], fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, bounds) of all words of ``texts``, which are laid out one after another with a line break between.

    ``start`` and ``end`` are places in that layout; text i has the words
    ``bounds[i]`` to ``bounds[i + 1]``.  ``fold`` takes A-Z as a-z.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(data):
        end = min(at + _CHUNK, len(data))
        while end < len(data) and not _SPACE[data[end - 1]]:
            stop = np.flatnonzero(_SPACE[data[end:end + _CHUNK]])
            end = end + int(stop[0]) + 1 if len(stop) else min(end + _CHUNK, len(data))
        part = data[at:end]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~_SPACE[part]
        step = np.diff(inside)
        s, e = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        power, inverse = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_TABLES[fold][part] * power[: len(part)], out=sums[1:])
        h = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        found.append((h, s + at, e + at))
        at = end
    h, s, e = (np.concatenate(x) for x in zip(*found))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return h, s, e, np.concatenate([[0], np.searchsorted(s, ends)]).astype(np.int64)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, also those over a text's end; empty if there are fewer words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = 1
    for j in range(width):
        factor = factor * _ODD % (1 << 64)
        out += h[j:j + n] * np.uint64(factor)
    return mix(out)


def shingle_sets(texts: list[bytes], width: int, fold: bool = True) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words has none."""
    if not texts:
        return []
    h, _, _, bounds = word_hashes(texts, fold)
    runs = rolling(h, width)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(runs[a:b - width + 1]))
        elif b > a:
            out.append(rolling(h[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def as_bytes(column) -> list[bytes]:
    """An Arrow string column's values as UTF-8; null is empty."""
    import pyarrow as pa

    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]
