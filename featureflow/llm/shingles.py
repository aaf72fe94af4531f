"""Word-shingle sets of whole texts as sorted 64-bit hashes, in numpy.

Words are runs of anything but ASCII space and tab..carriage return, with A-Z
lower-cased. A text's set holds its distinct shingles of ``width`` words; a text
with fewer words has its whole sequence as the one element; one without words
has the empty set. Bytes are hashed in bounded chunks, so the working memory is
that of a text's words and not a multiple of the text.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
_LUT = _rng.integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_LUT[65:91] = _LUT[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_MUL = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MUL
    x = x ^ (x >> np.uint64(32))
    x = x * _MUL
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_POW = [_powers(_P, _CHUNK + 1), _powers(_P_INV, _CHUNK + 1)]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, start offsets and end offsets of the words of a byte array.

    A word's hash is a polynomial over a random table of its bytes: prefix sums
    with growing powers, differenced at the word's ends and shifted back.
    """
    hashes, starts, ends, lo, n = [], [], [], 0, len(data)
    while lo < n:
        hi = min(n, lo + _CHUNK)
        while hi < n and not _SPACE[data[hi]]:  # end the chunk between words
            step = _SPACE[data[hi:hi + 4096]]
            k = int(step.argmax())
            hi = hi + k if step[k] else min(n, hi + 4096)
        part = data[lo:hi]
        if len(part) > _CHUNK:
            pw, inv = _powers(_P, len(part)), _powers(_P_INV, len(part))
        else:
            pw, inv = _POW
        inside = np.concatenate(([False], ~_SPACE[part], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        a, b = edge[::2], edge[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LUT[part] * pw[:len(part)], out=sums[1:])
        hashes.append(mix((sums[b] - sums[a]) * inv[a] + (b - a).astype(np.uint64)))
        starts.append(a + lo)
        ends.append(b + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def _sequence(w: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    n = len(w) - width + 1
    s = np.full(n, width, np.uint64)
    for k in range(width):
        s = s * _P + w[k:k + n]
    return mix(s)


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted shingle set of each text."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    w, at, _ = word_hashes(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
    cut = np.concatenate(([0], np.searchsorted(at, ends)))
    every = _sequence(w, width) if len(w) >= width else None
    out = []
    for lo, hi in zip(cut[:-1], cut[1:]):
        if hi - lo >= width:
            s = np.sort(every[lo:hi - width + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif hi > lo:
            out.append(_sequence(w[lo:hi], hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    """A signed 64-bit id of a set, independent of order."""
    one = mix(s + _P).sum(dtype=np.uint64)
    two = mix(s ^ _MUL).sum(dtype=np.uint64)
    x = mix(np.array([one], np.uint64)) + np.array([two], np.uint64) * _P + np.uint64(len(s))
    return int(mix(x).view(np.int64)[0])


def batches_by_bytes(rows, limit: int = 1 << 20):
    """Groups (key.., text) rows so that the texts of a group stay near ``limit`` bytes."""
    group, size = [], 0
    for r in rows:
        group.append(r)
        size += len(r[-1])
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group
