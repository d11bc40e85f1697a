"""Vectorised 64-bit hashes of words and byte strings inside tasks.

A string's hash is a polynomial in an odd base modulo 2^64 over a fixed random
value per byte, from one running sum per block; results are mixed so that all bits
can be used.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes hashed at a time (each takes some 60 bytes meanwhile).
BLOCK = 1 << 18
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next block."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK + 64), base, np.uint64)
        have[0] = 1
        _powers[str(base)] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    part = x >> _U(30)
    x = np.bitwise_xor(x, part)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, _U(27), out=part)
    x *= _U(0x94D049BB133111EB)
    x ^= np.right_shift(x, _U(31), out=part)
    return x


def running(raw: np.ndarray) -> np.ndarray:
    """S with the hash of raw[a:b] being (S[b] - S[a]) * base^a (see ``span``)."""
    out = np.zeros(len(raw) + 1, np.uint64)
    each = _LETTERS.take(raw)
    each *= _power(_INVERSE, len(raw))
    np.cumsum(each, out=out[1:])
    return out


def span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _spans(sums, start, end, sums.take(end))


def spans_to(sums: np.ndarray, start: np.ndarray, first: int) -> np.ndarray:
    """``span`` for ends that follow one another from ``first`` on."""
    end = np.arange(first, first + len(start))
    return _spans(sums, start, end, sums[first:first + len(start)].copy())


def _spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray, out: np.ndarray) -> np.ndarray:
    out -= sums.take(start)
    out *= _power(_BASE, len(sums)).take(start)
    out += (end - start).view(np.uint64)
    return mix(out)


def _words_of_block(raw: np.ndarray) -> np.ndarray:
    inside = ~_WHITE[raw]
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    if not len(edge):
        return np.empty(0, np.uint64)
    return span(running(_LOWER[raw]), edge[::2], edge[1::2])


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word of ``text``, A-Z in small letters.  Long texts go in
    blocks that end at white space."""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) <= BLOCK:
        return _words_of_block(raw)
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK)
        while end < len(raw):
            white = np.flatnonzero(_WHITE[raw[at:end]])
            if len(white):
                end = at + int(white[-1]) + 1
                break
            end = min(len(raw), end + BLOCK)  # a word longer than a block
        out.append(_words_of_block(raw[at:end]))
        at = end
    return np.concatenate(out)


def batch_word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """``word_hashes`` of several texts, short ones hashed together."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    group, size = [], 0

    def flush():
        if not group:
            return
        joined = np.frombuffer(b" ".join([texts[i] for i in group]), np.uint8)
        inside = ~_WHITE[joined]
        edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
        if not len(edge):
            return
        start = edge[::2]
        hashes = span(running(_LOWER[joined]), start, edge[1::2])
        ends = np.cumsum([len(texts[i]) + 1 for i in group])
        cut = np.searchsorted(start, ends)
        for i, a, b in zip(group, np.r_[0, cut[:-1]], cut):
            out[i] = hashes[a:b]

    for i, t in enumerate(texts):
        if len(t) > BLOCK // 2:
            out[i] = word_hashes(t)
            continue
        if size + len(t) > BLOCK:
            flush()
            group, size = [], 0
        group.append(i)
        size += len(t) + 1
    flush()
    return out


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes, in order of value, of all runs of ``n`` words; of fewer words the whole run."""
    if not len(words):
        return np.empty(0, np.uint64)
    k = min(n, len(words))
    h = words[:len(words) - k + 1].copy()
    for i in range(1, k):
        h = h * _U(0xD6E8FEB86659FD93) + words[i:len(words) - k + 1 + i]
    return np.unique(mix(h + _U(k)))
