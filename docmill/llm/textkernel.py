"""Vectorised tokenising and hashing of batches of texts with numpy.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, after A-Z are
lower-cased. Every hash is 64 bits wide, depends on nothing but the bytes, and
is the same in every process. Working memory follows ``BLOCK`` and the number
of words, not the size of the whole batch of bytes times eight.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S32, _S29 = np.uint64(32), np.uint64(29)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a 64-bit finaliser)."""
    x = x ^ (x >> _S32)
    x = x * _M1
    x = x ^ (x >> _S29)
    x = x * _M2
    return x ^ (x >> _S32)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        n = max(n, BLOCK + 4096)
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        for key, base in (("p", _P), ("i", inverse)):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[key] = np.cumprod(table, dtype=np.uint64)
    return _powers["p"], _powers["i"]


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, heads: tuple[int, ...] = ()) -> np.ndarray:
    """Hash data[starts[i]:ends[i]] for ascending, disjoint, non-empty runs.

    With heads, a row of hashes for each run: of the run, and of its first
    heads[0], heads[1], ... bytes (the whole run where it is shorter).
    """
    out = np.empty((len(starts), 1 + len(heads)), dtype=np.uint64)
    first = 0
    while first < len(starts):
        lo = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, lo + BLOCK, side="right")))
        hi = int(ends[last - 1])
        p, inv = _power_tables(hi - lo + 1)
        sums = np.empty(hi - lo + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * p[: hi - lo], out=sums[1:])
        a, b = starts[first:last] - lo, ends[first:last] - lo
        for k, e in enumerate((b, *(np.minimum(a + h, b) for h in heads))):
            out[first:last, k] = mix((sums[e] - sums[a]) * inv[a] + (e - a).astype(np.uint64))
        first = last
    return out if heads else out[:, 0]


def encode(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty, lone surrogates become '?'."""
    return [b"" if t is None else t.encode("utf-8", "replace") for t in texts]


def join_bytes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, a space after each, and the offset of each text (one more at the end)."""
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8) if raw else np.zeros(0, np.uint8)
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    return data, offsets


def word_runs(data: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of data."""
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~space[data]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the index of each text's first word (one more at the end)."""
    data, offsets = join_bytes(raw)
    data = _LOWER[data]
    starts, ends = word_runs(data)
    return hash_runs(data, starts, ends), np.searchsorted(starts, offsets)


def word_counts(raw: list[bytes]) -> np.ndarray:
    data, offsets = join_bytes(raw)
    starts, _ = word_runs(data)
    return np.diff(np.searchsorted(starts, offsets))


def slices(raw: list[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` bytes each; one longer text makes a range of its own."""
    lo = size = 0
    for i, r in enumerate(raw):
        if size and size + len(r) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(r) + 1
    if lo < len(raw):
        yield lo, len(raw)


_ODD = [np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3), np.uint64(0x1D8E4E27C47D124F)]


def ngram_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n neighbouring word hashes (across text borders, too); order matters."""
    if len(w) < n:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for j in range(n):
        total = total * _ODD[j % 5] + w[j : len(w) - n + 1 + j]
        total ^= total >> _S32
    return mix(total)


def shingle_sets(raw: list[bytes], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and their offsets.

    A text with fewer than n words has its whole sequence as its only shingle;
    a text without words has none.
    """
    w, at = words(raw)
    grams = ngram_hashes(w, n)
    sets: list[np.ndarray] = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= n:
            s = np.sort(grams[a : b - n + 1])
            keep = np.empty(len(s), dtype=bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            sets.append(s[keep])
        else:
            sets.append(ngram_hashes(w[a:b], b - a) if b > a else w[:0])
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=offsets[1:])
    return (np.concatenate(sets) if sets else w[:0]), offsets


def min_hashes(values: np.ndarray, offsets: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """k minima for each non-empty set, as rows of uint64; rows of empty sets are zero."""
    out = np.zeros((len(offsets) - 1, k), dtype=np.uint64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if not len(full):
        return out
    keys = mix(np.arange(1, 2 * k + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003))
    at = offsets[:-1][full]
    for j in range(k):
        x = (values ^ keys[j]) * (keys[k + j] | np.uint64(1))
        x ^= x >> _S32
        out[full, j] = np.minimum.reduceat(x * _M1, at)
    return out
