"""Word and shingle hashes of whole texts, vectorised over the UTF-8 bytes of a batch.

A word's hash is a polynomial over its bytes modulo 2**64 with a random 64-bit coefficient per byte value, taken from
prefix sums, so a batch costs a few passes over its bytes and no Python loop over words. Texts are taken whole: a text
longer than a piece is hashed piece by piece, cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

PIECE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_COEFFICIENTS = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Byte values that belong to words: all but space and U+0009 to U+000D.
BETWEEN_SPACES = np.ones(256, dtype=bool)
BETWEEN_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Byte values that belong to words: digits, ASCII letters and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_ODD, _ODD_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a hash evenly over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(data: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of one piece."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = letters[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_COEFFICIENTS[_LOWER[data]] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts, ends


def _pieces(data: np.ndarray, letters: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Cut a long text between words. A word longer than a piece stays whole."""
    at = 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data):
            gap = np.flatnonzero(~letters[data[max(at, end - 4096) : end]])
            if len(gap):
                end = max(at, end - 4096) + int(gap[-1]) + 1
                break
            end = min(end + 4096, len(data))
        yield at, data[at:end]
        at = end


def words_of(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word of one text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    found = [(h, s + at, e + at) for at, piece in _pieces(data, letters) for h, s, e in [_words(piece, letters)]]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(part) for part in zip(*found))


def word_hashes(texts: Sequence[str | None], letters: np.ndarray) -> list[np.ndarray]:
    """The word hashes of each text, in order. NULL and texts without words give empty arrays."""
    out: list[np.ndarray] = []
    batch: list[bytes] = []

    def flush() -> None:
        if not batch:
            return
        joined = np.frombuffer(b"\n".join(batch), np.uint8)
        hashes, starts, _ = _words(joined, letters)
        bounds = np.cumsum([len(b) + 1 for b in batch[:-1]]) if len(batch) > 1 else []
        out.extend(np.split(hashes, np.searchsorted(starts, bounds)))
        batch.clear()

    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if len(data) > PIECE_BYTES:
            flush()
            size = 0
            out.append(words_of(text, letters)[0])
            continue
        if size + len(data) > PIECE_BYTES:
            flush()
            size = 0
        batch.append(data)
        size += len(data) + 1
    flush()
    return out


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words; as many as there are places for it."""
    places = len(hashes) - length + 1
    if places <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(places, np.uint64)
    for k in range(length):
        total = total * _ODD + hashes[k : k + places]
    return mix(total + np.uint64(length))


def shingle_set(hashes: np.ndarray, length: int) -> np.ndarray:
    """Distinct shingle hashes, ascending. Fewer words than ``length`` are one shingle; no words, none."""
    if len(hashes) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(windows(hashes, min(length, len(hashes))))
