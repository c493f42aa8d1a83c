"""Words of a text and rolling hashes of their n-grams, on UTF-8 bytes with numpy.

Words are runs of ``[^\\x20\\x09-\\x0D]``, which is how ``bytes.split()`` cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

_B = 0x9E3779B97F4A7C15 | 1
_BINV = pow(_B, -1, 2**64)
#: Words longer than this take part in hashes by their digest, which bounds a piece's memory.
LONG_WORD = 256
#: Words hashed at once.
PIECE = 65_536
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_B, _BINV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[i] = np.multiply.accumulate(steps)
    return _tables[0], _tables[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Grams:
    """Hashes of the n-grams of a list of words, any n, from one prefix hash over the joined words."""

    def __init__(self, words: list[bytes]) -> None:
        joined, starts, ends = self._cut(words)
        if len(words) and int((ends - starts).max()) > LONG_WORD:
            joined, starts, ends = self._cut([w if len(w) <= LONG_WORD else b"\x00" + hashlib.sha256(w).digest().replace(b" ", b"\x01") for w in words])
        power, self.inverse = _powers(len(joined) + 1)
        self.prefix = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum((np.frombuffer(joined, np.uint8).astype(np.uint64) + np.uint64(1)) * power[: len(joined)], out=self.prefix[1:])
        self.joined, self.starts, self.ends = joined, starts, ends

    @staticmethod
    def _cut(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        joined = b" ".join(words)
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        return joined, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(joined)]))

    def hashes(self, n: int) -> np.ndarray:
        """The hash of each run of n words; none if there are fewer."""
        count = len(self.starts) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        s, e = self.starts[:count], self.ends[n - 1 :]
        return mix((self.prefix[e] - self.prefix[s]) * self.inverse[s])

    def digests(self, n: int, at: np.ndarray) -> np.ndarray:
        """The first 128 bits of the SHA-256 of the runs of n words that start at the places ``at``, as rows of two integers."""
        view, digest = memoryview(self.joined), hashlib.sha256
        joined = b"".join([digest(view[s:e]).digest()[:16] for s, e in zip(self.starts[at].tolist(), self.ends[at + n - 1].tolist())])
        return np.frombuffer(joined, np.int64).reshape(-1, 2)


def pieces(words: list[bytes], overlap: int) -> Iterator[tuple[int, Grams]]:
    """Grams of bounded runs of the words; each run repeats the last ``overlap`` words of the one before."""
    step = PIECE
    for at in range(0, max(1, len(words) - overlap), step):
        run = words[at : at + step + overlap] if len(words) > step + overlap else words
        yield at, Grams(run)
        if run is words:
            return


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """Hashes of all n-word shingles; a shorter text is one shingle, an empty one the hash of no word."""
    if len(words) < n:
        return Grams(words or [b""]).hashes(max(1, len(words)))
    return np.concatenate([g.hashes(n) for _, g in pieces(words, n - 1)])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out
