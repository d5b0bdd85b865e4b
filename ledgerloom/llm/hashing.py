"""64-bit hashes of the words and word runs of a text, computed on whole arrays."""

from __future__ import annotations

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CASED = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
LOWERED = CASED.copy()
LOWERED[ord("A") : ord("Z") + 1] = CASED[ord("a") : ord("z") + 1]


class Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTES, _WORDS, _AGAIN = Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F), Powers(0xE7037ED1A0B428DB)


def _runs(values: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, from one running sum."""
    up, down = powers.upto(len(values) + 1)
    running = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=running[1:])
    return (running[end] - running[start]) * down[start]


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """One hash per word (a run without ASCII white space), with A-Z read as a-z if ``lower``."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    visible = np.zeros(len(data) + 2, bool)
    visible[1:-1] = ~WHITE[data]
    edges = np.flatnonzero(visible[1:] != visible[:-1])
    start, end = edges[::2], edges[1::2]
    values = (LOWERED if lower else CASED)[data]
    return mixed(_runs(values, start, end, _BYTES) + (end - start).astype(np.uint64) * np.uint64(BASE))


def run_hashes(words: np.ndarray, n: int, again: bool = False) -> np.ndarray:
    """One hash for each run of ``n`` consecutive words; ``again`` gives another one, to another base."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    start = np.arange(len(words) - n + 1)
    return mixed(_runs(words, start, start + n, _AGAIN if again else _WORDS))


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words; of the whole sequence if there are fewer."""
    return np.unique(run_hashes(words, min(n, len(words)))) if len(words) else np.zeros(0, np.uint64)


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` values, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out
