"""Word shingles of whole texts as 64-bit hashes, vectorised over many texts at once.

Words are the maximal runs of bytes other than space and 0x09-0x0D, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_RNG = np.random.default_rng(20240229)
BYTE = _RNG.integers(0, 2 ** 64, 256, dtype=U)  # a random number for each byte value
STEP = U(0x9E3779B97F4A7C15)
CHARS = 2_000_000


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words begin (one more than there are texts)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, U), np.zeros(len(texts) + 1, np.int64)
    number = np.cumsum(first) - 1
    inside = np.arange(len(data)) - starts[np.maximum(number, 0)]
    inside[space] = 0
    power = np.full(int(inside.max()) + 1, STEP, U)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    part = BYTE[data] * power[inside]
    part[space] = 0
    long = np.add.reduceat((~space).astype(np.int64), starts)
    hashes = mixed(np.add.reduceat(part, starts) + long.astype(U) * U(0xD6E8FEB86659FD93))
    bounds = np.searchsorted(starts, np.append(0, np.cumsum(sizes)))
    return hashes, bounds


def batches(texts: list[str | None], chars: int = CHARS) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in order as (index of the first, lower-cased bytes), about ``chars`` bytes or one text each."""
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass").lower()
        if held and size + len(b) > chars:
            yield at, held
            at, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield at, held


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Of each text, the sorted distinct hashes of its ``width``-word shingles; of fewer
    words, the one hash of all of them; none without words."""
    odd = np.array([int(x) | 1 for x in np.random.default_rng(7).integers(0, 2 ** 64, width, dtype=U)], U)
    for _, held in batches(texts):
        words, bounds = word_hashes(held)
        n = max(0, len(words) - width + 1)
        run = np.zeros(n, U)
        for k in range(width):
            run += mixed(words[k:k + n] + odd[k]) * odd[k]
        run = mixed(run)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(run[a:b - width + 1])
            elif b > a:
                few = mixed(words[a:b] + odd[:b - a]) * odd[:b - a]
                yield mixed(np.array([few.sum(dtype=U) + U(b - a)], U))
            else:
                yield np.zeros(0, U)
