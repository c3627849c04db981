"""DartMinHash signatures of weighted shingle sets.

Each unit of an element's weight is a region into which darts are thrown along a rank axis: a
hashed Poisson process of rate one, the same for equal regions in any text. A dart falls on one of
K coordinates, and each coordinate keeps its earliest dart. Two texts agree on a coordinate with
a probability equal to their weighted Jaccard similarity. Only darts below a rank bound are thrown,
about K (ln K + 4) per text however heavy it is; a text with an empty coordinate throws again up to
twice the bound.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])

SHINGLE_WORDS = 5


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = _inverses = np.ones(1, np.uint64)


def _power_table(base: int, size: int) -> np.ndarray:
    steps = np.full(size, _U(base), np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _grow(size: int) -> None:
    global _powers, _inverses
    if size > len(_powers):
        size = max(size, 2 * len(_powers))
        _powers, _inverses = _power_table(_BASE, size), _power_table(_BASE_INVERSE, size)


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, in text order. Words are runs of ASCII letters and digits and of all
    characters beyond ASCII, in lower case."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    word = np.concatenate([[False], _WORD[data], [False]])
    starts = np.flatnonzero(word[1:] & ~word[:-1])
    ends = np.flatnonzero(~word[1:] & word[:-1])
    _grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_mix(data.astype(np.uint64) + _U(1)) * _powers[: len(data)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * _inverses[starts])


def shingles(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash of each run of that many words; of a shorter text, of all its words."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for i in range(width):
        total = total * _U(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - width + 1 + i]
    return _mix(total + _U(width))


def weighted(text: str, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles in order, and how often each occurs."""
    return np.unique(shingles(text, words), return_counts=True)


def similarity(
    left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]
) -> float:
    """Weighted Jaccard similarity: the sum of smaller weights over the sum of larger ones."""
    _, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(left[1][i], right[1][j]).sum())
    return shared / max(int(left[1].sum() + right[1].sum()) - shared, 1)


def units(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One hash per unit of weight."""
    owner = np.repeat(elements, weights)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(weights) - weights, weights)
    return _mix(owner ^ _mix(nth.astype(np.uint64) + _U(0xA0761D6478BD642F)))


def _throw(units: np.ndarray, text: np.ndarray, bound: np.ndarray, k: int):
    """All darts of the units: rank, dart, and its coordinate in the flat signatures."""
    ranks, darts, places = [], [], []
    rank, nth = np.zeros(len(units)), 0
    while len(units):
        nth += 1
        dart = _mix(units + _U(nth * 0x9E3779B97F4A7C15 % 2**64))
        uniform = ((dart >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)
        rank = rank - np.log(uniform)
        below = rank < bound[text]
        units, text, rank, dart = units[below], text[below], rank[below], dart[below]
        ranks.append(rank)
        darts.append(dart)
        places.append(text * k + (_mix(dart) % _U(k)).astype(np.int64))
    return np.concatenate(ranks), np.concatenate(darts), np.concatenate(places)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """The signatures (texts x k) of non-empty weighted sets."""
    found = np.zeros((len(sets), k), np.uint64)
    todo = np.arange(len(sets))
    darts_wanted = k * (np.log(k) + 4)
    while len(todo):
        regions = [units(*sets[i]) for i in todo]
        sizes = np.fromiter(map(len, regions), np.int64, len(regions))
        flat = np.concatenate(regions)
        text = np.repeat(np.arange(len(todo)), sizes)
        rank, dart, place = _throw(flat, text, darts_wanted / sizes, k)
        # The last write wins, so the earliest dart is written last.
        order = np.argsort(-rank, kind="stable")
        earliest = np.zeros(len(todo) * k, np.uint64)
        covered = np.zeros(len(todo) * k, bool)
        earliest[place[order]] = dart[order]
        covered[place] = True
        full = covered.reshape(-1, k).all(axis=1)
        found[todo[full]] = earliest.reshape(-1, k)[full]
        todo = todo[~full]
        darts_wanted *= 2
    return found


def bands(signature: np.ndarray, n_bands: int) -> np.ndarray:
    """One key per band of consecutive coordinates, as signed 64-bit integers."""
    rows = signature.reshape(len(signature), n_bands, -1)
    key = np.full(rows.shape[:2], 0x2545F4914F6CDD1D, np.uint64)
    for i in range(rows.shape[2]):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + rows[:, :, i])
    return key.view(np.int64)


def fingerprint(text: str) -> tuple[int, int]:
    """128 bits of the sequence of words."""
    hashes = word_hashes(text)
    _grow(len(hashes) + 1)
    first = (hashes * _powers[: len(hashes)]).sum(dtype=np.uint64)
    second = (_mix(hashes + _U(1)) * _inverses[: len(hashes)]).sum(dtype=np.uint64)
    pair = _mix(np.array([first, second], np.uint64) + _U(len(hashes)))
    return tuple(pair.view(np.int64).tolist())
