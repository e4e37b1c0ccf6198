"""Runs of 100-byte windows that share their least k-gram, the units in which repeats are looked for.

Two equal windows have equal least k-grams (by a hash), so windows only need to be compared with
those of the same k-gram. Neighbouring windows mostly share it and form one run. k-grams that are
frequent come last in the order, so a window has one of them only if it has no other; the list of
frequent k-grams only steers how work is dealt out, never what is found.
"""

import numpy as np

WINDOW, GRAM = 100, 32
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1B54A32D192ED03
_INVERSE = pow(_BASE, -1, 1 << 64)
_LAST = np.uint64(1 << 63)
_MOST = 4096  # windows of a run


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on (GRAM is a power of two)."""
    h = data.astype(np.uint64) + np.uint64(1)
    step, power = 1, _BASE
    while step < GRAM:
        h = h[:-step] * np.uint64(power) + h[step:]
        step, power = 2 * step, power * power % (1 << 64)
    return _mix(h)


def window_least(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    rest = width - step
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def _powers(n: int, factor: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(factor)
    return np.multiply.accumulate(out)


def run_grams(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The least k-gram of each run, with no k-gram known as frequent."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64)
    least, good = _windows(gram_hashes(data) >> np.uint64(1), ends)
    return least[_firsts(least, good)].view(np.int64)


def _windows(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least k-gram of every window, and which windows lie within one text."""
    least = window_least(h, WINDOW - GRAM + 1)
    starts = np.concatenate([[0], ends[:-1]])
    good = np.zeros(len(least) + 1, np.int8)
    long = ends - starts >= WINDOW
    np.add.at(good, starts[long], 1)
    np.add.at(good, ends[long] - WINDOW + 1, -1)
    return least, np.cumsum(good[: len(least)], dtype=np.int8) > 0


def _firsts(least: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.flatnonzero(good & np.concatenate([[True], (least[1:] != least[:-1]) | ~good[:-1]]))


def runs(data: np.ndarray, ends: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of the windows of texts that stand one after the other in ``data`` and end at ``ends``.

    Returns text number, start in the text, number of windows, least k-gram, hash of the bytes covered,
    and whether the k-gram stands in the run twice, without which no two of its windows are equal.
    """
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none, none, none, none, none, none
    plain = gram_hashes(data)
    h = plain >> np.uint64(1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        h = np.where(frequent[at] == h, h | _LAST, h)
    starts = np.concatenate([[0], ends[:-1]])
    least, good = _windows(h, ends)
    first = _firsts(least, good)
    stop = np.flatnonzero(good & np.concatenate([(least[1:] != least[:-1]) | ~good[1:], [True]])) + 1
    # The last window of a text and the first of the next never touch: 99 positions lie between.
    count = stop - first
    if (count > _MOST).any():
        parts = -(-count // _MOST)
        first = np.concatenate([np.arange(f, s, _MOST) for f, s in zip(first, stop)])
        stop = np.minimum(first + _MOST, np.repeat(stop, parts))
        count = stop - first
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(plain * _powers(len(plain), _BASE))])
    back = _powers(len(plain), _INVERSE)
    body = (total[stop + WINDOW - GRAM] - total[first]) * back[first]
    owner = np.searchsorted(ends, first, side="right")
    gram, width = least[first], WINDOW - GRAM + 1
    inside = np.arange(width)
    opening = (h[first[:, None] + inside] == gram[:, None]).argmax(axis=1)
    closing = (h[(stop + width - 2)[:, None] - inside] == gram[:, None]).argmax(axis=1)
    twice = stop + width - 2 - closing > first + opening
    return owner, first - starts[owner], count, gram.view(np.int64), body.view(np.int64), twice.astype(np.int64)
