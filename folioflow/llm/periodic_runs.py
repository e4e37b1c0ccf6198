"""Periodic runs of words, found with a dictionary of basic factors.

Basic factors are the stretches of 1, 2, 4, ... words of a text. Each level names its factors so that
equal ones have one name; a factor of twice the length is named by the names of its halves. The
successor of a factor is the next start of an equal one. Within a run of period q, factors of the
least such length L >= q follow each other at steps of exactly q, and since q <= L, three in a row lie
within twice the factor's length: an arithmetic progression. So at level L every stretch of
neighbouring starts with one successor distance d, L / 2 < d <= L, proposes period d for the words
from its first start to the end of its last successor. A shorter period would show as a nearer
successor, and a word more on either side as one more start, so each maximal run is proposed once,
with its smallest period, whole.

Only factors that occur again go to the next level, so unlike texts end after a few levels. Many
short texts are taken together; one text is always taken whole, with some dozen numbers a word.

Edge cases: null, empty and blank texts have no words and no runs and collapse to an empty text; rows are
independent, so repeated rows and ids, and null ids, come out once per row; an empty table gives no
rows; only the named columns are read.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_WORDS_AT_ONCE = 1 << 18
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_words(key: int | None, text: bytes) -> list[bytes]:
    """Words between spaces, tabs and line breaks."""
    return text.split()


def find_runs(codes: np.ndarray, ends: np.ndarray, least=24, exponent=3) -> np.ndarray:
    """Rows ``(start, length, period)`` by start, then period.

    ``codes``: a number for each word, other numbers in other texts. ``ends``: the end of each word's text.
    """
    found, size = [], 1
    at = np.flatnonzero(np.ones(len(codes), bool))
    keys = codes
    while len(at):
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        names = np.empty(len(at), np.int64)
        names[order] = np.cumsum(new)
        step = np.zeros(len(at), np.int64)
        step[order[:-1]] = np.where(new[1:], 0, at[order[1:]] - at[order[:-1]])
        found.append(_progressions(at, step, size, least, exponent))

        # Factors that occur once cannot be part of a longer one that occurs twice.
        again = np.ones(len(at), bool)
        again[order] = ~(new & np.append(new[1:], True))
        own = np.zeros(len(codes) + 1, np.int64)
        own[at[again]] = names[again]
        whole = at[again & (at + 2 * size <= ends[at])]
        whole = whole[own[whole + size] > 0]
        keys = own[whole] * (len(codes) + 1) + own[whole + size]
        at, size = whole, 2 * size
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _progressions(at: np.ndarray, step: np.ndarray, size: int, least: int, exponent: int) -> np.ndarray:
    """Runs from neighbouring starts whose factors of ``size`` words recur at one distance."""
    near = (2 * step > size) & (step <= size)
    at, step = at[near], step[near]
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + 1) | (step[1:] != step[:-1])
    start = np.flatnonzero(first)
    count = np.diff(np.append(start, len(at)))
    period = step[start]
    length = count - 1 + period + size
    long = length >= np.maximum(least, exponent * period)
    return np.stack([at[start], length, period], axis=1)[long]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words outside what any run repeats after its first period."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def _judged(texts: list[list[bytes]], least: int, exponent: int) -> list[np.ndarray]:
    """The runs of each text."""
    sizes = np.array([len(t) if len(t) >= least else 0 for t in texts])
    bounds = np.cumsum(np.append(0, sizes))
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for t, n in zip(texts, sizes) if n for w in t), np.int64, bounds[-1])
    codes += np.repeat(np.arange(len(texts)), sizes) * len(number)
    runs = find_runs(codes, np.repeat(bounds[1:], sizes), least, exponent)
    cuts = np.searchsorted(runs[:, 0], bounds)
    return [runs[cuts[i] : cuts[i + 1]] - [bounds[i], 0, 0] for i in range(len(texts))]


def periodic_runs(
    docs: DataFrame, key="doc_id", text="text", least=24, exponent=3, words_of: Callable[[int | None, bytes], list[bytes]] = split_words
) -> DataFrame:
    """``key``, ``runs`` (array of start, length, period, by start, then period) and ``collapsed`` per row.

    A run has at least ``least`` words and ``exponent`` periods. ``words_of`` gives the words of a row
    from its key and text.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, keys, size = [], [], 0
            rows = zip(batch.column(0).to_pylist(), batch.column(1))
            for i, (own, value) in enumerate(rows):
                words = words_of(own, value.as_py() or b"")
                held.append(words)
                keys.append(own)
                size += len(words)
                if size >= _WORDS_AT_ONCE or i + 1 == len(batch):
                    yield _batch(keys, held, _judged(held, least, exponent))
                    held, keys, size = [], [], 0

    named = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("binary").alias("_text"))
    made = named.mapInArrow(judge, "_key long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return made.withColumnRenamed("_key", key)


def _batch(keys: list, texts: list[list[bytes]], runs: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(runs)
    spans = pa.StructArray.from_arrays([pa.array(rows[:, k], pa.int64()) for k in range(3)], fields=list(_RUN))
    offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
    left = [b" ".join(collapse(t, r) if len(r) else t) for t, r in zip(texts, runs)]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(offsets, spans), pa.array(left, pa.binary()).cast(pa.string())], ["_key", "runs", "collapsed"]
    )
