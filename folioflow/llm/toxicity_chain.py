"""Toxicity by a classifier chain over hashed words.

The categories are predicted one after the other. The model of each is a logistic regression on
the share of words and word beginnings in a text (hashed to a fixed number of places) and on the
probabilities of the categories before it. For training, those probabilities come out of fold: the labelled documents are
dealt into folds by a hash of their id, and a document's probabilities are those of models that never
saw it. The threshold of a category is the one with the best F1 on out-of-fold probabilities, each sampled row
counting for the labelled rows of its combination of labels that it stands for: so the threshold is that of the
mix of labels in the table, not of the balanced sample.

Training takes a bounded sample of the labelled rows: at most ``max_rows`` documents per value of
each category, chosen by a hash of their id; everything else reads all rows and whole texts.

Edge cases: a null text has no words; labelled rows without a text, an id or one of the labels are not
learned from; labels of unknown ids are ignored; with several labels for one id the greatest counts, with several
texts the least is learned from;
a category with one value only predicts its share; without any labelled row all probabilities are 0
and no text is flagged; repeated rows each get the same result; other columns are kept.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = (5, 6, 7)
_CACHED_WORDS = 300_000


class _Places(dict):
    """Word -> its places: the word, and its beginnings, so that inflected forms count together."""

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > _CACHED_WORDS:
            self.clear()
        parts = ["=" + word, *(word[:k] for k in _PREFIXES if len(word) >= k)]
        places = self[word] = tuple(zlib.crc32(p.encode("utf-8", "replace")) % self.size for p in parts)
        return places


@lru_cache(maxsize=4)
def _places(size: int) -> _Places:
    return _Places(size)


@dataclass
class Features:
    """The places of a text and their values, growing with the share of words that have them."""

    places: np.ndarray
    values: np.ndarray


def text_features(text: str | None, size: int) -> Features:
    words = _WORD.findall((text or "").lower())
    each = np.fromiter(chain.from_iterable(map(_places(size).__getitem__, words)), np.int64)
    places, times = np.unique(each, return_counts=True)
    return Features(places, np.log1p(times * (200.0 / max(len(words), 50))))


def _flat(texts: list[Features]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(texts)), [len(t.places) for t in texts])
    return np.concatenate([np.zeros(0, np.int64), *(t.places for t in texts)]), np.concatenate([np.zeros(0), *(t.values for t in texts)]), owner


@dataclass
class Linear:
    """Word weights, weights of earlier probabilities, intercept."""

    words: np.ndarray
    earlier: np.ndarray
    intercept: float

    def probability(self, texts: list[Features], earlier: np.ndarray) -> np.ndarray:
        flat, value, owner = _flat(texts)
        score = np.bincount(owner, self.words[flat] * value, len(texts)) + earlier @ self.earlier + self.intercept
        return 1.0 / (1.0 + np.exp(-np.clip(score, -500, 500)))


def fit_linear(texts: list[Features], earlier: np.ndarray, y: np.ndarray, size: int, penalty=3.0, steps=60) -> Linear:
    """Logistic regression with classes of equal weight, by accelerated gradient steps per feature scale."""
    n, share = len(y), y.mean() if len(y) else 0.0
    if share in (0.0, 1.0):
        odds = 500.0 if share else -500.0
        return Linear(np.zeros(size), np.zeros(earlier.shape[1]), odds)
    flat, value, owner = _flat(texts)
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    # Step sizes by Adam: rare words move as fast as common ones.
    theta = [np.zeros(size), np.zeros(earlier.shape[1]), np.zeros(1)]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        score = np.bincount(owner, theta[0][flat] * value, n) + earlier @ theta[1] + theta[2][0]
        error = weight * (1.0 / (1.0 + np.exp(-np.clip(score, -500, 500))) - y)
        grads = [np.bincount(flat, error[owner] * value, size) + penalty * theta[0], earlier.T @ error + penalty * theta[1], np.array([error.sum()])]
        rate = 0.1 * min(1.0, 3.0 * (1 - step / (steps + 1)))
        for t, m, v, g in zip(theta, first, second, grads):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            t -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Linear(theta[0], theta[1], float(theta[2][0]))


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the gap below the cut of greatest F1, rows counting ``weight`` times; ties go to the highest cut."""
    if not len(y) or not y.any():
        return 1.1
    order = np.argsort(-p, kind="stable")
    right = np.cumsum((y * weight)[order])
    f1 = 2 * right / (np.cumsum(weight[order]) + right[-1])
    lower = np.append(p[order][1:], 0.0)
    f1[p[order] == lower] = -1.0  # ties stay together
    at = int(np.argmax(f1))
    return float((p[order][at] + lower[at]) / 2)


@dataclass
class Chain:
    size: int
    categories: list[str]
    models: list[Linear]
    thresholds: list[float]

    def predict(self, texts: list[Features]) -> np.ndarray:
        earlier = np.zeros((len(texts), 0))
        for model in self.models:
            earlier = np.column_stack([earlier, model.probability(texts, earlier)])
        return earlier


def fit_chain(rows: pd.DataFrame, categories: list[str], size=1 << 16, folds=5) -> Chain:
    """``rows``: text, fold, weight (how many labelled rows each stands for) and a 0/1 column per category."""
    texts = [text_features(t, size) for t in rows["text"]]
    seen = np.bincount(_flat(texts)[0], minlength=size) >= 3  # rarer places have no weight to learn
    texts = [Features(t.places[k], t.values[k]) for t in texts for k in [seen[t.places]]]
    fold = rows["fold"].to_numpy(np.int64) % folds
    earlier, models, thresholds = np.zeros((len(rows), 0)), [], []
    for name in categories:
        y = rows[name].to_numpy(float)
        out = np.zeros(len(rows))
        for k in range(folds):
            held, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
            if len(held) and len(rest):
                model = fit_linear([texts[i] for i in rest], earlier[rest], y[rest], size)
                out[held] = model.probability([texts[i] for i in held], earlier[held])
        models.append(fit_linear(texts, earlier, y, size))
        thresholds.append(best_threshold(out, y, rows["weight"].to_numpy(float)))
        earlier = np.column_stack([earlier, out])
    return Chain(size, categories, models, thresholds)


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows=1000, key="doc_id", text="text") -> pd.DataFrame:
    """The bounded training sample: the ids are chosen on narrow rows, then their texts fetched."""
    at = F.xxhash64(F.col(key), F.lit("sample"))
    known = labels.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max(c).cast("int").alias(c) for c in categories])
    known = known.dropna(subset=categories).withColumn("_at", F.pmod(at, F.lit(1 << 40)))
    wanted = None
    for c in categories:
        for value in (0, 1):
            # As a top-n query: every task keeps at most max_rows rows.
            some = known.where(F.col(c) == value).orderBy("_at").limit(max_rows)
            wanted = some if wanted is None else wanted.unionByName(some)
    chosen = wanted.distinct().toPandas()
    if chosen.empty:
        return pd.DataFrame({"text": [], "fold": [], "weight": [], **{c: [] for c in categories}})
    spark = docs.sparkSession
    ids = F.broadcast(spark.createDataFrame(chosen[[key]]))  # at most 2 * max_rows ids per category
    texts = docs.join(ids, key).where(F.col(text).isNotNull()).select(F.col(key).alias(key), F.col(text).alias("text"))
    rows = texts.groupBy(key).agg(F.min("text").alias("text")).toPandas().merge(chosen, on=key).sort_values("_at")
    # Within one combination of labels the rows are those of the least hashes, so each stands for equally many.
    of_table = known.groupBy(*categories).agg(F.count("*").alias("_all")).toPandas()  # one row per combination
    rows = rows.merge(of_table, on=categories, how="left")
    weight = rows["_all"] / rows.groupby(categories)[key].transform("size")
    return rows.assign(fold=rows["_at"] % 1000, weight=weight)


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows=1000, size=1 << 16, folds=5, key="doc_id", text="text") -> Chain:
    return fit_chain(labelled_sample(docs, labels, categories, max_rows, key, text), categories, size, folds)


def flag_toxic(docs: DataFrame, model: Chain, text="text") -> DataFrame:
    """``docs`` with a probability ``p_<category>`` and a flag ``<category>`` for each category."""
    shared = SparkSession.active().sparkContext.broadcast(model)
    fields = ", ".join(f"p_{c} double" for c in model.categories)

    @F.pandas_udf(fields)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            parts = []
            for first in range(0, len(batch), 512):
                texts = [text_features(t, own.size) for t in batch.iloc[first : first + 512]]
                parts.append(own.predict(texts))
            yield pd.DataFrame(np.concatenate([np.zeros((0, len(own.categories))), *parts]), columns=[f"p_{c}" for c in own.categories])

    told = docs.withColumn("_p", predict(F.col(text)))
    out = told.select(*docs.columns, *[F.col(f"_p.p_{c}").alias(f"p_{c}") for c in model.categories])
    return out.withColumns({c: F.col(f"p_{c}") >= F.lit(t) for c, t in zip(model.categories, model.thresholds)})
