"""Language identification by partial matching: one byte context tree per language.

Each language has the counts of all byte strings up to ``order + 1`` in its training texts. A byte is
coded in the longest context seen; if it never followed that context, an escape is paid (method C:
distinct / (total + distinct)) and the next shorter context is tried, down to 8 bits for a byte
that the language never had. The counts stay frozen, every escape is paid in full, and the language
with the shortest code wins; ties go to the first name.

Texts are read whole: lower case, ASCII other than letters as space, runs of spaces as one.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows without a language,
a text or an id are not learned from; without any training row everything is ``und``. Repeated rows
each get the same answer. Other columns are kept and may have any name but ``lang_pred`` and ``score``.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .scratch import free_name, written

UND = "und"
_SPACES = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_CHUNK = 1 << 19


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def plain_bytes(text: str, order: int) -> bytes:
    """The coded bytes, after ``order`` spaces of context."""
    words = text.lower().encode("utf-8", "replace").translate(_SPACES).split()
    return b" " * order + b" ".join(words) + b" "


def gram_codes(data: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes that end at each position, as one number, from position length - 1 on."""
    n = len(data) - length + 1
    codes = np.zeros(max(n, 0), np.uint64)
    for k in range(length if n > 0 else 0):
        codes = (codes << np.uint64(8)) | data[k : k + n].astype(np.uint64)
    return codes


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class _Index:
    """Finds numbers in a sorted list; most are found by one look into a table of places."""

    def __init__(self, keys: np.ndarray, bits=20):
        self.keys, self.bits = keys, bits
        self.slot = np.zeros(1 << bits, np.int32)
        self.slot[self._place(keys)] = np.arange(len(keys), dtype=np.int32)

    def _place(self, codes):
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, wanted):
        if not len(self.keys):
            return _find(self.keys, wanted)
        at = self.slot[self._place(wanted)].astype(np.int64)
        hit = self.keys[at] == wanted
        rest = np.flatnonzero(~hit)
        at[rest], hit[rest] = _find(self.keys, wanted[rest])
        return at, hit


@dataclass
class PPM:
    """``grams[k]``: strings of k + 1 bytes seen in any language; ``costs[k]``: their code lengths in bits
    per language; ``contexts[k]`` and ``escapes[k]``: contexts of k bytes and the bits to leave them."""

    order: int
    langs: list[str]
    grams: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @classmethod
    def from_counts(cls, rows: pd.DataFrame, order: int) -> "PPM":
        """``rows``: lang, length, code, n."""
        langs = sorted(rows["lang"].unique())
        number = {name: i for i, name in enumerate(langs)}
        grams, costs, contexts, escapes = [], [], [], []
        for k in range(order + 1):
            part = rows[rows["length"] == k + 1]
            keys, at = np.unique(part["code"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
            n = np.zeros((len(keys), len(langs)))
            np.add.at(n, (at, part["lang"].map(number).to_numpy(np.int64)), part["n"].to_numpy(float))
            heads, head_of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((len(heads), len(langs))), np.zeros((len(heads), len(langs)))
            np.add.at(total, head_of, n)
            np.add.at(distinct, head_of, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                leave = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                coded = -np.log2(n / (total + distinct)[head_of])
            shorter = 8.0
            if k:
                tails, _ = _find(grams[-1], keys & np.uint64((1 << 8 * k) - 1))
                shorter = costs[-1][tails]
            grams.append(keys)
            costs.append(np.where(n > 0, coded, leave[head_of] + shorter))
            contexts.append(heads)
            escapes.append(leave)
        return cls(order, langs, grams, costs, contexts, escapes)

    def index(self) -> list[_Index]:
        return [_Index(g) for g in self.grams]

    def position_costs(self, data: np.ndarray, index: list[_Index]) -> np.ndarray:
        """Code length in bits per position from ``order`` on, per language."""
        codes = gram_codes(data, self.order + 1)
        out = np.empty((len(codes), len(self.langs)))
        at, hit = index[self.order].find(codes)
        out[hit] = self.costs[self.order][at[hit]]
        rest = np.flatnonzero(~hit)
        out[rest] = 0.0
        for k in range(self.order, -1, -1):
            if not len(rest):
                return out
            code = codes[rest] & np.uint64((1 << 8 * (k + 1)) - 1)
            if k < self.order:
                at, hit = index[k].find(code)
                out[rest[hit]] += self.costs[k][at[hit]]
                rest, code = rest[~hit], code[~hit]
            at, known = _find(self.contexts[k], code >> np.uint64(8))
            out[rest[known]] += self.escapes[k][at[known]]
        out[rest] += 8.0
        return out

    def code_lengths(self, texts: list[str], index: list[_Index]) -> np.ndarray:
        """Bits per text and language. Long texts go in pieces, short ones together."""
        bits, pieces, owners, held = np.zeros((len(texts), len(self.langs))), [], [], 0

        def flush():
            data = np.frombuffer(b"".join(pieces), np.uint8)
            costs = self.position_costs(data, index)
            starts = np.cumsum([0, *map(len, pieces)])
            for i, owner in enumerate(owners):
                bits[owner] += costs[starts[i] : starts[i + 1] - self.order].sum(axis=0)

        for owner, text in enumerate(texts):
            data = plain_bytes(text, self.order)
            for start in range(0, len(data) - self.order, _CHUNK):
                piece = data[start : start + _CHUNK + self.order]
                pieces.append(piece)
                owners.append(owner)
                held += len(piece)
                if held >= _CHUNK:
                    flush()
                    pieces, owners, held = [], [], 0
        if pieces:
            flush()
        return bits


def training_rows(docs: DataFrame, max_docs=300, key="doc_id", lang="lang", text="text") -> DataFrame:
    """At most ``max_docs`` whole documents of each language, chosen by a hash of their id."""
    named = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    rows = named.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key)).alias("_at"))
    # Written first: one row per language, so Spark knows that it is small and deals no text by language.
    sizes, _ = written(rows.groupBy("lang").agg(F.count("*").alias("_n")), "languages")
    share = (F.col("_at") % 1_000_000 + 1_000_000) % 1_000_000 < 1_000_000.0 * 2 * max_docs / F.col("_n")
    near = rows.join(sizes, "lang").where(share)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_at", "text"))
    return near.withColumn("_place", place).where(F.col("_place") <= max_docs).select("lang", "text")


def fit(docs: DataFrame, order=4, max_docs=300, key="doc_id", lang="lang", text="text") -> PPM:
    """Counts in Spark over the bounded sample; only the counts come to the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"]):
                if not has_letter(value):
                    continue
                data = np.frombuffer(plain_bytes(value, order), np.uint8)
                for length in range(1, order + 2):
                    codes, n = np.unique(gram_codes(data, length)[order + 1 - length :], return_counts=True)
                    yield pd.DataFrame({"lang": name, "length": length, "code": codes.view(np.int64), "n": n})

    rows = training_rows(docs, max_docs, key, lang, text)
    counted = rows.mapInPandas(count, "lang string, length int, code long, n long")
    total = counted.groupBy("lang", "length", "code").agg(F.sum("n").alias("n"))
    return PPM.from_counts(total.toPandas(), order)


def identify(text: str | Column, model: PPM) -> Column:
    """``(lang_pred, score)`` of a text column; the score is the winner's share of 2^-bits."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ppm = shared.value
        index, names = ppm.index(), np.array([*ppm.langs, UND], object)
        for batch in batches:
            pred, score = np.full(len(batch), len(ppm.langs)), np.zeros(len(batch))
            good = [i for i, t in enumerate(batch) if ppm.langs and t is not None and has_letter(t)]
            if good:
                bits = ppm.code_lengths([batch.iloc[i] for i in good], index)
                pred[good] = bits.argmin(axis=1)
                score[good] = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
            yield pd.DataFrame({"lang_pred": names[pred], "score": score})

    # So marked, a filter on the answer does not get a second evaluation below it.
    return predict.asNondeterministic()(text)


def held_out(key="doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def identify_documents(docs: DataFrame, model: PPM, text="text") -> DataFrame:
    told = free_name(docs, "told")
    named = docs.withColumn(told, identify(text, model))
    return named.select(*docs.columns, f"{told}.lang_pred", f"{told}.score")
