"""Phrase collocations: counts of word sequences in weighted acyclic automata.

Texts are lower-cased (A to Z), cut into pieces at punctuation and line breaks, and pieces into words
at spaces and tabs. A phrase of two to four words counts all its occurrences within pieces, per
language. Shards of documents count their phrases, build an automaton per prefix range from the
sorted phrases, and the automata of a range are united, counts summed, in one stream with bounded
memory. Ranges are cut so that each has about as many words; a frequent first word is divided
by the second.

Only frequent phrases are wanted, and every part of a frequent phrase is frequent. So words are counted
first, then pairs of frequent words, then phrases of three and four whose pairs are all frequent.
Shards learn what is frequent from a bitmap of fixed size, indexed by hash: it may let a rare phrase
through, which is then counted and dropped, but never stops a frequent one.

A phrase is cut into two parts after each of its words; the counts of the parts are found by composing
the parts that fall in a range with the range's automaton. Ranges that many parts fall in are composed
in several tasks. The score of a cut is ``floor(scale * a / (l + r))``; the lowest counts.

Edge cases: a null text is empty; a null language counts as ``und``; repeated rows count as often as they
come; words are not changed beyond their case, and a tab is never part of one; equal scores go by count,
then by the bytes of the phrase; an empty table, or one without a frequent phrase, gives no rows; only
the named columns are read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .count_automata import CountAutomaton, mixed, union
from .scratch import written

UND = "und"
_CUT = 0xFF  # no byte of UTF-8
_SIGNS = bytes(_CUT if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS_AT_ONCE = 1 << 22
_FILTER_BITS = 24
_SAMPLES_PER_RANGE = 20
_PARTS_AT_ONCE = 100_000
_MOST_RANGES = 1 << 14
_TOP_SHARES = 16


class _Numbers(dict):
    """Numbers words as they come; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


@dataclass
class _Shard:
    """Texts of one language: the words, and all texts as word numbers in a row."""

    words: list[bytes]
    codes: np.ndarray


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Shard]]:
    """Texts by language, some millions of words at a time; a text is always whole."""
    held: dict[str, tuple[_Numbers, list]] = {}
    size = 0

    def give():
        for lang, (numbers, parts) in held.items():
            yield lang, _Shard(list(numbers), np.concatenate(parts))

    for batch in batches:
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            numbers, parts = held.setdefault(lang, (_Numbers({bytes([_CUT]): 0}), []))
            tokens = value.as_py().translate(_SIGNS).replace(b"\xff", b" \xff ").split()
            codes = np.empty(len(tokens) + 1, np.int32)
            codes[:-1] = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
            codes[-1] = 0
            parts.append(codes)
            size += len(codes)
            if size >= _WORDS_AT_ONCE:
                yield from give()
                held, size = {}, 0
    yield from give()


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\t" + word, 42)


def phrase_hash(hashes: np.ndarray) -> np.ndarray:
    """Of rows of word hashes."""
    return mixed(*hashes.T)


def _count_words(texts: DataFrame) -> DataFrame:
    """``(lang, word, n)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in _shards(batches):
            n = np.bincount(shard.codes, minlength=len(shard.words))[1:]
            words = pa.array(shard.words[1:], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), words, pa.array(n, pa.int64())], ["lang", "word", "n"])

    return texts.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _frequent_bits(hashes: DataFrame) -> np.ndarray:
    """A bit for each place that a hash falls in; two megabytes, whatever the number of hashes."""
    place = F.shiftrightunsigned("h", 64 - _FILTER_BITS)
    rows = hashes.select(F.shiftright(place, 15).alias("chunk"), place.bitwiseAND(F.lit(32767)).alias("bit"))
    bits = np.zeros((1 << _FILTER_BITS) // 8, np.uint8)
    for chunk in rows.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bits[4096 * chunk["chunk"] : 4096 * (chunk["chunk"] + 1)] = np.frombuffer(bytes(chunk["bits"]), np.uint8)
    return bits


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - _FILTER_BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


@dataclass
class Ranges:
    """Prefix ranges per language: ``cuts[lang]`` are sorted words, the same one several times if it is frequent."""

    cuts: dict[str, list[bytes]]
    first: dict[str, int]
    total: int

    @classmethod
    def over(cls, words: DataFrame, words_per_range: int) -> Ranges:
        """From word counts; a sample in proportion to the counts, of bounded size, comes to the driver."""
        n = words.agg(F.sum("n")).first()[0] or 0
        wanted = min(max(math.ceil(n / words_per_range), 1), _MOST_RANGES)
        each = max(n / (wanted * _SAMPLES_PER_RANGE), 1)
        chance = (F.xxhash64("word", "lang") / F.lit(float(1 << 64)) + F.lit(0.5)) * each
        rows = words.where(chance < F.col("n")).select("lang", "word", "n").collect()
        sizes = {r["lang"]: r["s"] for r in words.groupBy("lang").agg(F.sum("n").alias("s")).collect()}
        by_lang: dict[str, list] = {lang: [] for lang in sorted(sizes)}
        for r in rows:
            by_lang[r["lang"]].append((r["word"].encode(), max(r["n"], each)))
        cuts, first, total = {}, {}, 0
        for lang, sample in by_lang.items():
            sample.sort()
            mass = np.cumsum([w for _, w in sample])
            parts = max(round(wanted * sizes[lang] / n), 1)
            goals = np.arange(1, parts) * (mass[-1] / parts) if sample else []
            cuts[lang] = [sample[i][0] for i in np.searchsorted(mass, goals)]
            first[lang], total = total, total + parts
        return cls(cuts, first, total)

    def places(self, lang: str, symbols: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each word, the range it begins, and the last one if it begins several."""
        cuts = self.cuts.get(lang, [])
        return np.array([bisect_left(cuts, w) for w in symbols], np.int64), np.array([bisect_right(cuts, w) for w in symbols], np.int64)

    def of(self, lang: str, low: np.ndarray, high: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Of phrases: places of their first word and the lower place of their second (0 for single words)."""
        return self.first.get(lang, 0) + low + (high - low + 1) * second // (len(self.cuts.get(lang, ())) + 1)

    def of_phrases(self, langs: list[str], phrases: list[str]) -> list[int]:
        out = []
        for lang, phrase in zip(langs, phrases):
            cuts, (word, *more) = self.cuts.get(lang, []), phrase.encode().split(b" ")
            low, high = bisect_left(cuts, word), bisect_right(cuts, word)
            out.append(self.first.get(lang, 0) + low + (high - low + 1) * (bisect_left(cuts, more[0]) if more else 0) // (len(cuts) + 1))
        return out


def _shard_automata(texts: DataFrame, lengths: list[int], word_bits, pair_bits, ranges: Ranges) -> DataFrame:
    """``(range, lang, automaton)``: phrases of some lengths whose words, and pairs if told, may be frequent."""
    shared = texts.sparkSession.sparkContext.broadcast((word_bits, pair_bits, ranges))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_bits, pair_bits, ranges = shared.value
        for lang, shard in _shards(batches):
            own = lang.encode()
            hashes = np.fromiter((word_hash(own, w) for w in shard.words), np.uint64, len(shard.words))
            good = _has(word_bits, hashes)
            good[0] = False
            order = sorted(np.flatnonzero(good).tolist(), key=shard.words.__getitem__)
            symbols = [shard.words[i] for i in order]
            base = max(len(symbols), 1)
            number = np.full(len(shard.words), -1, np.int64)
            number[order] = np.arange(len(order))
            codes = number[shard.codes]
            low, high = ranges.places(lang, symbols)

            # Starts of phrases whose neighbouring words, or pairs of them, all may be frequent.
            starts = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
            if pair_bits is not None and len(starts):
                pairs, at = np.unique(codes[starts] * base + codes[starts + 1], return_inverse=True)
                at_hash = hashes[order]
                kept = _has(pair_bits, phrase_hash(np.stack([at_hash[pairs // base], at_hash[pairs % base]], axis=1)))
                starts = starts[kept[at]]
            linked = np.zeros(len(codes) + 1, bool)
            linked[starts] = True
            found: dict[int, list] = {}
            for k in lengths:
                here = starts
                for j in range(1, k - 1):
                    here = here[linked[here + j]]
                # Equal phrases are counted level by level, so that any number of words fits a key.
                keys = codes[here]
                levels = []
                for j in range(1, k):
                    keys, at = np.unique(keys * base + codes[here + j], return_inverse=True)
                    levels.append(keys)
                    keys = at
                if not len(here):
                    continue
                n = np.bincount(keys)
                ids, tail = [], levels[-1]
                for upper in levels[-2::-1]:
                    ids.append(tail % base)
                    tail = upper[tail // base]
                ids += [tail % base, tail // base]
                ids = np.stack(ids[::-1], axis=1)
                place = ranges.of(lang, low[ids[:, 0]], high[ids[:, 0]], low[ids[:, 1]])
                cuts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                for a, b in zip(cuts, np.append(cuts[1:], len(place))):
                    found.setdefault(int(place[a]), []).append((k, ids[a:b], n[a:b]))
            del codes, linked, starts
            for place, parts in found.items():
                used, at = np.unique(np.concatenate([ids.ravel() for _, ids, _ in parts]), return_inverse=True)
                phrases, start = {}, 0
                for k, ids, n in parts:
                    phrases[k] = at[start : start + ids.size].reshape(ids.shape), n
                    start += ids.size
                blob = CountAutomaton.build([symbols[i] for i in used], phrases).to_bytes()
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([lang]), pa.array([blob], pa.binary())], ["range", "lang", "automaton"])

    return texts.mapInArrow(build, "range int, lang string, automaton binary")


def _united(automata: DataFrame, least: int) -> DataFrame:
    """``(lang, range, phrase, n, h)`` of the phrases found ``least`` times or more: a range's automata are united as they come."""

    def finish(place: int, lang: str, held: list[CountAutomaton]) -> pa.RecordBatch:
        whole = union(held)
        phrases, n, h = [], [], []
        hashes = np.fromiter((word_hash(lang.encode(), w) for w in whole.symbols), np.uint64, len(whole.symbols))
        for ids, weights in whole.phrases().values():
            often = weights >= least
            phrases += [b" ".join([whole.symbols[i] for i in row]) for row in ids[often].tolist()]
            n += weights[often].tolist()
            h += phrase_hash(hashes[ids[often]]).view(np.int64).tolist()
        size = len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * size, pa.string()), pa.array([place] * size, pa.int32()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(h, pa.int64())],
            ["lang", "range", "phrase", "n", "h"],
        )

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting = None, [], 0
        for batch in batches:
            for place, lang, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if now is not None and now != (place, lang):
                    yield finish(*now, held)
                    held, waiting = [], 0
                now = place, lang
                held.append(CountAutomaton.from_bytes(blob.as_py()))
                waiting += len(held[-1].label)
                # What came since the last union is united with it once it is as large.
                if len(held) > 64 and waiting > len(held[0].label):
                    held, waiting = [union(held)], 0
        if now is not None:
            yield finish(*now, held)

    dealt = automata.repartition("range").sortWithinPartitions("range", "lang")
    return dealt.mapInArrow(unite, "lang string, range int, phrase string, n long, h long")


def frequent_phrases(docs: DataFrame, text="text", lang="lang", least=30, longest=4, words_per_range=1_000_000) -> tuple[DataFrame, DataFrame, Ranges]:
    """Word counts ``(lang, word, n)``, frequent words and phrases ``(lang, range, phrase, n)``, and the ranges."""
    spark = docs.sparkSession
    texts = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(lang).cast("string"), F.lit(UND)).alias("lang"), F.col(text).cast("binary").alias("text"))
    words, _ = written(_count_words(texts), "words")
    often = words.where(F.col("n") >= least)
    ranges = Ranges.over(words, words_per_range)
    word_bits = _frequent_bits(often.select(F.xxhash64(F.concat("lang", F.lit("\t"), "word")).alias("h")))
    pairs, _ = written(_united(_shard_automata(texts, [2], word_bits, None, ranges), least), "pairs")
    counted = often.select("lang", in_range(spark, ranges, F.col("lang"), F.col("word")).alias("range"), F.col("word").alias("phrase"), "n")
    counted = counted.unionByName(pairs.drop("h"))
    if longest > 2:
        longer = _shard_automata(texts, list(range(3, longest + 1)), word_bits, _frequent_bits(pairs.select("h")), ranges)
        more, _ = written(_united(longer, least), "phrases")
        counted = counted.unionByName(more.drop("h"))
    return words, counted, ranges


def in_range(spark: SparkSession, ranges: Ranges, lang: Column, phrase: Column) -> Column:
    shared = spark.sparkContext.broadcast(ranges)

    @F.pandas_udf("int")
    def place(lang: pd.Series, phrase: pd.Series) -> pd.Series:
        return pd.Series(shared.value.of_phrases(list(lang), list(phrase)), dtype="int32")

    return place(lang, phrase)


def _cut_parts(longest: int) -> Column:
    """``(cut, side, part)`` of a phrase: what stands before and after each cut."""
    words = F.split("phrase", " ", -1)
    cuts = [
        F.struct(F.lit(k).alias("cut"), F.lit(side).alias("side"), F.array_join(F.slice(words, F.lit(start), F.greatest(size, F.lit(0))), " ").alias("part"))
        for k in range(1, longest)
        for side, start, size in (("l", 1, F.lit(k)), ("r", k + 1, F.size(words) - k))
    ]
    return F.filter(F.array(*cuts), lambda c: c["cut"] < F.size(words))


def part_counts(counted: DataFrame, ranges: Ranges, longest=4) -> DataFrame:
    """``(lang, phrase, n, cut, side, found)``: the counts of the parts of every phrase of two words or more."""
    spark = counted.sparkSession
    phrases = counted.where(F.instr("phrase", " ") > 0).select("lang", "phrase", "n", F.explode(_cut_parts(longest)).alias("_c")).select("lang", "phrase", "n", "_c.*")
    placed = phrases.withColumn("range", in_range(spark, ranges, F.col("lang"), F.col("part")))
    parts, _ = written(placed, "parts")
    # A frequent word is part of many phrases: its range is composed in several tasks.
    loads, _ = written(parts.groupBy("range").agg(F.ceil(F.count("*") / _PARTS_AT_ONCE).cast("int").alias("tasks")), "loads")
    dealt = parts.join(loads, "range").withColumn("task", F.pmod(F.xxhash64("phrase", "cut"), F.col("tasks")).cast("int")).drop("tasks")
    known = counted.join(loads, "range").select("range", F.col("phrase").alias("known"), F.col("n").alias("times"), F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"))

    def look_up(known: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        rows = [p.encode().split(b" ") for p in known["known"]]
        symbols = sorted({w for row in rows for w in row})
        number = {w: i for i, w in enumerate(symbols)}
        times, phrases = known["times"].to_numpy(np.int64), {}
        for k in {len(row) for row in rows}:
            at = [i for i, row in enumerate(rows) if len(row) == k]
            phrases[k] = np.array([[number[w] for w in rows[i]] for i in at], np.int64), times[at]
        found = CountAutomaton.build(symbols, phrases).compose([p.encode().split(b" ") for p in parts["part"]])
        return parts[["lang", "phrase", "n", "cut", "side"]].assign(found=found)

    both = known.groupBy("range", "task").cogroup(dealt.groupBy("range", "task"))
    return both.applyInPandas(look_up, "lang string, phrase string, n long, cut int, side string, found long")


def collocations(docs: DataFrame, text="text", lang="lang", least=30, longest=4, scale=2_000_000, share=80, top=2000, words_per_range=1_000_000) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase inside a longer one that has at least ``share`` percent of its count is left out.
    """
    words, counted, ranges = frequent_phrases(docs, text, lang, least, longest, words_per_range)
    counted, _ = written(counted, "counted")
    long = F.col("n").cast("decimal(38,0)")
    cuts = part_counts(counted, ranges, longest).groupBy("lang", "phrase", "n", "cut").agg(
        F.max(F.when(F.col("side") == "l", F.col("found"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("found"))).alias("r")
    )
    scored = cuts.select("lang", "phrase", F.col("n").alias("a"), "cut", "l", "r", F.expr(f"(cast(n as decimal(28,0)) * {scale}) div (cast(l as decimal(28,0)) + r)").alias("score"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_m")).select("lang", "phrase", "a", "_m.score", "_m.l", "_m.r")

    split = F.split("phrase", " ", -1)
    inner = [F.array_join(F.slice(split, F.lit(s), F.lit(k)), " ") for k in range(2, longest) for s in range(1, longest - k + 2)]
    ends = [s + k - 1 for k in range(2, longest) for s in range(1, longest - k + 2)]
    sizes = [k for k in range(2, longest) for s in range(1, longest - k + 2)]
    inside = F.array_compact(F.array(*[F.when((F.size(split) >= e) & (F.size(split) > k), part) for part, e, k in zip(inner, ends, sizes)]))
    longer = counted.where(F.size(split) > 2).select("lang", "n", F.explode(inside).alias("phrase")) if longest > 2 else counted.where("false").select("lang", "n", "phrase")
    cover = longer.groupBy("lang", "phrase").agg(F.max(long).alias("covered"))
    left = lowest.join(cover, ["lang", "phrase"], "left").where(F.col("covered").isNull() | (100 * F.col("covered") < share * F.col("a").cast("decimal(38,0)")))

    # Leaders of each share of the phrases first, so that the last sort of a language is small at any size.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    shares = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_TOP_SHARES))).orderBy(*order)))
    leaders = shares.where(F.col("rank") <= top).drop("rank")
    ranked = leaders.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
