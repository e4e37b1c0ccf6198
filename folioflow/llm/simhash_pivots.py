"""Near-duplicates by SimHash, with links found through pivot distance tables.

A fingerprint has a bit for each of 64 positions, set if more than half of the shingle hashes have
it. For every distinct fingerprint the Hamming distances to reference fingerprints are computed
once. A distance to a reference changes by at most as much as the fingerprint does, so the largest
difference between two rows of a distance table is a lower bound of their distance.

The references stand in six groups, each within its own block of bits, plus some over all bits. Two
fingerprints that differ in at most three bits touch at most three blocks, so their distances to
the references of three other blocks are the same: the table is joined on the distances of each
three blocks. Pairs whose distances over all references differ by more than three are discarded and
the rest verified. A pair counts in the first of its block choices only, so it comes once.

Edge cases: null, empty and blank texts have fingerprint zero and link like any other; copies share
a fingerprint and are never paired with each other; rows with one id and two texts are two rows;
null ids get the component's smallest id; an empty table gives no rows.
"""

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .scratch import free_name, written

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_AT_ONCE = 1 << 16
_BLOCKS = (11, 11, 11, 11, 10, 10)
_AGREE = 3
_WIDE_REFERENCES = 8


def shingles_of(text: str | None, words_per_shingle: int) -> tuple[int, Iterator[bytes]]:
    """The number of shingles and the shingles in order; none for a text without words."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    n = max(len(words) - words_per_shingle + 1, 1)
    if not words:
        return 0, iter(())
    if n == 1:
        return 1, iter([b" ".join(words)])
    return n, map(b" ".join, zip(*(words[k:] for k in range(words_per_shingle))))


def text_fingerprint(text: str | None, words_per_shingle=3) -> int:
    n, shingles = shingles_of(text, words_per_shingle)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _AT_ONCE):
        size = min(_AT_ONCE, n - start)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, islice(shingles, size), repeat(42)), np.uint64, size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: str | Column, words_per_shingle=3) -> Column:
    """The 64 bits as a signed long."""

    @F.pandas_udf("long")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([text_fingerprint(t, words_per_shingle) for t in batch], dtype="int64")

    return compute(text)


def as_hex(bits: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _block_distances(bits: Column) -> list[Column]:
    """Per block, the distances to its references (one bit of the block each), four bits a distance."""
    packed, low = [], 0
    for width in _BLOCKS:
        own = F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << width) - 1))
        value = F.lit(0).cast("long")
        for j in range(width):
            value = F.shiftleft(value, 4).bitwiseOR(F.bit_count(own.bitwiseXOR(F.lit(1 << j))).cast("long"))
        packed.append(value)
        low += width
    return packed


def _wide_distances(bits: Column) -> Column:
    """The distances to references over all bits, a byte each."""
    value = F.lit(0).cast("long")
    for j in range(_WIDE_REFERENCES):
        reference = _signed(xxhash.xxh64_intdigest(b"reference", j))
        value = F.shiftleft(value, 8).bitwiseOR(F.bit_count(bits.bitwiseXOR(F.lit(reference))).cast("long"))
    return value


def distance_table(fingerprints: DataFrame, bits="bits") -> DataFrame:
    """One row per distinct fingerprint: ``blocks`` and ``wide`` hold its distances."""
    distinct = fingerprints.select(F.col(bits).alias("bits")).distinct()
    return distinct.select("bits", F.array(*_block_distances(F.col("bits"))).alias("blocks"), _wide_distances(F.col("bits")).alias("wide"))


def links(fingerprints: DataFrame, bits="bits", max_bits=3) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints that differ in at most ``max_bits`` bits."""
    if max_bits > len(_BLOCKS) - _AGREE:
        raise ValueError(f"at most {len(_BLOCKS) - _AGREE} bits")
    choices = list(combinations(range(len(_BLOCKS)), _AGREE))
    table = distance_table(fingerprints, bits)
    places = F.array(*[F.xxhash64(F.lit(i), *[F.get("blocks", F.lit(k)) for k in c]) for i, c in enumerate(choices)])
    # A third of all rows may share one place, but copies are one row here, and the join below splits
    # large places; only pairs that pass every test become rows.
    dealt = table.select("bits", "blocks", "wide", F.posexplode(places).alias("choice", "place"))
    a, b = dealt.select("bits", "wide", "choice", "place").alias("a"), dealt.select("bits", "wide", "choice", "place").alias("b")
    apart = F.col("a.bits").bitwiseXOR(F.col("b.bits"))
    near = F.lit(True)
    for j in range(_WIDE_REFERENCES):
        one, other = (F.shiftrightunsigned(f"{side}.wide", 8 * j).bitwiseAND(F.lit(255)) for side in "ab")
        near = near & (F.abs(one - other) <= max_bits)
    first, low, same = F.lit(None).cast("int"), 0, []
    for width in _BLOCKS:
        same.append(F.shiftrightunsigned(apart, low).bitwiseAND(F.lit((1 << width) - 1)) == 0)
        low += width
    for i, c in reversed(list(enumerate(choices))):
        first = F.when(same[c[0]] & same[c[1]] & same[c[2]], F.lit(i)).otherwise(first)
    met = (F.col("a.place") == F.col("b.place")) & (F.col("a.choice") == F.col("b.choice")) & (F.col("a.bits") < F.col("b.bits"))
    pairs = a.join(b, met & near & (F.bit_count(apart) <= max_bits) & (first == F.col("a.choice")))
    return pairs.select(F.col("a.bits").alias("a"), F.col("b.bits").alias("b"))


def text_key(text: str) -> Column:
    """Equal for equal texts; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _labelled(rows: DataFrame, max_bits: int) -> DataFrame:
    """``(bits, label)`` for every fingerprint."""
    labels = components(links(rows, max_bits=max_bits)).withColumnRenamed("node", "bits")
    return rows.select("bits").distinct().join(labels, "bits", "left").withColumn("label", F.coalesce("label", "bits"))


def near_duplicates(docs: DataFrame, key="doc_id", text="text", words_per_shingle=3, max_bits=3) -> DataFrame:
    """``key``, ``bits``, ``fingerprint`` and ``component_id`` for every row of ``docs``."""
    rows, _ = written(docs.select(F.col(key).alias("_key"), fingerprint(text, words_per_shingle).alias("bits")), "fingerprints")
    labels = components(links(rows, max_bits=max_bits)).withColumnRenamed("node", "bits")
    smallest = rows.groupBy("bits").agg(F.min("_key").alias("_least"))
    named = smallest.join(labels, "bits", "left").withColumn("label", F.coalesce("label", "bits"))
    least = named.groupBy("label").agg(F.min("_least").alias("component_id"))
    ids = named.select("bits", "label").join(least, "label").select("bits", "component_id")
    return rows.join(ids, "bits").select(F.col("_key").alias(key), "bits", as_hex("bits").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, labelled: DataFrame, key="doc_id", text="text") -> DataFrame:
    """One row of ``docs`` for each label of ``labelled`` (``_key``, ``_text``, ``label``): smallest id, null last, then text.

    A row is known by its id and its text together, as ids may be null or stand on several texts.
    """
    told, _ = written(labelled.groupBy("label", "_key", "_text").agg(F.count("*").alias("_copies")), "groups")
    order = F.struct(F.col("_key").isNull().alias("no_key"), "_key", "_text", "_copies")
    own, kept_key, kept_text, copies = (free_name(docs, name) for name in ("own", "kept_key", "kept_text", "copies"))
    first = told.groupBy("label").agg(F.min(order).alias("_f"))
    first = first.select(F.col("_f._key").alias(kept_key), F.col("_f._text").alias(kept_text), F.col("_f._copies").alias(copies))
    named = docs.withColumn(own, text_key(text))
    kept = named.join(first, named[key].eqNullSafe(first[kept_key]) & (named[own] == first[kept_text]))
    # Rows with one id and one text are rare, and only they are gathered.
    alone = kept.where(F.col(copies) == 1)
    several = kept.where(F.col(copies) > 1).dropDuplicates([key, own])
    return alone.unionByName(several).select(*docs.columns)


def one_per_group(docs: DataFrame, key="doc_id", text="text", words_per_shingle=3, max_bits=3) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id.

    Rows of a group without any id are one group's rows like others; one of them stays.
    """
    made = docs.select(F.col(key).alias("_key"), text_key(text).alias("_text"), fingerprint(text, words_per_shingle).alias("bits"))
    rows, _ = written(made, "fingerprints")
    return keep_one(docs, rows.join(_labelled(rows, max_bits), "bits").select("_key", "_text", "label"), key, text)
