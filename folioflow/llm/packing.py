"""Packing of token sequences: first-fit decreasing inside randomised groups of documents.

A document's ids, with the end id, are cut into pieces of at most ``capacity``. Pieces are dealt at
random into groups of bounded expected size, and every group is packed on its own: pieces by
falling length, each into the first sequence with room, found in a tournament tree whose nodes hold
the largest room below them. Only the last sequences of a group have room left.

Edge cases: a null or empty text is its end id alone; repeated rows are packed as often as they come;
equal lengths go by id and start; an empty table gives no rows; further columns are ignored. A
piece of exactly ``capacity`` fills a sequence by itself.
"""

import math
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

_CACHED_WORDS = 600_000
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


#: Signs at the end of a word, after a letter of ASCII or Latin-1: they are one token run of their own.
_END_SIGNS = re.compile(rb"(?:(?<=[a-z])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([!-&(-/:;=?@\[-`{-~]+)(?=\s|\Z)")


def _byte_signs() -> dict[int, str]:
    """The sign that byte-level vocabularies use for each byte: itself if it can be printed, else the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


class _Known(dict):
    """Ids of words; missing ones come from the older cache or the tokenizer."""

    def __init__(self, older: dict[bytes, bytes], learn: Callable[[bytes], bytes]):
        self.older, self.learn = older, learn

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.older.get(word) or self.learn(word)
        return ids


class WordTokenizer:
    """Ids of a tokenizer that drops white space and case, word by word with a cache of bounded size.

    White space always ends a token, so a text's ids are those of its words in a row. Signs after a
    word's last letter are a token run of their own, so they are cut off and words share entries. A new
    word of Latin letters goes to the vocabulary's merges directly, any other through the whole
    tokenizer. A full cache becomes the older one, from which words still in use come back.
    """

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.signs = _byte_signs()
        self.known = _Known({}, self._learn)

    def _learn(self, raw: bytes) -> bytes:
        if raw.isalpha() and raw.islower():
            return array("I", [t.id for t in self.merges(raw.decode())]).tobytes()
        word = raw.decode("utf-8", "replace")
        small = word.lower()
        # Letters below U+0250 are one run for the tokenizer.
        if word.isalpha() and max(word) < "\u0250" and len(small) == len(word):
            return array("I", [t.id for t in self.merges(small.encode().decode("latin-1").translate(self.signs))]).tobytes()
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        for text in texts:
            data = (text or "").encode("utf-8", "replace")
            if b"<|" not in data:  # names of special tokens are told apart by case
                data = _END_SIGNS.sub(rb" \1", data.lower())
            if len(self.known) > _CACHED_WORDS:
                self.known.older = {}
                self.known = _Known(self.known, self._learn)
            yield b"".join(map(self.known.__getitem__, data.split()))


@lru_cache(maxsize=1)
def shared_tokenizer(path: str | None) -> WordTokenizer:
    """One tokenizer, and so one cache, for all tasks of a Python worker."""
    return WordTokenizer(path)


def token_pieces(docs: DataFrame, key="doc_id", text="text", tokenizer_path=None, end_id=2, capacity=4096, keep_ids=True) -> DataFrame:
    """One row per piece with the checksum of its ids and, with ``keep_ids``, the ids as little-endian 32-bit numbers."""
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = shared_tokenizer(tokenizer_path)
        for batch in batches:
            for first in range(0, len(batch), 256):
                some = batch.iloc[first : first + 256]
                out = []
                for doc, ids in zip(some["doc_id"], tokenizer.encode(list(some["text"]))):
                    ids += end
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        own = ids[4 * s : 4 * (s + capacity)]
                        out.append((doc, s, len(own) // 4, zlib.crc32(own), n, own)[: len(names)])
                frame = pd.DataFrame(out, columns=names)
                yield frame.astype({"doc_id": "Int64"})

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, _PIECE + ", ids binary" * keep_ids)


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, for pieces in falling order of length."""
    # Any two bins together hold more than one capacity, so this many are enough.
    leaves = 1 << (2 * (sum(lengths) // capacity + 1)).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for size in lengths:
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bins.append(at - leaves)
        offsets.append(capacity - room[at])
        room[at] -= size
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
    return bins, offsets


def pack(pieces: DataFrame, n_groups: int, capacity=4096, seed=17) -> DataFrame:
    """``pieces`` (with doc_id, start and length) with ``sequence_id`` and ``offset``."""

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(group["length"].tolist(), capacity)
        number = int(group["_group"].iloc[0]) << 32
        return group.drop(columns="_group").assign(
            sequence_id=np.array(bins, np.int64) + number, offset=np.array(offsets, np.int64)
        )

    dealt = pieces.withColumn("_group", F.floor(F.rand(seed) * n_groups).cast("long"))
    fields = ", ".join(f"{c} {t}" for c, t in pieces.dtypes)
    return dealt.groupBy("_group").applyInPandas(place, f"{fields}, sequence_id long, offset long")


def groups_for(docs: DataFrame, docs_per_group=1024) -> int:
    return max(1, math.ceil(docs.count() / docs_per_group))


def pack_documents(docs: DataFrame, key="doc_id", text="text", tokenizer_path=None, end_id=2, capacity=4096, docs_per_group=1024, keep_ids=True) -> DataFrame:
    """Pieces with their place, checksum of ids, and the ids themselves with ``keep_ids``."""
    pieces = token_pieces(docs, key, text, tokenizer_path, end_id, capacity, keep_ids)
    packed = pack(pieces, groups_for(docs, docs_per_group), capacity)
    return packed.withColumnRenamed("doc_id", key)
