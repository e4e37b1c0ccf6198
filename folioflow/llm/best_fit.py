"""Best-fit packing: large documents are matched in pairs, smaller ones fill the gaps that fit best.

Documents of more than a third of the capacity stand at most two in a sequence. Taken by falling
length, each is matched with the longest other that still fits beside it; as a shorter partner is
never harder to match elsewhere, no other pairing leaves fewer sequences. The rest follow by falling
length, each into the sequence with the least room that holds it, or a new one. Lengths are whole
numbers up to the capacity, so sequences lie on a stack for each room and one whole number has a
bit for each stack that is not empty.

Pieces are dealt at random into groups of bounded expected size, packed each on its own: a group
wastes part of one sequence of some thousands.

Edge cases: a null or empty text is its end id alone; repeated rows are packed as often as they come;
equal lengths go by id and start, null ids last; an empty table gives no rows; only the named columns
are read. A document longer than the capacity is cut into pieces of it, of which the last may be shorter.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .packing import groups_for, token_pieces


def match_and_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece, for pieces in falling order of length."""
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    n_large = sum(3 * n > capacity for n in lengths)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = opened = 0

    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sizes = 0
    for i in range(n_large - 1, -1, -1):
        waiting[lengths[i]].append(i)
        sizes |= 1 << lengths[i]
    matched = [False] * n_large

    def take(size: int) -> int:
        nonlocal sizes
        i = waiting[size].pop()
        if not waiting[size]:
            sizes ^= 1 << size
        matched[i] = True
        return i

    for i in range(n_large):
        if matched[i]:
            continue
        room = capacity - lengths[take(lengths[i])]
        bins[i] = opened
        partner = (sizes & ((2 << room) - 1)).bit_length() - 1
        if partner > 0:
            other = take(partner)
            bins[other], offsets[other] = opened, lengths[i]
            room -= partner
        stacks[room].append(opened)
        rooms |= 1 << room
        opened += 1

    for i in range(n_large, len(lengths)):
        size = lengths[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, own = capacity, opened
            opened += 1
        bins[i], offsets[i] = own, capacity - room
        stacks[room - size].append(own)
        rooms |= 1 << (room - size)
    return bins, offsets


def pack_best_fit(pieces: DataFrame, n_groups: int, capacity=2048, seed=23) -> DataFrame:
    """``pieces`` (with doc_id, start and length) with ``sequence_id`` and ``offset``."""

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = match_and_fit(group["length"].tolist(), capacity)
        number = int(group["_group"].iloc[0]) << 32
        return group.drop(columns="_group").assign(sequence_id=np.array(bins, np.int64) + number, offset=np.array(offsets, np.int64))

    dealt = pieces.withColumn("_group", F.floor(F.rand(seed) * n_groups).cast("long"))
    fields = ", ".join(f"{c} {t}" for c, t in pieces.dtypes)
    return dealt.groupBy("_group").applyInPandas(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, key="doc_id", text="text", tokenizer_path=None, end_id=0, capacity=2048, docs_per_group=8192, keep_ids=True) -> DataFrame:
    """Pieces numbered within their document, with their place, checksum of ids, and the ids themselves with ``keep_ids``."""
    pieces = token_pieces(docs, key, text, tokenizer_path, end_id, capacity, keep_ids)
    numbered = pieces.withColumn("piece", F.expr(f"start div {capacity}").cast("int"))
    return pack_best_fit(numbered, groups_for(docs, docs_per_group), capacity).withColumnRenamed("doc_id", key)
