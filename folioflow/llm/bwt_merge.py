"""Repeated strings in a set of segments, by merging the Burrows-Wheeler transforms of its shards.

Every shard is sorted on its own once. The merge then interleaves the rows of all shards by one more
character a round: a row's character moves it to its row one position to the left, rows keep
their order within a character, and rows belong to one block as long as their strings agree so
far. A block boundary that appears in round h means a common prefix of h - 1 characters; the blocks
left after ``length`` rounds are the intervals of repeated strings. A row alone in its block is
settled, and so are all rows it leads to, so only rows of larger blocks go on to the next round.
"""

import numpy as np

_SYMBOLS = 257  # bytes and the end of a segment
_AT_ONCE = 7  # symbols that fit into 63 bits


def sort_shard(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array of segments that end with 0; ``ends`` gives each position its segment's end.

    Ends sort by the number of their segment. Prefix doubling, on tied rows only.
    """
    n, place = len(symbols), np.arange(len(symbols))
    key = np.zeros(n, np.uint64)
    for k in range(_AT_ONCE):
        at = place + k
        key = key * np.uint64(_SYMBOLS) + np.where(at <= ends, symbols[np.minimum(at, n - 1)], 0).astype(np.uint64)
    is_end = place == ends
    key[is_end] = np.arange(is_end.sum())
    key[~is_end] += np.uint64(is_end.sum())
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    step = _AT_ONCE
    while True:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            return order
        rows = order[tied]
        next_rank = rank[np.minimum(rows + step, ends[rows])]
        by = np.lexsort((next_rank, rank[rows]))
        rows, next_rank, own = rows[by], next_rank[by], rank[rows[by]]
        order[tied] = rows
        new[tied] = np.concatenate([[True], (own[1:] != own[:-1]) | (next_rank[1:] != next_rank[:-1])])
        rank[rows] = np.maximum.accumulate(np.where(new[tied], tied, 0))
        step *= 2


def repeated_blocks(segments: list[bytes], length: int, shard_bytes=1 << 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment number, position and block number of every string of ``length`` that occurs twice or more."""
    rows_segment, rows_position, symbols_before, step_left = [], [], [], []
    # One radix pass sorts 8-bit symbols; no byte of UTF-8 text is 255.
    kind = np.uint16 if any(b"\xff" in s for s in segments) else np.uint8
    first, offset = 0, 0
    while first < len(segments):
        last, size = first, 0
        while last < len(segments) and (last == first or size + len(segments[last]) <= shard_bytes):
            size += len(segments[last]) + 1
            last += 1
        sizes = np.array([len(s) + 1 for s in segments[first:last]])
        stops = np.cumsum(sizes)
        symbols = np.zeros(stops[-1], np.uint16)
        inside = np.ones(stops[-1], bool)
        inside[stops - 1] = False
        symbols[inside] = np.frombuffer(b"".join(segments[first:last]), np.uint8).astype(np.uint16) + 1
        ends = np.repeat(stops - 1, sizes)
        order = sort_shard(symbols, ends)
        row_of = np.empty(len(order), np.int64)
        row_of[order] = np.arange(len(order))
        begins = np.repeat(stops - sizes, sizes)
        # The transform: the symbol before each row's suffix, 0 where a segment begins.
        symbols_before.append(np.where(order > begins[order], symbols[np.maximum(order - 1, 0)], 0).astype(kind))
        step_left.append((row_of[np.maximum(order - 1, 0)] + offset).astype(np.int32))
        owner = np.repeat(np.arange(first, last), sizes)
        rows_segment.append(owner[order])
        rows_position.append((np.arange(len(order)) - begins)[order])
        first, offset = last, offset + len(order)
    none = np.zeros(0, np.int64)
    if not rows_segment:
        return none, none, none
    before, left = np.concatenate(symbols_before), np.concatenate(step_left)
    rows = np.arange(len(before), dtype=np.int32)  # the shards one after the other: the interleave by no character
    block = np.zeros(len(before), np.int32)
    for done in range(1, length + 1):
        symbol = before[rows]
        # Rows at the beginning of a segment lead nowhere; they sort first.
        by = np.argsort(symbol, kind="stable")[np.count_nonzero(symbol == 0) :]
        rows, block, symbol = left[rows[by]], block[by], symbol[by]
        edge = np.ones(len(rows) + 1, bool)
        edge[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(edge[:-1], dtype=np.int32)
        alone = edge[:-1] & edge[1:]
        if done == length or 10 * np.count_nonzero(alone) > len(rows):
            rows, block = rows[~alone], block[~alone]
        if not len(rows):
            return none, none, none
    return np.concatenate(rows_segment)[rows], np.concatenate(rows_position)[rows], block
