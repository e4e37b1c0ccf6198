"""Removal of repeated byte strings, found by merging Burrows-Wheeler transforms.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts earlier, in a document with a
smaller id or earlier in the same one; strings never cross documents and are judged on the input.

1. Each document is cut into runs of windows with one least k-gram (``repeat_runs``). Runs with
   equal bytes are equal window by window: of them all but the first go at once, inside each task
   before the shuffle, then by k-gram.
2. Where one k-gram has different runs, or stands in one run twice, the first of each run goes on, with its bytes, to the merge of
   shard transforms (``bwt_merge``). Windows in one block are equal; all but the earliest go.
3. The windows found become byte spans, and the spans meet the texts again.

k-grams that a task sees often are counted first, and the frequent ones are avoided when windows
choose theirs, so a line that a third of all documents share does not gather them in one
group. That list is bounded (``MOST_FREQUENT``) and only steers where work is done.

Edge cases: a null text has no bytes; texts below 100 bytes lose none; rows with one id and different
texts are different documents, ordered by a hash of the text; rows with one id and one text are the same
document, so neither is earlier, and both get the same result; a null id comes before all others;
an empty table gives no rows; only the named columns are read.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .bwt_merge import repeated_blocks
from .repeat_runs import WINDOW, run_grams, runs
from .scratch import written

MOST_FREQUENT = 1_000_000  # k-grams, 8 MB
_OFTEN_IN_TASK, _OFTEN = 4, 64
_HELD_RUNS = 500_000
_TEXTS_BYTES = 1 << 16
_MERGE_BYTES = 1 << 16
_NO_ID = -(1 << 63)
_RUN = "doc long, text_key long, place long, gram long, body long"
_FOUND = "doc long, text_key long, start long, size long, gram long"


def _joined(batch: pd.DataFrame) -> Iterator[tuple[list, list, np.ndarray, np.ndarray]]:
    """Texts of a batch joined to parts that fit a cache: ids, text keys, bytes, and where each text ends."""
    docs, keys, texts, size = [], [], [], 0
    for doc, key, text in zip(batch["doc"], batch["text_key"], batch["text"]):
        docs.append(doc)
        keys.append(key)
        texts.append(text.encode("utf-8", "replace"))
        size += len(texts[-1])
        if size >= _TEXTS_BYTES:
            yield docs, keys, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
            docs, keys, texts, size = [], [], [], 0
    if texts:
        yield docs, keys, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _text_runs(batches: Iterator[pd.DataFrame], frequent: np.ndarray) -> Iterator[list[np.ndarray]]:
    """Runs of whole batches of texts, as arrays doc, text_key, start, count, gram, body, twice."""
    held, n = [], 0
    for batch in batches:
        for docs, keys, data, ends in _joined(batch):
            owner, *rest = runs(data, ends, frequent)
            held.append((np.array(docs, np.int64)[owner], np.array(keys, np.int64)[owner], *rest))
            n += len(owner)
            if n >= _HELD_RUNS:
                yield [np.concatenate(c) for c in zip(*held)]
                held, n = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def frequent_grams(texts: DataFrame) -> np.ndarray:
    """k-grams that are the least of many windows, from counts that each task prunes."""

    def often(grams):
        found, n = np.unique(np.concatenate(grams), return_counts=True)
        many = n >= _OFTEN_IN_TASK
        return pd.DataFrame({"gram": found[many], "n": n[many]})

    def count(batches):
        held, n = [], 0
        for batch in batches:
            for _, _, data, ends in _joined(batch):
                held.append(run_grams(data, ends))
                n += len(held[-1])
                if n >= _HELD_RUNS:
                    yield often(held)
                    held, n = [], 0
        if held:
            yield often(held)

    seen = texts.mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = seen.where(F.col("n") >= _OFTEN).orderBy(F.desc("n"), "gram").limit(MOST_FREQUENT)
    return np.sort(top.toPandas()["gram"].to_numpy(np.int64).view(np.uint64))


def _firsts(gram, body, count, doc, key, start):
    """Sort order by content and place, and which rows of it are the first of their content."""
    order = np.lexsort((start, key, doc, count, body, gram))
    g, b, c = gram[order], body[order], count[order]
    same = np.zeros(len(order), bool)
    same[1:] = (g[1:] == g[:-1]) & (b[1:] == b[:-1]) & (c[1:] == c[:-1])
    # Rows at one place are one document in several rows; none of them is earlier.
    d, k, s = doc[order], key[order], start[order]
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    same &= (d != d[lead]) | (k != k[lead]) | (s != s[lead])
    return order, ~same


def find_runs(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """One row per run; ``place`` holds start, twice and count, negative if an earlier equal run is known."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches):
        for doc, key, start, count, gram, body, twice in _text_runs(batches, shared.value):
            order, first = _firsts(gram, body, count, doc, key, start)
            place = ((start << 14) | (twice << 13) | count)[order]
            place = np.where(first, place, ~place)
            yield pd.DataFrame({"doc": doc[order], "text_key": key[order], "place": place, "gram": gram[order], "body": body[order]})

    return texts.mapInPandas(emit, _RUN)


def judge_runs(found: DataFrame) -> DataFrame:
    """Spans that go (``gram`` null), and runs to compare byte by byte (``gram`` set, ``size`` their windows)."""
    # Runs already known to go are spread by document, the others meet by k-gram.
    to = F.when(F.col("place") < 0, F.xxhash64("doc", "place")).otherwise(F.col("gram"))
    dealt = found.repartition(to).sortWithinPartitions("gram", "body", "doc", "text_key", "place")

    def judge(frame: pd.DataFrame):
        doc, key, place, gram, body = (frame[c].to_numpy(np.int64) for c in ("doc", "text_key", "place", "gram", "body"))
        known = place < 0
        place = np.where(known, ~place, place)
        start, twice, count = place >> 14, (place >> 13) & 1, place & 8191
        open_rows = np.flatnonzero(~known)
        order, first = _firsts(gram[open_rows], body[open_rows], count[open_rows], doc[open_rows], key[open_rows], start[open_rows])
        rows = open_rows[order]
        late = np.zeros(len(frame), bool)
        late[rows[~first]] = True
        gone = known | late
        lead = rows[first]
        grams, at, n = np.unique(gram[lead], return_inverse=True, return_counts=True)
        compare = lead[(n[at] > 1) | (twice[lead] > 0)]
        out = np.concatenate([np.flatnonzero(gone), compare])
        is_span = np.arange(len(out)) < gone.sum()
        return pd.DataFrame(
            {
                "doc": doc[out], "text_key": key[out], "start": start[out],
                "size": np.where(is_span, count[out] + WINDOW - 1, count[out]),
                "gram": pd.Series(gram[out], dtype="Int64").mask(is_span),
            }
        )

    def stream(batches):
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            gram = batch["gram"].to_numpy()
            cut = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0
            rest = batch.iloc[cut:]
            if cut:
                yield judge(batch.iloc[:cut])
        if rest is not None and len(rest):
            yield judge(rest)

    return dealt.mapInPandas(stream, _FOUND)


def merge_runs(segments: DataFrame) -> DataFrame:
    """Spans of windows that equal an earlier window of another run (doc, text_key, start, size)."""
    dealt = segments.repartition("gram").sortWithinPartitions("gram")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        doc, key, start = (frame[c].to_numpy(np.int64) for c in ("doc", "text_key", "start"))
        segment, position, block = repeated_blocks([bytes(s) for s in frame["bytes"]], WINDOW)
        at = start[segment] + position
        order = np.lexsort((at, key[segment], doc[segment], block))
        d, k, a, b = doc[segment][order], key[segment][order], at[order], block[order]
        late = np.zeros(len(order), bool)
        late[1:] = b[1:] == b[:-1]
        d, k, a = d[late], k[late], a[late]
        order = np.lexsort((a, k, d))
        d, k, a = d[order], k[order], a[order]
        edge = np.ones(len(a) + 1, bool)
        edge[1:-1] = (d[1:] != d[:-1]) | (k[1:] != k[:-1]) | (a[1:] > a[:-1] + 1)
        opens, closes = np.flatnonzero(edge[:-1]), np.flatnonzero(edge[1:])
        return pd.DataFrame({"doc": d[opens], "text_key": k[opens], "start": a[opens], "size": a[closes] - a[opens] + WINDOW})

    def stream(batches):
        rest, size = None, 0
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            while True:
                # Whole groups of at least _MERGE_BYTES, or one larger group.
                total = rest["bytes"].map(len).cumsum().to_numpy()
                gram = rest["gram"].to_numpy()
                if not len(gram) or total[-1] < 2 * _MERGE_BYTES:
                    break
                cut = int(np.searchsorted(gram, gram[np.searchsorted(total, _MERGE_BYTES)], side="right"))
                if cut >= len(gram):
                    cut = int(np.searchsorted(gram, gram[-1]))
                if not cut:
                    break
                yield merge(rest.iloc[:cut])
                rest = rest.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield merge(rest)

    return dealt.mapInPandas(stream, "doc long, text_key long, start long, size long")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """Byte spans that go: doc, text_key, start, size; they may touch and overlap."""
    found, _ = written(judge_runs(find_runs(texts, frequent_grams(texts))), "runs")
    spans = found.where(F.col("gram").isNull()).drop("gram")
    wanted = found.where(F.col("gram").isNotNull()).groupBy("doc", "text_key").agg(F.collect_list(F.struct("start", "size", "gram")).alias("_runs"))
    pieces = texts.join(wanted, ["doc", "text_key"]).select("doc", "text_key", F.encode("text", "UTF-8").alias("_bytes"), F.explode_outer("_runs").alias("_run"))
    segments = pieces.select(
        "doc", "text_key", "_run.start", "_run.gram",
        F.substr("_bytes", (F.col("_run.start") + 1).cast("int"), (F.col("_run.size") + WINDOW - 1).cast("int")).alias("bytes"),
    ).dropDuplicates(["doc", "text_key", "start"])
    merged, _ = written(merge_runs(segments), "merged")
    return spans.unionByName(merged)


def kept_bytes(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[bytes, int, int]:
    """What is left, bytes removed, and maximal removed runs."""
    if not len(starts):
        return data, 0, 0
    marks = np.zeros(len(data) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + sizes, -1)
    gone = np.cumsum(marks[:-1]) > 0
    n_runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), n_runs


def with_text_keys(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(whole).alias("text_key"), whole.alias("text"))


def remove_repeats(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """Per row of ``docs``: key, ``kept`` bytes, ``n_bytes``, ``n_removed``, ``n_spans``."""
    texts = with_text_keys(docs, key, text)
    spans = repeated_spans(texts).groupBy("doc", "text_key").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))
    joined = texts.join(spans, ["doc", "text_key"], "left").select("doc", "text", "starts", "sizes")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            for first in range(0, len(batch), 500):
                out = []
                for doc, value, starts, sizes in batch.iloc[first : first + 500].itertuples(index=False):
                    data = value.encode("utf-8", "replace")
                    some = starts is not None and len(starts)
                    kept, n_removed, n_spans = kept_bytes(data, np.asarray(starts, np.int64) if some else none, np.asarray(sizes, np.int64) if some else none)
                    out.append((None if doc == _NO_ID else doc, kept, len(data), n_removed, n_spans))
                frame = pd.DataFrame(out, columns=[key, "kept", "n_bytes", "n_removed", "n_spans"])
                yield frame.astype({key: "Int64"})

    return joined.mapInPandas(cut, f"{key} long, kept binary, n_bytes long, n_removed long, n_spans long")
