"""Micro-batch upsert of captures into a landing change log.

The log is a base, sorted by identifier, and a folder of changes for each micro-batch since. A batch
reads the base and these few folders only: after ``fold_after`` of them, the stream itself folds them into a
new base. What the present base holds is told by the last note in ``bases``, which is written once the
base is complete; a run that breaks off before leaves the older note in force.

Folders are named after the stream (by its checkpoint) and the micro-batch. A stream only ever replaces
its own, so that a second stream, or one that starts again with a new checkpoint, adds to what is
stored. A batch that runs again after its changes were folded finds them stored and changes nothing.
"""

import hashlib
import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.merge import landing_merge
from ..schemas import LANDING
from ..session import discard, list_folder, path_exists, read_text, write_text

_VERSIONED = [f.name for f in LANDING if f.name not in ("version", "identifier")]
_NOTES = "bases"


class _Log(NamedTuple):
    """Folders below the table: the base if there is one, what was folded into it, and the changes since."""

    number: int
    base: str | None
    folded: list[str]
    changes: list[str]


def _state(spark: SparkSession, table: str) -> _Log:
    number, base, folded = 0, None, []
    notes = list_folder(spark, f"{table}/{_NOTES}")
    if notes:
        number = int(max(notes).split("-")[0])
        told = json.loads(read_text(spark, f"{table}/{_NOTES}/{max(notes)}"))
        base, folded = told["base"], told["folded"]
    streams = [s for s in list_folder(spark, table) if s.startswith("stream=")]
    found = [f"{s}/{b}" for s in streams for b in list_folder(spark, f"{table}/{s}") if b.startswith("batch_id=")]
    return _Log(number, base, folded, sorted(set(found) - set(folded)))


def _rows(spark: SparkSession, table: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], LANDING)
    return spark.read.schema(LANDING).parquet(*[f"{table}/{f}" for f in folders])


def _read(spark: SparkSession, table: str, log: _Log) -> DataFrame:
    return _rows(spark, table, [log.base] * (log.base is not None) + log.changes)


def _log(spark: SparkSession, table: str) -> DataFrame:
    return _read(spark, table, _state(spark, table))


def _latest(log: DataFrame) -> DataFrame:
    newest = log.groupBy("identifier").agg(F.max(F.struct("version", *_VERSIONED)).alias("_row"))
    return newest.select("identifier", "_row.*").select(*LANDING.fieldNames())


def current_table(spark: SparkSession, table: str) -> DataFrame:
    """The landing table: the highest version of each identifier in the change log."""
    return _latest(_log(spark, table))


def stream_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _batch_folder(stream: str, batch_id: int) -> str:
    return f"stream={stream}/batch_id={batch_id:012d}"


def stored_before(batch: DataFrame, batch_id: int, table: str, stream: str) -> DataFrame:
    """What is stored of the batch's identifiers, without what this batch itself wrote earlier."""
    spark = batch.sparkSession
    log = _state(spark, table)
    own = _batch_folder(stream, batch_id)
    others = [f for f in log.changes if not (f.startswith(f"stream={stream}/") and f >= own)]
    return _latest(_read(spark, table, log._replace(changes=others)).join(batch.select("identifier").distinct(), "identifier", "left_semi"))


def upsert_batch(batch: DataFrame, batch_id: int, table: str, run_ts: str, stream: str = "batch", fold_after: int = 16) -> None:
    """Append the rows this batch inserts or updates.

    Only changes are written. Running a batch again replaces its own folder and nothing else.
    """
    spark = batch.sparkSession
    existing = stored_before(batch, batch_id, table, stream)
    merged = landing_merge(existing, batch, run_ts, how="right")
    changes = merged.where(F.col("action").isin("insert", "update")).drop("action")
    changes.write.mode("overwrite").parquet(f"{table}/{_batch_folder(stream, batch_id)}")
    log = _state(spark, table)
    if len(log.changes) >= fold_after:
        _fold(spark, table, log)


def _new_base(spark: SparkSession, rows: DataFrame, table: str, log: _Log) -> str:
    """Writes a base, and then the note that puts it in force."""
    name = f"{log.number + 1:06d}-{uuid.uuid4().hex}"
    # Rows of one identifier are few; ranges hold about as many identifiers each.
    rows.repartitionByRange("identifier").sortWithinPartitions("identifier").write.parquet(f"{table}/base-{name}")
    write_text(spark, f"{table}/{_NOTES}/{name}", json.dumps({"base": f"base-{name}", "folded": log.changes + log.folded}))
    return f"base-{name}"


def _fold(spark: SparkSession, table: str, log: _Log) -> None:
    """Writes a new base with all changes in it, then removes what the base before had folded.

    Changes folded just now stay until the next time, for readers that began with the older note.
    """
    base = _new_base(spark, _latest(_read(spark, table, log)), table, log)
    kept = [f for f in log.folded if path_exists(spark, f"{table}/{f}")]
    for folder in kept:
        discard(spark, f"{table}/{folder}")
    older = [f for f in list_folder(spark, table) if f.startswith("base-") and f not in (base, log.base)]
    for folder in older:
        discard(spark, f"{table}/{folder}")


def compact(spark: SparkSession, table: str, to: str | None = None) -> None:
    """Folds all changes into a new base, whatever their number; with ``to``, as the first base of a new log there."""
    log = _state(spark, table)
    if to is None:
        _fold(spark, table, log)
    else:
        _new_base(spark, _latest(_read(spark, table, log)), to, _Log(0, None, [], []))


def upsert_stream(spark, source: str, schema, table: str, checkpoint: str, run_ts: str, max_files=None, fold_after: int = 16):
    """Runs the upsert over the files that arrived since the last run, then stops."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = stream_name(checkpoint)
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(lambda batch, i: upsert_batch(batch, i, table, run_ts, stream, fold_after))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
