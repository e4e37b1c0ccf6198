"""Versions kept as keyed state across micro-batches.

Each micro-batch is reduced to one row per identifier (first hash, last hash, changes in between) with
the segment-wise history operator, so a hot identifier is spread over many tasks. One join with what is
stored adds these rows to the versions, without a call per key.

What is stored is a folder of changes for each micro-batch and, after every ``fold_after`` of them, a base with the
last update of each identifier, so that a batch reads one base and a bounded number of folders. A batch
reads only what batches before it wrote and replaces its own folders: running it again changes nothing.
"""

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.history import history_summary
from ..session import list_folder

UPDATE = "identifier string, version int, file_hash string, seq long"
STATE = "version int, file_hash string, seq long"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in list_folder(spark, folder) if "=" in name)


def _folders(spark: SparkSession, root: str, before: float) -> list[str]:
    """A base and the changes since, of the batches before ``before``.

    The base of the last batch may not be complete yet; that of an earlier one is.
    """
    runs = [n for n in _numbers(spark, f"{root}/changes") if n < before]
    base = max((n for n in _numbers(spark, f"{root}/bases") if runs and n < runs[-1]), default=-1)
    return [f"{root}/bases/upto={base}"] * (base >= 0) + [f"{root}/changes/run={n}" for n in runs if n > base]


def _stored(spark: SparkSession, root: str, before: float = math.inf) -> DataFrame:
    """The last update of each identifier by the batches before ``before``."""
    folders = _folders(spark, root, before)
    if not folders:
        return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in UPDATE.split(", "))])
    updates = spark.read.schema(UPDATE).parquet(*folders)
    last = updates.groupBy("identifier").agg(F.max(F.struct("seq", "version", "file_hash")).alias("_u"))
    return last.select("identifier", "_u.version", "_u.file_hash", "_u.seq")


def update_batch(batch: DataFrame, batch_id: int, root: str, fold_after: int = 16) -> None:
    """Adds a batch's changes to the stored versions; one more where its first hash is new."""
    spark = batch.sparkSession
    rows = history_summary(batch)
    known = _stored(spark, root, batch_id).select(F.col("identifier").alias("_of"), F.col("version").alias("_version"), F.col("file_hash").alias("_hash"))
    new = F.col("_version").isNull() | ~F.col("first_hash").eqNullSafe(F.col("_hash"))
    version = F.coalesce("_version", F.lit(0)) + F.col("changes") + F.when(new, 1).otherwise(0)
    updates = rows.join(known, rows["identifier"].eqNullSafe(known["_of"]), "left").select(
        "identifier", version.cast("int").alias("version"), F.col("last_hash").alias("file_hash"), F.lit(batch_id).cast("long").alias("seq")
    )
    updates.write.mode("overwrite").parquet(f"{root}/changes/run={batch_id}")
    if (batch_id + 1) % fold_after == 0:
        _stored(spark, root, batch_id + 1).write.mode("overwrite").parquet(f"{root}/bases/upto={batch_id}")


def fold_versions(key, frames, state):
    """The same for one key, as a function for ``applyInPandasWithState`` over summaries with ``seq``."""
    version, file_hash, seq = state.get if state.exists else (0, None, -1)
    rows = pd.concat(frames).sort_values("seq")
    # A batch that was run twice comes with a sequence number already counted.
    for row in rows[rows["seq"] > seq].itertuples():
        if row.seq == seq:
            continue
        version += int(row.changes) + (1 if version == 0 or row.first_hash != file_hash else 0)
        file_hash, seq = row.last_hash, int(row.seq)
    state.update((version, file_hash, seq))
    yield pd.DataFrame(
        {"identifier": [key[0]], "version": [version], "file_hash": [file_hash], "seq": [seq]}
    )


def versions_stream(spark: SparkSession, source: str, schema, root: str, fold_after: int = 16) -> None:
    """Runs over the files that arrived in ``source`` since the last run, then stops.

    ``source`` has identifier, seen_at, event_id and file_hash.
    """
    query = (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(lambda batch, i: update_batch(batch, i, root, fold_after))
        .option("checkpointLocation", f"{root}/checkpoint-changes")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_versions(spark: SparkSession, root: str) -> DataFrame:
    """The last update of each identifier."""
    return _stored(spark, root).drop("seq")
