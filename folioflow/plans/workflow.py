"""The two-phase job: landing, then transform if landing succeeded."""

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.stats import observed, run_status, transform_counts, upsert_columns, upsert_counts
from ..schemas import LANDING, TRANSFORMED
from ..session import discard, scratch_path
from ..sources.blobs import LAYOUT, read_blobs, write_partitioned
from ..sources.tables import read_landing
from .landing import land, landing_run
from .transform import apply_results, results_of, select_documents

log = logging.getLogger(__name__)


class Paths(NamedTuple):
    """Tables of one run. ``*_in`` is the last written state or None, ``*_out`` a new path:
    a table is never overwritten while it is read."""

    store: str
    landing_in: str | None
    landing_out: str
    results: str
    transformed_in: str | None
    transformed_out: str
    #: Directory layout of the store and the results.
    layout: tuple = LAYOUT
    #: Tables that every run adds to, left out if not named: items that did not land, statistics by phase.
    rejects: str | None = None
    stats: str | None = None
    #: A landing table kept in place by month, instead of ``landing_in`` and ``landing_out``. The store then
    #: has a directory per run, and bytes that it holds already are not stored again.
    landing: str | None = None


class RunFailed(RuntimeError):
    """A phase failed; ``summary`` is the row that tells which."""

    def __init__(self, summary):
        super().__init__(f"{summary['phase']} phase failed")
        self.summary = summary


def _table(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)


def _kept(stats: DataFrame, paths: Paths, phase: str, run_ts: str) -> DataFrame:
    """The statistics of a phase, added to those of earlier runs if a table for them is named."""
    if paths.stats:
        stats.withColumn("run_ts", F.lit(run_ts)).write.mode("append").parquet(f"{paths.stats}/{phase}")
    return stats


def run_landing(spark: SparkSession, items: DataFrame, paths: Paths, run_ts: str) -> DataFrame:
    """Runs the landing phase and returns its upsert counts."""
    if paths.landing:
        actions, rejects = land(items, paths.landing, paths.store, run_ts, paths.layout)
        counts = upsert_counts(actions)
    else:
        existing = _table(spark, paths.landing_in, LANDING)
        merged, rejects = landing_run(items, existing, paths.store, run_ts, paths.layout)
        seen = Observation()
        merged.observe(seen, *upsert_columns()).write.parquet(paths.landing_out)
        counts = observed(spark, seen, ["upserted", "modified", "unchanged", "total_ops"])
    if paths.rejects:
        rejects.withColumn("run_ts", F.lit(run_ts)).write.mode("append").parquet(paths.rejects)
    return _kept(counts, paths, "landing", run_ts)


def run_transform(spark: SparkSession, paths: Paths, start, end, run_ts: str) -> DataFrame:
    """Runs the transform phase and returns its statistics.

    The selection is written first, without bytes, so that it is made once and names the months to read.
    Results are written once with their bytes and counted as they are written; the table reads
    narrow columns back.
    """
    landing = read_landing(spark, paths.landing or paths.landing_out)
    existing = _table(spark, paths.transformed_in, TRANSFORMED)
    chosen = select_documents(landing, existing, start, end)
    folder = scratch_path(spark, "selected")
    chosen.write.parquet(folder)
    chosen = spark.read.schema(chosen.schema).parquet(folder)
    results = results_of(chosen, read_blobs(spark, paths.store), run_ts)
    seen = Observation()
    named = results.withColumn("body", F.coalesce("body", F.lit("unknown")))
    write_partitioned(named, paths.results, paths.layout, seen=seen, counts=transform_counts())
    written = spark.read.schema(results.schema).parquet(paths.results)
    apply_results(existing, written).write.parquet(paths.transformed_out)
    discard(spark, folder)
    return _kept(observed(spark, seen, ["total", "transformed", "skipped", "failed"]), paths, "transform", run_ts)


def run_workflow(spark, items, paths: Paths, start, end, run_ts: str, skip_transform=False, raise_on_failure=True) -> DataFrame:
    """One-row summary: status, failed, start_date, end_date, phase.

    A failed phase raises ``RunFailed`` with the summary, or shows in the status only if
    ``raise_on_failure`` is false; tables written before it stay.
    """
    phase, failed, cause = "landing", 0, None
    try:
        run_landing(spark, items, paths, run_ts).count()
        if not skip_transform:
            phase = "transform"
            run_transform(spark, paths, start, end, run_ts).count()
        phase = "done"
    except Exception as error:
        log.exception("%s phase failed", phase)
        failed, cause = 1, error
    outcome = spark.range(1).select(F.lit(failed).alias("failed"))
    summary = run_status(outcome).select(
        "*", F.lit(start).alias("start_date"), F.lit(end).alias("end_date"), F.lit(phase).alias("phase")
    )
    if cause is not None and raise_on_failure:
        raise RunFailed(summary.first()) from cause
    return summary
