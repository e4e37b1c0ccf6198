"""Version history over a stream of observations."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

# Bounds of time are looked up in groups of this many.
_GROUP = 32


def version_history(
    obs: DataFrame,
    key="identifier",
    ts="seen_at",
    tie="event_id",
    hash_col="file_hash",
    segment_rows: int = 1_000_000,
) -> DataFrame:
    """Adds ``version``: it rises whenever the hash differs from the previous observation.

    A prefix scan in two steps. Time is cut at quantiles of all observations, so that a segment of time
    has about ``segment_rows`` of them, and no key, however frequent, has more in one segment than
    the segment holds. Changes are counted within each key and segment, dealt by both; one summary
    row for each then carries the count on to the next segment of its key. Rows of one instant stay
    together, ordered by ``tie``; null times come first.
    """
    bounds = time_bounds(obs, ts, segment_rows)
    local = _with_changes(obs.withColumn("_segment", _segment(ts, dict(obs.dtypes)[ts], bounds)), [key, "_segment"], ts, tie, hash_col)
    if not bounds:  # one segment has nothing to carry on
        return local.select(*obs.columns, (F.col("_inside") + 1).cast("int").alias("version"))
    offsets = _segment_offsets(local, key, ts, tie, hash_col).withColumnRenamed(key, "_of")
    met = local[key].eqNullSafe(offsets["_of"]) & (local["_segment"] == offsets["_segment"])
    version = F.lit(1) + F.col("_inside") + F.col("_before")
    return local.join(offsets, met).withColumn("version", version.cast("int")).select(*obs.columns, "version")


def time_bounds(obs: DataFrame, ts: str, segment_rows: int, most: int = 1024) -> list[str]:
    """The quantiles of time at which segments end, as text; fewer than ``most`` of them come to the driver."""
    quantiles = F.approx_percentile(ts, [i / most for i in range(1, most)], 10 * most)
    found = obs.agg(F.count(ts).alias("n"), F.transform(quantiles, lambda b: b.cast("string")).alias("bounds")).first()
    wanted = min(math.ceil(found["n"] / max(segment_rows, 1)), most)
    # Quantiles rise; frequent times come several times.
    return list(dict.fromkeys(found["bounds"][round(i * most / wanted) - 1] for i in range(1, wanted)))


def _segment(ts: str, kind: str, bounds: list[str]) -> Column:
    """A number that rises with the bounds below ``ts``: groups of bounds wholly below, then bounds within the next."""
    if not bounds:
        return F.lit(0)
    groups = [[F.lit(b).cast(kind) for b in bounds[i : i + _GROUP]] for i in range(0, len(bounds), _GROUP)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < F.col(ts)))

    group = below(F.array(*[g[-1] for g in groups]))
    inside = below(F.get(F.array(*[F.array(*g) for g in groups]), group))
    return (group * _GROUP + F.greatest(F.coalesce(inside, F.lit(0)), F.lit(0))).cast("int")


def _with_changes(obs: DataFrame, groups, ts, tie, hash_col) -> DataFrame:
    """Adds ``_changed`` (0/1 against the previous row of the group) and its running sum ``_inside``."""
    order = Window.partitionBy(*groups).orderBy(ts, tie)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    changed = (F.row_number().over(order) > 1) & ~F.col(hash_col).eqNullSafe(F.lag(hash_col).over(order))
    return obs.withColumn("_changed", changed.cast("long")).withColumn("_inside", F.sum("_changed").over(so_far))


def _segment_offsets(local: DataFrame, key, ts, tie, hash_col) -> DataFrame:
    """Changes before each segment of a key, including the one on its own boundary."""
    at = F.struct(ts, tie)
    ends = local.groupBy(key, "_segment").agg(
        F.min_by(F.struct(hash_col), at).alias("_first"),
        F.max_by(F.struct(hash_col), at).alias("_last"),
        F.sum("_changed").alias("_n_changed"),
    )
    order = Window.partitionBy(key).orderBy("_segment")
    previous = F.lag("_last").over(order)
    boundary = F.when(previous.isNotNull() & ~previous.eqNullSafe(F.col("_first")), 1).otherwise(0)
    earlier = F.coalesce(
        F.sum("_n_changed").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    crossed = ends.withColumn("_crossed", boundary).withColumn("_earlier", earlier)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return crossed.select(
        key, "_segment", (F.col("_earlier") + F.sum("_crossed").over(upto)).alias("_before")
    )


def history_summary(obs: DataFrame, key="identifier", ts="seen_at", tie="event_id", hash_col="file_hash", segment_rows=1_000_000) -> DataFrame:
    """One row per key: first and last hash and the number of changes between them."""
    at = F.struct(ts, tie)
    return (
        version_history(obs, key, ts, tie, hash_col, segment_rows)
        .groupBy(key)
        .agg(
            F.min_by(hash_col, at).alias("first_hash"),
            F.max_by(hash_col, at).alias("last_hash"),
            (F.max("version") - 1).cast("int").alias("changes"),
        )
    )
