"""Keyed versioning and merging of metadata.

Batches are first reduced to one row per key with an aggregate that combines on the map
side, so a key that fills a third of a batch costs one row per task in the shuffle. Joins
then meet unique keys. Document bytes never travel through these operators.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import next_version, parse_doc_date
from ..schemas import CAPTURE_COLS, TRANSFORMED
from .filters import with_hash

TRANSFORMED_COLS = [f.name for f in TRANSFORMED if f.name not in ("identifier", "version")]


def _pick(df: DataFrame, keys: list[str], order: list[str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    # The other columns follow the order columns, so that ties have one winner as well.
    chosen = df.groupBy(*keys).agg(choose(F.struct(*order, *rest)).alias("_row"))
    return chosen.select(*keys, "_row.*").select(*df.columns)


def dedupe_latest(df: DataFrame, key="identifier", order=("scraped_at", "file_hash")) -> DataFrame:
    """Last write wins: the row with the greatest order columns per key."""
    return _pick(df, [key], list(order), F.max)


def dedupe_first(df: DataFrame, key="identifier", order=("scraped_at", "file_hash")) -> DataFrame:
    return _pick(df, [key], list(order), F.min)


def with_current(batch: DataFrame, existing: DataFrame, hash_col="file_hash", key="identifier", more=()) -> DataFrame:
    """Left join to the stored hash and version only (``known``, ``old_hash``, ``old_version``), and ``more`` as ``old_<name>``."""
    current = existing.select(
        key,
        F.lit(True).alias("known"),
        F.col(hash_col).alias("old_hash"),
        F.col("version").alias("old_version"),
        *[F.col(c).alias(f"old_{c}") for c in more],
    )
    return batch.join(current, key, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def _action(known: Column, old_hash: Column, new_hash: Column) -> Column:
    return (
        F.when(~known, "insert").when(old_hash.eqNullSafe(new_hash), "unchanged").otherwise("update")
    )


def _one_per_key(rows: DataFrame, key, hash_col) -> DataFrame:
    """The winner of each key by the order of ``dedupe_latest``, as far as the rows have it."""
    return dedupe_latest(rows, key, [c for c in ("scraped_at", hash_col) if c in rows.columns])


def change_status(batch: DataFrame, existing: DataFrame, hash_col="file_hash", key="identifier") -> DataFrame:
    """Adds ``action`` (insert / update / unchanged) and the version the row will have.

    One row per key: several captures of a key are one change, that of the latest.
    """
    joined = with_current(_one_per_key(batch, key, hash_col), existing, hash_col, key)
    action = _action(F.col("known"), F.col("old_hash"), F.col(hash_col))
    version = F.when(F.col("action") == "unchanged", F.col("old_version")).otherwise(
        next_version(F.col("known"), "old_version")
    )
    return (
        joined.withColumn("action", action)
        .withColumn("new_version", version.cast("int"))
        .drop("known")
    )


def changed_only(batch: DataFrame, existing: DataFrame, hash_col="file_hash", key="identifier") -> DataFrame:
    """The latest row of each key whose hash differs from the one last written, or that was never written."""
    stored = existing.select(key, F.col(hash_col).alias("_stored"), F.lit(True).alias("_seen"))
    joined = _one_per_key(batch, key, hash_col).join(stored, key, "left")
    unchanged = F.col("_seen").isNotNull() & F.col("_stored").eqNullSafe(F.col(hash_col))
    return joined.where(~unchanged).drop("_stored", "_seen")


def _merge(existing, batch, key, update_cols, action, computed, how="full") -> DataFrame:
    """Join both sides on the key and pick per column.

    ``update_cols`` are set (null included) on rows whose action writes; other columns keep
    the stored value. ``computed`` maps a column name to a function of (old, writes, action).
    """
    old = existing.select(F.col(key), F.struct(*existing.columns).alias("_old"))
    new = batch.select(F.col(key), F.struct(*batch.columns).alias("_new"))
    joined = old.join(new, key, how)
    joined = joined.withColumn("action", action(F.col("_old"), F.col("_new")))
    writes = F.col("action").isin("insert", "update", "copy")
    columns = []
    for field in existing.schema:
        name = field.name
        stored = F.col("_old")[name]
        if name == key:
            value = F.col(key)
        elif name in computed:
            value = computed[name](stored, writes, F.col("action"))
        elif name in update_cols and name in batch.columns:
            value = F.when(writes, F.col("_new")[name]).otherwise(stored)
        else:
            value = stored
        columns.append(value.cast(field.dataType).alias(name))
    return joined.select(*columns, "action")


def _hash_action(hash_col):
    def action(old, new):
        return F.when(new.isNull(), "kept").otherwise(
            _action(old.isNotNull(), old[hash_col], new[hash_col])
        )

    return action


def _version_of(stored, writes, action):
    return F.when(action == "insert", F.lit(1)).when(writes, F.coalesce(stored, F.lit(0)) + 1).otherwise(stored)


def landing_merge(existing: DataFrame, batch: DataFrame, run_ts: str, update_cols=None, how="full") -> DataFrame:
    """Landing upsert with an ``action`` column: insert, update, unchanged, kept.

    ``how="right"`` leaves out the stored rows that the batch does not touch.
    """
    batch = dedupe_latest(with_hash(batch).where(F.col("identifier").isNotNull()))
    computed = {
        "version": _version_of,
        "created_at": lambda old, w, a: F.when(a == "insert", F.lit(run_ts)).otherwise(old),
        "updated_at": lambda old, w, a: F.when(a == "update", F.lit(run_ts)).otherwise(old),
    }
    merged = _merge(
        existing, batch, "identifier", update_cols or CAPTURE_COLS, _hash_action("file_hash"), computed, how
    )
    return merged.withColumn("doc_date", parse_doc_date("date")) if "doc_date" in existing.columns else merged


def landing_upsert(existing: DataFrame, batch: DataFrame, run_ts: str, update_cols=None) -> DataFrame:
    """New key: version 1. Same hash: nothing. Other hash: version + 1. Returns the whole table."""
    return landing_merge(existing, batch, run_ts, update_cols).drop("action")


def transformed_merge(existing: DataFrame, rows: DataFrame, how="full") -> DataFrame:
    rows = _latest_transformed(rows)
    return _merge(
        existing, rows, "identifier", TRANSFORMED_COLS, _hash_action("new_hash"), {"version": _version_of}, how
    )


def transformed_upsert(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert of cleaned documents: same ``new_hash`` is skipped, else version + 1."""
    return transformed_merge(existing, rows).drop("action")


def copy_merge(existing: DataFrame, rows: DataFrame, how="full") -> DataFrame:
    def action(old, new):
        return F.when(new.isNull(), "kept").otherwise("copy")

    rows = _latest_transformed(rows)
    return _merge(existing, rows, "identifier", TRANSFORMED_COLS, action, {}, how)


def copy_upsert(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert of copied documents: always written, the version is left alone."""
    return copy_merge(existing, rows).drop("action")


def _latest_transformed(rows: DataFrame) -> DataFrame:
    return dedupe_latest(rows.where(F.col("identifier").isNotNull()), order=("transformed_at", "new_hash"))


def insert_new(existing: DataFrame, rows: DataFrame, key="identifier", order=("scraped_at", "file_hash")):
    """Insert-only with a unique key -> (inserted, rejected).

    The first row per key is inserted unless the key is stored already. Equal rejected
    rows come once, with their number in ``copies``.
    """
    first = dedupe_first(rows, key, order)
    inserted = first.join(existing.select(key), key, "left_anti")
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    winners = inserted.select(F.col(key), F.struct(*rows.columns).alias("_winner"))
    compared = counted.join(winners, key, "left")
    is_winner = F.coalesce(F.col("_winner").eqNullSafe(F.struct(*rows.columns)), F.lit(False))
    rejected = (
        compared.withColumn("copies", F.col("copies") - is_winner.cast("long"))
        .where(F.col("copies") > 0)
        .drop("_winner")
    )
    return inserted.select(*rows.columns), rejected.select(*rows.columns, "copies")


def update_existing(existing: DataFrame, rows: DataFrame, update_cols, key="identifier") -> DataFrame:
    """Set columns on stored keys only; unknown keys are ignored. ``changed`` tells the effect.

    Of several updates of a key the latest one counts (``scraped_at``, then the new values).
    """
    order = [c for c in ("scraped_at", *update_cols) if c in rows.columns]
    new = dedupe_latest(rows.select(*dict.fromkeys([key, *order])), key, order).select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in update_cols])
    joined = existing.join(new, key, "inner")
    changed = F.lit(False)
    for c in update_cols:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    values = [F.col(f"_new_{c}").alias(c) if c in update_cols else F.col(c) for c in existing.columns]
    return joined.select(*values, changed.alias("changed"))


def path_collisions(df: DataFrame, path="object_path", key="identifier") -> DataFrame:
    """Object paths that more than one identifier maps to."""
    pairs = df.groupBy(path, key).agg(F.count("*").alias("_n"))
    return (
        pairs.groupBy(path)
        .agg(
            F.count("*").alias("n_identifiers"),
            F.min(key).alias("first_identifier"),
            F.max(key).alias("last_identifier"),
            F.sum("_n").alias("n_rows"),
        )
        .where(F.col("n_identifiers") > 1)
    )
