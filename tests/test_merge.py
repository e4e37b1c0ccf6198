import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from folioflow.operators import history, merge, stats
from folioflow.plans import transform
from folioflow.schemas import LANDING, TRANSFORMED

NOW = "2026-01-01T00:00:00"


def capture(spark, rows):
    """(identifier, hash, scraped_at) captures; the title tells them apart."""
    return spark.createDataFrame(
        [(i, h, t, f"{h}@{t}") for i, h, t in rows], "identifier string, file_hash string, scraped_at string, title string"
    )


def stored(spark, rows):
    """(identifier, hash, version) landing rows."""
    base = dict.fromkeys(LANDING.fieldNames())
    return spark.createDataFrame(
        [tuple({**base, "identifier": i, "file_hash": h, "version": v, "created_at": "then", "description": "kept"}.values()) for i, h, v in rows],
        LANDING,
    )


def state(df, *columns):
    return {r["identifier"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_landing_upsert(spark):
    old = stored(spark, [("same", "a", 3), ("other", "a", 3), ("untouched", "a", 2), ("bare", "a", None)])
    new = capture(spark, [("same", "a", "t1"), ("other", "b", "t1"), ("new", "c", "t1"), ("bare", "b", "t1"), ("failed", None, "t1")])
    got = state(merge.landing_upsert(old, new, NOW), "version", "file_hash", "created_at", "updated_at", "title", "description")
    assert got == {
        "same": (3, "a", "then", None, None, "kept"),
        "other": (4, "b", "then", NOW, "b@t1", "kept"),
        "untouched": (2, "a", "then", None, None, "kept"),
        "new": (1, "c", NOW, None, "c@t1", None),
        "bare": (1, "b", "then", NOW, "b@t1", "kept"),
    }


def test_landing_upsert_sets_null_only_for_given_columns(spark):
    old = stored(spark, [("x", "a", 1)])
    new = capture(spark, [("x", "b", "t1")]).withColumn("description", F.lit(None).cast("string"))
    assert state(merge.landing_upsert(old, new, NOW), "description") == {"x": (None,)}
    assert state(merge.landing_upsert(old, new, NOW, update_cols=["file_hash"]), "description", "title") == {"x": ("kept", None)}


def test_landing_upsert_twice_changes_nothing(spark):
    empty = spark.createDataFrame([], LANDING)
    batch = capture(spark, [("a", "1", "t1"), ("a", "2", "t2"), ("b", "1", "t1")])
    once = merge.landing_upsert(empty, batch, NOW)
    again = merge.landing_upsert(once, batch, "later")
    assert sorted(once.collect()) == sorted(again.collect())
    assert state(once, "file_hash", "version") == {"a": ("2", 1), "b": ("1", 1)}


def test_batch_with_one_hot_identifier(spark):
    """Reduced on the map side: what reaches the shuffle is one row per task and key."""
    rows = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("identifier"),
        F.sha2(F.col("id").cast("string"), 256).alias("file_hash"),
        F.format_string("%08d", "id").alias("scraped_at"),
    )
    got = merge.dedupe_latest(rows)
    assert got.count() == 20001
    assert got.where("identifier = 'hot'").first()["scraped_at"] == "00029997"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def transformed(spark, rows):
    base = dict.fromkeys(TRANSFORMED.fieldNames())
    return spark.createDataFrame(
        [tuple({**base, "identifier": i, "new_hash": h, "version": v, "is_copy": c, "transformed_at": t}.values()) for i, h, v, c, t in rows],
        TRANSFORMED,
    )


def test_transformed_and_copy_upsert(spark):
    old = transformed(spark, [("same", "a", 2, False, "t0"), ("other", "a", 2, True, "t0"), ("left", "a", 5, None, "t0")])
    new = transformed(spark, [("same", "a", 3, False, "t1"), ("other", "b", 3, False, "t1"), ("new", "c", 1, False, "t1")])
    assert state(merge.transformed_upsert(old, new), "new_hash", "version", "is_copy", "transformed_at") == {
        "same": ("a", 2, False, "t0"), "other": ("b", 3, False, "t1"), "left": ("a", 5, None, "t0"), "new": ("c", 1, False, "t1"),
    }
    copies = transformed(spark, [("same", "a", None, True, "t1"), ("fresh", "z", None, True, "t1")])
    assert state(merge.copy_upsert(old, copies), "new_hash", "version", "is_copy", "transformed_at") == {
        "same": ("a", 2, True, "t1"), "other": ("a", 2, True, "t0"), "left": ("a", 5, None, "t0"), "fresh": ("z", None, True, "t1"),
    }
    mixed = new.unionByName(copies.where("identifier = 'fresh'")).withColumn("status", F.lit("transformed"))
    assert state(transform.apply_results(old, mixed), "version", "is_copy") == {
        "same": (2, False), "other": (3, False), "left": (5, None), "new": (1, False), "fresh": (None, True),
    }


def test_insert_new(spark):
    old = stored(spark, [("known", "a", 1)])
    rows = capture(spark, [("known", "b", "t1"), ("x", "1", "t2"), ("x", "0", "t1"), ("x", "0", "t1"), (None, "n", "t1")])
    inserted, rejected = merge.insert_new(old, rows)
    assert state(inserted, "file_hash", "scraped_at") == {"x": ("0", "t1"), None: ("n", "t1")}
    assert sorted((r["identifier"], r["file_hash"], r["copies"]) for r in rejected.where("identifier IS NOT NULL").collect()) == [
        ("known", "b", 1), ("x", "0", 1), ("x", "1", 1),
    ]


def test_update_existing(spark):
    old = stored(spark, [("x", "a", 1), ("y", "a", 1), ("z", "a", 1)])
    rows = capture(spark, [("x", "a", "t"), ("y", None, "t"), ("nobody", "q", "t")])
    assert state(merge.update_existing(old, rows, ["file_hash"]), "file_hash", "changed") == {"x": ("a", False), "y": (None, True)}


def test_changed_only(spark):
    old = stored(spark, [("x", "a", 1), ("y", None, 1), ("z", None, 1)])
    rows = capture(spark, [("x", "a", "t"), ("y", None, "t"), ("z", "b", "t"), ("new", None, "t")])
    assert set(state(merge.changed_only(rows, old), "file_hash")) == {"z", "new"}


def test_path_collisions(spark):
    df = spark.createDataFrame([("p", "a/1"), ("p", "a1"), ("p", "a1"), ("q", "b")], "object_path string, identifier string")
    assert [tuple(r) for r in merge.path_collisions(df).collect()] == [("p", 2, "a/1", "a1", 3)]


def versions(hashes):
    out, last = [], None
    for h in hashes:
        out.append(1 if last is None else out[-1] + (h != last))
        last = h
    return out


def test_version_history_golden(spark):
    df = spark.createDataFrame([("x", i, i, h) for i, h in enumerate("aaba")], "identifier string, seen_at long, event_id long, file_hash string")
    assert [r["version"] for r in history.version_history(df).orderBy("seen_at").collect()] == [1, 1, 2, 3]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 40), st.sampled_from("ab")), min_size=1, max_size=60), st.sampled_from([1, 5, 1000]))
def test_version_history_for_any_split(spark, rows, segment_rows):
    rows = [(i, t, n, h) for n, (i, t, h) in enumerate(rows)]
    df = spark.createDataFrame(rows, "identifier string, seen_at long, event_id long, file_hash string")
    got = {(r["identifier"], r["event_id"]): r["version"] for r in history.version_history(df, segment_rows=segment_rows).collect()}
    want = {}
    for key in "xyz":
        own = sorted((t, n, h) for i, t, n, h in rows if i == key)
        for (_, n, _), v in zip(own, versions([h for *_, h in own])):
            want[key, n] = v
    assert got == want


def test_history_equals_upsert_one_by_one(spark):
    """The last version is the one that upserting observation by observation gives."""
    hashes = "aabacc"
    df = spark.createDataFrame([("x", i, i, h) for i, h in enumerate(hashes)], "identifier string, seen_at long, event_id long, file_hash string")
    table = spark.createDataFrame([], LANDING)
    for i, h in enumerate(hashes):
        table = merge.landing_upsert(table, capture(spark, [("x", h, str(i))]), NOW)
        table = spark.createDataFrame(table.collect(), LANDING)
    assert table.first()["version"] == history.version_history(df).agg(F.max("version")).first()[0] == 4


def test_stats(spark):
    df = spark.createDataFrame([("transformed",), ("skipped",), ("skipped",), ("failed",)], "status string")
    assert tuple(stats.transform_stats(df).first()) == (4, 1, 2, 1)
    assert tuple(stats.transform_stats(df.limit(0)).first()) == (0, 0, 0, 0)
    assert tuple(stats.run_status(stats.transform_stats(df)).first()) == ("Failed", 1)
    assert tuple(stats.run_status(stats.transform_stats(df.limit(0))).first()) == ("Success", 0)


def test_duplicates(spark):
    df = spark.createDataFrame([("a", b"x"), ("b", b"x"), ("c", b""), ("d", None), ("a", b"y")], "identifier string, content binary")
    assert [(r["n_docs"], r["first_identifier"], r["total_length"]) for r in stats.duplicate_content(df).collect()] == [(2, "a", 2)]
    assert [tuple(r) for r in stats.duplicate_keys(df).collect()] == [("a", 2)]


@pytest.mark.parametrize("how", ["full", "right"])
def test_upsert_counts(spark, how):
    old = stored(spark, [("same", "a", 3), ("other", "a", 3), ("untouched", "a", 2)])
    new = capture(spark, [("same", "a", "t1"), ("other", "b", "t1"), ("new", "c", "t1")])
    assert tuple(stats.upsert_counts(merge.landing_merge(old, new, NOW, how=how)).first()) == (1, 1, 1, 2)


def test_repeated_keys_in_a_batch_count_once(spark):
    old = spark.createDataFrame([("x", "a", 1)], "identifier string, file_hash string, version int")
    batch = spark.createDataFrame(
        [("x", "b", "t1"), ("x", "c", "t2"), ("y", "d", "t1"), ("y", "d", "t1")], "identifier string, file_hash string, scraped_at string"
    )
    got = {(r["identifier"], r["file_hash"], r["action"], r["new_version"]) for r in merge.change_status(batch, old).collect()}
    assert got == {("x", "c", "update", 2), ("y", "d", "insert", 1)}
    assert merge.changed_only(batch, old).count() == 2 and merge.change_status(batch, old).count() == 2
    updated = merge.update_existing(old, batch, ["file_hash"]).collect()
    assert [(r["identifier"], r["file_hash"], r["changed"]) for r in updated] == [("x", "c", True)]


def test_a_key_with_all_rows_is_dealt_over_segments(spark):
    rows = spark.range(4000).select(F.lit("hot").alias("identifier"), F.when(F.col("id") > 9, F.col("id")).alias("seen_at"), F.col("id").alias("event_id"), F.when(F.col("id") % 7 < 5, (F.col("id") % 3).cast("string")).alias("file_hash"))
    got = history.version_history(rows, segment_rows=100)
    hashes = [str(i % 3) if i % 7 < 5 else "none" for i in range(4000)]
    assert sorted((r["event_id"], r["version"]) for r in got.collect()) == list(enumerate(versions(hashes)))
    bounds = history.time_bounds(rows, "seen_at", 100)
    assert len(bounds) == 39
    sizes = rows.groupBy(history._segment("seen_at", "bigint", bounds)).count().collect()
    assert len(sizes) == 40 and max(r["count"] for r in sizes) < 130
    null_key = history.version_history(rows.withColumn("identifier", F.lit(None).cast("string")), segment_rows=100)
    assert null_key.agg(F.max("version")).first() == got.agg(F.max("version")).first() and null_key.count() == 4000
