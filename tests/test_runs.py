import datetime as dt
import hashlib

import pytest
from pyspark.sql import Observation, functions as F

from folioflow import session, sources as src
from folioflow.operators import stats
from folioflow.operators.filters import filter_by_date
from folioflow.plans.landing import land, landing_run, with_item_content
from folioflow.plans.transform import apply_results, results_of, select_documents, transform_results
from folioflow.plans.workflow import Paths, RunFailed, run_landing, run_transform, run_workflow
from folioflow.schemas import BLOBS, ITEM, LANDING, TRANSFORMED
from folioflow.sources.tables import merge_months, read_landing, with_doc_date, write_landing
from folioflow.streaming import upsert, versions

NOW = "2026-01-01T00:00:00"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def parts(spark, start, end, **kw):
    df = src.date_partitions(src.date_range(spark, start, end), **kw)
    return [(str(r["p_start"]), str(r["p_end"]), r["partition"]) for r in df.orderBy("p_start").collect()]


def test_date_partitions(spark):
    assert parts(spark, "2025-01-20", "2025-05-10", months=2) == [
        ("2025-01-01", "2025-02-28", "2025-01"), ("2025-03-01", "2025-04-30", "2025-03"), ("2025-05-01", "2025-05-10", "2025-05"),
    ]
    assert parts(spark, "2025-06-01", "2025-01-01") == []
    assert parts(spark, "x", "2025-01-01", now="2024-06-15") == [("2024-05-01", "2024-05-31", "2024-05"), ("2024-06-01", "2024-06-15", "2024-06")]
    assert parts(spark, None, None, months=0, now="2024-06-30")[0][0] == "2024-05-01"
    with pytest.raises(ValueError):
        src.date_partitions(src.date_range(spark, "2025-01-01", "2025-02-01"), months=-1)


@pytest.mark.parametrize("months", [1, 3, 7])
def test_partitions_tile_the_range(spark, months):
    got = parts(spark, "2019-11-30", "2024-02-29", months=months)
    assert got[0][0] == "2019-11-01" and got[-1][1] == "2024-02-29"
    for (_, end, _), (start, _, _) in zip(got, got[1:]):
        assert dt.date.fromisoformat(end) + dt.timedelta(days=1) == dt.date.fromisoformat(start)


def test_search_requests(spark):
    df = src.date_partitions(src.date_range(spark, "2025-01-01", "2025-01-31"))
    row = src.search_requests(df, src.body_ids("all"), "https://s.org/en/search/").first()
    assert row["url"] == (
        "https://s.org/en/search/?decisions=1&from=01%2F01%2F2025&to=31%2F01%2F2025&body=1&body=2&body=3&body=15376"
    )
    assert row["body_id"] == "1,2,3,15376"


def test_body_ids():
    assert src.body_ids([{"id": 3}, {"id": None}, {"name": "x"}, {"id": "1"}]) == ["3", "1"]
    assert src.body_ids("ALL") == src.body_ids() == ["1", "2", "3", "15376"]
    assert src.body_ids("1, 2") == ["1", "2"]


def test_event_log_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("t", "e", 1, None)], "timestamp string, event string, n int, url string")
    src.write_event_log(df, str(tmp_path / "log"))
    line = spark.read.text(str(tmp_path / "log")).first()[0]
    assert line == '{"timestamp":"t","event":"e","n":1,"url":null}'
    assert src.read_event_log(spark, str(tmp_path / "log"), "event string, n int").first() == ("e", 1)


def test_event_log_by_day_with_broken_lines(spark, tmp_path):
    log, schema = str(tmp_path / "log"), "timestamp string, event string, n int"
    rows = [("2024-03-01T10:00:00", "a", 1), ("2024-03-01T11:00:00", None, None), ("2024-03-02T10:00:00", "b", 2), ("not a day", "c", 3), (None, "d", 4)]
    src.write_event_log(spark.createDataFrame(rows, schema), log)
    broken = ['{"timestamp":"2024-03-02T1', '{"timestamp":"x","event":"e","n":"many"}', "", "  ", "[1]"]
    spark.createDataFrame([(line, "2024-03-02") for line in broken], "value string, day string").write.mode("append").partitionBy("day").text(log)
    assert {p.name for p in (tmp_path / "log").glob("day=*")} == {"day=2024-03-01", "day=2024-03-02", "day=unknown"}
    events = src.read_event_log(spark, log, schema)
    assert events.columns == ["timestamp", "event", "n"] and sorted(map(tuple, events.collect()), key=str) == sorted(rows, key=str)
    assert events.count() == 5
    assert sorted(tuple(r) for r in src.broken_lines(spark, log, schema).collect()) == sorted(("2024-03-02", line) for line in broken if line.strip())
    one = src.read_event_log(spark, log, schema, days=("2024-03-01", "2024-03-01"))
    assert "day" in plan_of(one).split("PartitionFilters: [", 1)[1].split("]", 1)[0] and one.count() == 2
    assert src.broken_lines(spark, log, schema, days=("2024-03-01", "2024-03-01")).count() == 0


def test_binary_files(spark, tmp_path):
    (tmp_path / "b" / "2024-01").mkdir(parents=True)
    (tmp_path / "b" / "2024-01" / "x.pdf").write_bytes(b"%PDF")
    row = src.read_binary_files(spark, str(tmp_path)).first()
    assert (row["object_path"], bytes(row["content"]), row["content_type"], row["length"]) == ("b/2024-01/x.pdf", b"%PDF", "application/pdf", 4)


def test_rows_without_path_keep_their_place(spark):
    meta = spark.createDataFrame([("a", "p"), ("b", None), (None, None)], "identifier string, file_path string")
    blobs = spark.createDataFrame([("p", b"x", None, 1)], BLOBS)
    assert {(r["identifier"], r["content"] and bytes(r["content"])) for r in src.attach_content(meta, blobs).collect()} == {
        ("a", b"x"), ("b", None), (None, None),
    }


def items(spark, rows):
    """(identifier, content, scraped_at) captured items."""
    base = dict.fromkeys(f for f in ITEM.fieldNames() if f not in ("file_hash", "file_path"))
    made = [
        {**base, "identifier": i, "title": i, "body": "Labour Court", "partition_date": "2024-03", "date": "2024-03-05",
         "document_type": "html", "scraped_at": t, "document_content": None if c is None else c.encode()}
        for i, c, t in rows
    ]
    schema = [f for f in ITEM if f.name in base]
    from pyspark.sql.types import StructType

    return spark.createDataFrame([tuple(m.values()) for m in made], StructType(schema))


def page(text):
    return f"<html><body><nav>n</nav><p>{text}</p></body></html>"


def test_landing_run(spark, tmp_path):
    store = str(tmp_path / "store")
    first = items(spark, [("a", "one", "t1"), ("a", "two", "t2"), ("b/1", "x", "t1"), ("none", None, "t1"), ("empty", "", "t1"), (None, "y", "t1")])
    merged, rejects = landing_run(first, spark.createDataFrame([], LANDING), store, "run-1")
    got = {r["identifier"]: (r["file_hash"], r["version"], r["file_path"], r["action"]) for r in merged.collect()}
    assert got == {
        "a": (sha("two"), 1, "Labour_Court/2024-03/a.html", "insert"),
        "b/1": (sha("x"), 1, "Labour_Court/2024-03/b1.html", "insert"),
    }
    assert sorted((r["identifier"] or "", r["stage"]) for r in rejects.collect()) == [("", "store"), ("empty", "hash"), ("none", "hash")]
    landed = spark.createDataFrame(merged.drop("action").collect(), LANDING)
    # The same items again, then a new capture of one of them next to what is stored.
    again, _ = landing_run(first, landed, store, "run-2")
    assert {r["action"] for r in again.collect()} == {"unchanged"}
    later, _ = landing_run(items(spark, [("a", "three", "t3")]), landed, store, "run-3")
    assert {r["identifier"]: (r["version"], r["action"]) for r in later.collect()} == {"a": (2, "update"), "b/1": (1, "kept")}
    latest = {r["object_path"]: bytes(r["content"]) for r in src.latest_blobs(src.read_blobs(spark, store)).collect()}
    assert latest == {"Labour_Court/2024-03/a.html": b"three", "Labour_Court/2024-03/b1.html": b"x"}
    assert src.latest_blobs(src.read_blobs(spark, store)).count() == 2


def test_failed_attachment_becomes_html_without_content(spark):
    df = spark.createDataFrame([("a", "u1", "pdf"), ("b", "u2", "pdf")], "identifier string, link_to_doc string, document_type string")
    fetched = spark.createDataFrame([("u1", b"x")], "url string, content binary")
    got = {r["identifier"]: (r["document_type"], r["document_content"] is None) for r in with_item_content(df, fetched).collect()}
    assert got == {"a": ("pdf", False), "b": ("html", True)}


def landing_rows(spark, rows):
    """(identifier, date, type, path) landing rows."""
    base = dict.fromkeys(LANDING.fieldNames())
    rows = [tuple({**base, "identifier": i, "date": d, "document_type": k, "file_path": p, "body": "court"}.values()) for i, d, k, p in rows]
    return with_doc_date(spark.createDataFrame(rows, LANDING))


def blob_rows(spark, contents):
    return spark.createDataFrame([(p, c, None, None) for p, c in contents.items()], BLOBS)


def test_transform_one_document(spark):
    """An html document without a type or a month."""
    landing = landing_rows(spark, [("ADJ-1", "2000-01-15", None, "path/1.html")])
    blobs = blob_rows(spark, {"path/1.html": b"<html><body>Test</body></html>"})
    existing = spark.createDataFrame([], TRANSFORMED)
    results = transform_results(landing, blobs, existing, "2000-01-01", "2000-01-31", NOW)
    row = results.first()
    assert (row["status"], row["version"], row["is_copy"], row["transformed_file_path"]) == ("transformed", 1, False, "court/unknown/ADJ-1.html")
    assert bytes(row["content"]) == b"<body>Test</body>" and row["new_hash"] == sha("<body>Test</body>")
    assert (row["document_type"], row["partition_date"], row["content_type"]) == ("html", "unknown", "text/html")
    assert transform_results(landing, blobs, existing, "2001-01-01", "2001-01-31", NOW).count() == 0


def test_transform_outcomes(spark):
    day = "2024-01-01"
    landing = landing_rows(spark, [
        ("new", day, "html", "new"), ("pdf", day, "pdf", "pdf"), ("PDF", day, "HTML", "upper"), ("missing", day, "htm", "gone"),
        ("empty", day, "pdf", "empty"), (None, day, "html", "new"), ("nopath", day, "html", None),
    ])
    blobs = blob_rows(spark, {"new": b"<body>a</body>", "pdf": b"%", "upper": b"<body>b</body>", "empty": b""})
    existing = spark.createDataFrame([], TRANSFORMED)
    results = transform_results(landing, blobs, existing, day, day, NOW)
    got = {r["identifier"]: (r["status"], r["is_copy"], r["version"]) for r in results.collect()}
    assert got["new"] == ("transformed", False, 1)
    assert got["pdf"] == ("transformed", True, None)
    assert got["PDF"] == ("transformed", True, None)  # the type test is case-sensitive
    assert got["missing"][0] == got["empty"][0] == got["nopath"][0] == "skipped"
    assert got[None][0] == "failed"
    table = spark.createDataFrame(apply_results(existing, results).collect(), TRANSFORMED)
    assert {r["identifier"] for r in table.collect()} == {"new", "pdf", "PDF"}
    # A second run skips what is unchanged, writes copies again and changes no version.
    second = transform_results(landing, blobs, table, day, day, "later")
    assert {r["identifier"]: r["status"] for r in second.collect()} == {
        **{i: "skipped" for i in ("new", "missing", "empty", "nopath")}, "pdf": "transformed", "PDF": "transformed", None: "failed",
    }
    after = {r["identifier"]: (r["version"], r["transformed_at"]) for r in apply_results(table, second).collect()}
    assert after == {"new": (1, NOW), "pdf": (None, "later"), "PDF": (None, "later")}


def test_workflow(spark, tmp_path):
    def at(name):
        return str(tmp_path / name)

    one = Paths(at("store"), None, at("l1"), at("r1"), None, at("t1"))
    captured = items(spark, [("a", page("one"), "t1"), ("b", page("two"), "t1")])
    assert tuple(run_workflow(spark, captured, one, "2024-01-01", "2024-12-31", NOW).first()) == ("Success", 0, "2024-01-01", "2024-12-31", "done")
    two = Paths(at("store"), at("l1"), at("l2"), at("r2"), at("t1"), at("t2"))
    changed = items(spark, [("a", page("new"), "t2"), ("b", page("two"), "t2")])
    assert tuple(run_landing(spark, changed, two, "run-2").first()) == (0, 1, 1, 1)
    assert tuple(run_transform(spark, two, "2024-01-01", "2024-12-31", "run-2").first()) == (2, 1, 1, 0)
    got = {r["identifier"]: (r["version"], r["new_hash"]) for r in spark.read.parquet(at("t2")).collect()}
    assert got == {"a": (2, sha("<body><p>new</p></body>")), "b": (1, sha("<body><p>two</p></body>"))}
    # Output that exists already fails the landing phase, and the transform is not tried.
    failed = run_workflow(spark, changed, two, "2024-01-01", "2024-12-31", "run-3", raise_on_failure=False).first()
    assert (failed["status"], failed["failed"], failed["phase"]) == ("Failed", 1, "landing")
    # A failed transform shows in the status.
    three = Paths(at("store"), at("l2"), at("l3"), at("r3"), at("t2"), at("t2"))
    failed = run_workflow(spark, changed, three, "2024-01-01", "2024-12-31", "run-4", raise_on_failure=False).first()
    assert (failed["status"], failed["phase"]) == ("Failed", "transform")
    with pytest.raises(RunFailed) as raised:
        run_workflow(spark, changed, two, "2024-01-01", "2024-12-31", "run-5")
    assert raised.value.summary["phase"] == "landing"


def test_workflow_keeps_rejects_and_statistics(spark, tmp_path):
    def at(name):
        return str(tmp_path / name)

    paths = Paths(at("store"), None, at("l1"), at("r1"), None, at("t1"), rejects=at("rejects"), stats=at("stats"))
    run_workflow(spark, items(spark, [("a", page("one"), "t1"), ("b", None, "t1")]), paths, "2024-01-01", "2024-12-31", NOW)
    assert [(r["identifier"], r["stage"], r["run_ts"]) for r in spark.read.parquet(at("rejects")).collect()] == [("b", "hash", NOW)]
    assert spark.read.parquet(at("stats/landing")).first()["upserted"] == 1
    assert spark.read.parquet(at("stats/transform")).first()["transformed"] == 1


def captures(spark, rows):
    return items(spark, [(i, None, t) for i, _, t in rows]).drop("document_content").join(
        spark.createDataFrame([(i, h, t) for i, h, t in rows], "identifier string, file_hash string, scraped_at string"), ["identifier", "scraped_at"]
    )


def test_stream_upsert(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("source", "table", "checkpoint"))
    waves = [[("a", "1", "t1"), ("b", "1", "t1")], [("a", "2", "t2"), ("a", "3", "t3"), ("b", "1", "t2"), ("c", "9", "t2")]]
    for wave in waves:
        rows = captures(spark, wave)
        rows.write.mode("append").parquet(source)
        upsert.upsert_stream(spark, source, rows.schema, table, checkpoint, NOW)
    want = {"a": ("3", 2), "b": ("1", 1), "c": ("9", 1)}

    def now():
        return {r["identifier"]: (r["file_hash"], r["version"]) for r in upsert.current_table(spark, table).collect()}

    assert now() == want
    # Nothing new: the run ends without a change. The last batch again: same folder, same rows.
    upsert.upsert_stream(spark, source, rows.schema, table, checkpoint, NOW)
    upsert.upsert_batch(captures(spark, waves[1]), 1, table, NOW, upsert.stream_name(checkpoint))
    assert now() == want


def test_stream_upsert_with_another_checkpoint_keeps_what_is_stored(spark, tmp_path):
    table = str(tmp_path / "table")
    first, second = captures(spark, [("a", "1", "t1"), ("b", "1", "t1")]), captures(spark, [("c", "5", "t1"), ("b", "2", "t2")])
    for name, rows in (("one", first), ("two", second)):
        rows.write.parquet(str(tmp_path / name))
        for _ in range(2):
            upsert.upsert_stream(spark, str(tmp_path / name), rows.schema, table, str(tmp_path / f"check-{name}"), NOW)
    want = {"a": ("1", 1), "b": ("2", 2), "c": ("5", 1)}

    def now(path):
        return {r["identifier"]: (r["file_hash"], r["version"]) for r in upsert.current_table(spark, path).collect()}

    assert now(table) == want
    # The same files once more from the start: nothing changes and nothing is written.
    upsert.upsert_stream(spark, str(tmp_path / "two"), second.schema, table, str(tmp_path / "check-three"), NOW)
    assert now(table) == want and upsert._log(spark, table).count() == 4
    upsert.compact(spark, table, str(tmp_path / "compacted"))
    assert now(str(tmp_path / "compacted")) == want
    upsert.upsert_batch(captures(spark, [("b", "3", "t3")]), 0, str(tmp_path / "compacted"), NOW)
    assert now(str(tmp_path / "compacted")) == {**want, "b": ("3", 3)}


def test_a_stream_reads_one_base_and_few_changes(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("source", "table", "checkpoint"))
    n, want = 50, {}
    for i in range(n):
        wave = [("hot", str(i // 2), f"t{i:02d}"), (f"x{i}", "1", "t")]
        captures(spark, wave).coalesce(1).write.mode("append").parquet(source)
        want |= {"hot": (str(i // 2), i // 2 + 1), f"x{i}": ("1", 1)}
    most, seen = 4, []
    fold = upsert._fold

    def counted(session, path, log):
        seen.append(len(log.changes))
        fold(session, path, log)

    upsert._fold = counted
    try:
        for i, path in enumerate(sorted((tmp_path / "source").glob("*.parquet"), key=lambda p: spark.read.parquet(str(p)).agg(F.max("scraped_at")).first()[0])):
            rows = spark.read.parquet(str(path))
            upsert.upsert_batch(rows, i, table, NOW, "s", most)
            if i == 21:  # a batch whose changes were folded already comes again
                upsert.upsert_batch(rows, i - 2, table, NOW, "s", most)
    finally:
        upsert._fold = fold
    assert {r["identifier"]: (r["file_hash"], r["version"]) for r in upsert.current_table(spark, table).collect()} == want
    assert seen and set(seen) == {most}
    log = upsert._state(spark, table)
    assert len(log.changes) < most and log.base is not None and len(list((tmp_path / "table").glob("base-*"))) <= 2
    assert len(list((tmp_path / "table").glob("stream=*/batch_id=*"))) <= 3 * most
    files = upsert.stored_before(rows, n, table, "s").inputFiles()
    folders = {f.split("/table/", 1)[1].rsplit("/", 1)[0] for f in files if "/table/" in f}
    assert len([f for f in folders if f.startswith("base-")]) == 1 and len(folders) <= 1 + most
    base = spark.read.parquet(f"{table}/{log.base}")
    assert [r["identifier"] for r in base.collect()] == sorted(r["identifier"] for r in base.collect())
    assert not any(name.startswith("_") for name in session.list_folder(spark, f"{table}/bases"))


def test_stream_versions(spark, tmp_path):
    root, schema = str(tmp_path), "identifier string, seen_at timestamp_ntz, event_id long, file_hash string"
    at = dt.datetime(2024, 1, 1)
    waves = [["a", "a"], ["b", "a", "a"], ["a"], ["c", "a"]]
    n = 0
    for wave in waves:
        rows = []
        for h in wave:
            rows += [("x", at + dt.timedelta(hours=n), n, h), (f"only-{n}", at, n, h)]
            n += 1
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/source")
        versions.versions_stream(spark, f"{root}/source", schema, root)
    got = {r["identifier"]: (r["version"], r["file_hash"]) for r in versions.latest_versions(spark, root).collect()}
    assert got["x"] == (5, "a") and len(got) == n + 1
    assert {v for k, v in got.items() if k != "x"} <= {(1, "a"), (1, "b"), (1, "c")}


def test_versions_are_joined_with_a_bounded_number_of_folders(spark, tmp_path):
    """Many small batches against a plain count; each runs twice, with null identifiers and hashes among them."""
    import random

    rng, root, want, n = random.Random(3), str(tmp_path), {}, 0
    schema = "identifier string, seen_at timestamp_ntz, event_id long, file_hash string"
    for i in range(7):
        rows = []
        for _ in range(12):
            key, h = rng.choice(["x", "y", None, f"only-{n}"]), rng.choice(["a", "b", None])
            rows.append((key, dt.datetime(2024, 1, 1) + dt.timedelta(hours=n), n, h))
            version, last = want.get(key, (0, None))
            want[key] = (version + (version == 0 or h != last), h)
            n += 1
        batch = spark.createDataFrame(rows, schema)
        for _ in range(2):
            versions.update_batch(batch, i, root, fold_after=3)
        assert len(versions._folders(spark, root, i + 1)) <= 4
    assert {r["identifier"]: (r["version"], r["file_hash"]) for r in versions.latest_versions(spark, root).collect()} == want
    assert "Pandas" not in plan_of(versions.latest_versions(spark, root)) and (tmp_path / "bases").is_dir()


def test_fold_ignores_a_batch_counted_before():
    import pandas as pd

    class State:
        exists, get = True, (3, "a", 7)

        def update(self, value):
            self.now = value

    state = State()
    rows = pd.DataFrame({"identifier": "x", "first_hash": ["b", "z", "b"], "last_hash": ["a", "z", "a"], "changes": [1, 5, 1], "seq": [8, 7, 8]})
    out = next(versions.fold_versions(("x",), iter([rows]), state))
    assert state.now == (5, "a", 8) and out.iloc[0].to_dict() == {"identifier": "x", "version": 5, "file_hash": "a", "seq": 8}


def test_transform_reads_only_the_months_it_selects(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [("a", "2024-03-05", "2024-03"), ("b", "2023-01-05", "2023-01"), ("c", "2022-01-05", "2022-01")]
    captured = items(spark, [(i, page(i), "t1") for i, *_ in rows]).drop("date", "partition_date")
    captured = captured.join(spark.createDataFrame(rows, "identifier string, date string, partition_date string"), "identifier")
    merged, _ = landing_run(captured, spark.createDataFrame([], LANDING), store, NOW)
    merged.drop("action").write.parquet(str(tmp_path / "landing"))
    landing = spark.read.parquet(str(tmp_path / "landing"))
    existing = spark.createDataFrame([], TRANSFORMED)
    results = transform_results(landing, src.read_blobs(spark, store), existing, "2024-01-01", "2024-12-31", NOW)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "SubqueryAdaptiveBroadcast dynamicpruning" in plan
    assert [(r["identifier"], r["status"]) for r in results.collect()] == [("a", "transformed")]


def test_transform_reads_the_bytes_that_landed_and_writes_only_changes(spark, tmp_path):
    def at(name):
        return str(tmp_path / name)

    one = Paths(at("store"), None, at("l1"), at("r1"), None, at("t1"))
    run_workflow(spark, items(spark, [("a", page("new"), "t5"), ("b", page("same"), "t5")]), one, "2024-01-01", "2024-12-31", NOW)
    # A capture with an older time arrives later: it is what the landing table names, so its bytes count.
    two = Paths(at("store"), at("l1"), at("l2"), at("r2"), at("t1"), at("t2"))
    late = items(spark, [("a", page("late"), "t1"), ("b", page("same"), "t6")])
    run_workflow(spark, late, two, "2024-01-01", "2024-12-31", "run-2")
    rows = {r["identifier"]: r for r in spark.read.parquet(at("r2")).collect()}
    assert rows["a"]["new_hash"] == sha("<body><p>late</p></body>") and rows["a"]["status"] == "transformed"
    assert rows["b"]["status"] == "skipped" and rows["b"]["content"] is None


def test_directory_values_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("007", "2024", "x")], "body string, partition_date string, identifier string")
    src.write_partitioned(df, str(tmp_path / "t"))
    assert src.read_blobs(spark, str(tmp_path / "t")).select(*df.columns).first() == ("007", "2024", "x")


# ---- tables that stay in place ------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def monthly(spark, rows):
    """(identifier, date, month, hash, time) captures."""
    base = {f.name: None for f in LANDING if f.name not in ("version", "created_at", "updated_at", "doc_date")}
    values = [tuple({**base, "identifier": i, "date": d, "partition_date": m, "file_hash": h, "scraped_at": t, "body": "court"}.values()) for i, d, m, h, t in rows]
    return spark.createDataFrame(values, ", ".join(f"{c} string" for c in base))


def test_merge_replaces_only_the_months_it_touches(spark, tmp_path):
    path = tmp_path / "landing"
    first = [("a", "2024-03-05", "2024-03", "1", "t1"), ("b", "05/01/2023", "2023-01", "1", "t1"), ("c", "n/a", None, "1", "t1"), ("d", "2024-03-06", "2024-03", "1", "t1"), ("m", "2022-07-01", "2022-07", "1", "t1")]
    assert {tuple(r) for r in merge_months(spark, str(path), monthly(spark, first), "run-1").collect()} == {(i, "insert") for i, *_ in first}
    before = files_of(path)
    # A change, a row that moves to another month and empties its own, a new month, and rows that do not count.
    second = [("a", "2024-03-05", "2024-03", "2", "t2"), ("a", "2024-03-05", "2024-03", "x", "t1"), ("m", "2024-03-09", "2024-03", "2", "t2"), ("e", "2021-02-01", "2021-02", "1", "t2"), (None, "2020-01-01", "2020-01", "1", "t2"), ("f", "2020-01-01", "2020-01", None, "t2")]
    actions = merge_months(spark, str(path), monthly(spark, second), "run-2").collect()
    assert {tuple(r) for r in actions} == {("a", "update"), ("m", "update"), ("d", "kept"), ("e", "insert")}
    after = files_of(path)
    assert {p.split("/")[0] for p in after} == {f"partition_date={m}" for m in ("2024-03", "2023-01", "unknown", "2021-02")}
    assert all(after.get(p) == t for p, t in before.items() if "2023-01" in p or "unknown" in p)
    table = read_landing(spark, str(path))
    assert table.columns == LANDING.fieldNames() and table.schema["partition_date"].dataType.simpleString() == "string"
    rows = {r["identifier"]: r for r in table.collect()}
    assert {i: (r["file_hash"], r["version"], r["partition_date"]) for i, r in rows.items()} == {
        "a": ("2", 2, "2024-03"), "b": ("1", 1, "2023-01"), "c": ("1", 1, "unknown"), "d": ("1", 1, "2024-03"), "e": ("1", 1, "2021-02"), "m": ("2", 2, "2024-03")}
    assert str(rows["b"]["doc_date"]) == "2023-01-05 00:00:00" and rows["c"]["doc_date"] is None and str(rows["m"]["doc_date"]) == "2024-03-09 00:00:00"
    assert (rows["a"]["created_at"], rows["a"]["updated_at"], rows["d"]["updated_at"]) == ("run-1", "run-2", None)
    held = sorted(map(tuple, table.collect()), key=str)
    # The same batch again changes nothing; an empty one touches no month.
    assert {r["action"] for r in merge_months(spark, str(path), monthly(spark, second), "run-3").collect()} == {"unchanged", "kept"}
    assert sorted(map(tuple, read_landing(spark, str(path)).collect()), key=str) == held
    before = files_of(path)
    assert merge_months(spark, str(path), monthly(spark, second).where("false"), "run-4").count() == 0 and files_of(path) == before


def test_stored_dates_and_months_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "landing")
    merge_months(spark, path, monthly(spark, [("a", "2024-03-05", "2024-03", "1", "t1"), ("b", "05/01/2023", "2023-01", "1", "t1")]), "run-1")
    chosen = filter_by_date(read_landing(spark, path), "2024-01-01", "2024-12-31")
    plan = plan_of(chosen)
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "GreaterThanOrEqual(doc_date" in pushed and "LessThan(doc_date" in pushed
    assert [r["identifier"] for r in chosen.collect()] == ["a"]
    month = src.find_by_partition(read_landing(spark, path), "2023-01")
    assert "partition_date" in plan_of(month).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert read_landing(spark, path, F.col("identifier") == "b").count() == 1
    # Tables stored without the column get it while they are read.
    old = str(tmp_path / "old")
    monthly(spark, [("a", "2024-03-05", "2024-03", "1", "t1")]).write.partitionBy("partition_date").parquet(old)
    assert str(read_landing(spark, old).first()["doc_date"]) == "2024-03-05 00:00:00"


def rows_scanned(df):
    """Rows that came out of the scans of a plan, once it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_point_lookups_skip_row_groups(spark, tmp_path):
    path = str(tmp_path / "landing")
    named = {"identifier": F.sha2(F.col("id").cast("string"), 256), "date": F.lit("2024-03-05"), "partition_date": F.lit("2024-03"), "file_hash": F.sha2(F.concat(F.lit("h"), "id"), 256)}
    rows = spark.range(60_000).select(*[named.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LANDING])
    write_landing(rows, path, row_group_bytes=1 << 18)
    wanted = sha("17")
    one = src.find_by_identifier(read_landing(spark, path), wanted)
    assert one.count() == 1
    assert 0 < rows_scanned(one) <= 20_000


def test_landing_again_stores_no_byte(spark, tmp_path):
    table, store = str(tmp_path / "landing"), tmp_path / "store"
    first = items(spark, [("a", "one", "t1"), ("a", "two", "t2"), ("b/1", "x", "t1"), ("none", None, "t1"), (None, "y", "t1")])
    actions, rejects = land(first, table, str(store), "run-1")
    assert {tuple(r) for r in actions.collect()} == {("a", "insert"), ("b/1", "insert")}
    assert sorted((r["identifier"] or "", r["stage"]) for r in rejects.collect()) == [("", "store"), ("none", "hash")]
    stored = files_of(store)
    again, _ = land(first, table, str(store), "run-2")
    assert {r["action"] for r in again.collect()} == {"unchanged"}
    assert {p for p in files_of(store) if not p.startswith("_")} == {p for p in stored if not p.startswith("_")}
    later, _ = land(items(spark, [("a", "three", "t3"), ("a", "one", "t4")]), table, str(store), "run-3")
    assert {tuple(r) for r in later.collect()} == {("a", "update"), ("b/1", "kept")}
    captures = src.stored_captures(spark, str(store)).collect()
    assert sorted((r["object_path"], r["run_ts"]) for r in captures) == [(f"Labour_Court/2024-03/{n}.html", r) for n, r in (("a", "run-1"), ("a", "run-1"), ("a", "run-3"), ("b1", "run-1"))]
    # The row names content that the first run stored; its bytes are found there.
    found = src.attach_content(read_landing(spark, table), src.read_blobs(spark, str(store))).collect()
    assert {r["identifier"]: bytes(r["content"]) for r in found} == {"a": b"one", "b/1": b"x"}


def test_items_are_made_once(spark, tmp_path):
    """Bytes that come out differently each time they are worked out: what is stored is what the table names."""
    table, store = str(tmp_path / "landing"), str(tmp_path / "store")
    captured = items(spark, [("a", "", "t1"), ("b", "", "t1"), (None, "", "t1")]).withColumn("document_content", F.uuid().cast("binary"))
    actions, rejects = land(captured, table, store, "run-1")
    assert {tuple(r) for r in actions.collect()} == {("a", "insert"), ("b", "insert")} and [r["stage"] for r in rejects.collect()] == ["store"]
    found = src.attach_content(read_landing(spark, table), src.read_blobs(spark, store)).collect()
    assert {r["identifier"]: r["file_hash"] for r in found} == {r["identifier"]: sha(bytes(r["content"] or b"").decode()) for r in found}


def test_workflow_in_place_reads_only_what_changed(spark, tmp_path):
    def at(name):
        return str(tmp_path / name)

    def paths(n):
        return Paths(at("store"), None, at("unused"), at(f"r{n}"), at(f"t{n - 1}") if n > 1 else None, at(f"t{n}"), stats=at("stats"), landing=at("landing"))

    captured = items(spark, [("a", page("one"), "t1"), ("b", page("two"), "t1")])
    run_workflow(spark, captured, paths(1), "2024-01-01", "2024-12-31", "run-1")
    changed = items(spark, [("a", page("new"), "t2"), ("b", page("two"), "t2")])
    run_workflow(spark, changed, paths(2), "2024-01-01", "2024-12-31", "run-2")
    got = {r["identifier"]: (r["version"], r["new_hash"], r["transformed_at"]) for r in spark.read.parquet(at("t2")).collect()}
    assert got == {"a": (2, sha("<body><p>new</p></body>"), "run-2"), "b": (1, sha("<body><p>two</p></body>"), "run-1")}
    told = {r["run_ts"]: (r["total"], r["transformed"], r["skipped"], r["failed"]) for r in spark.read.parquet(at("stats/transform")).collect()}
    assert told == {"run-1": (2, 2, 0, 0), "run-2": (2, 1, 1, 0)}
    counts = {r["run_ts"]: (r["upserted"], r["modified"], r["unchanged"]) for r in spark.read.parquet(at("stats/landing")).collect()}
    assert counts == {"run-1": (2, 0, 0), "run-2": (0, 1, 1)}
    # Documents cleaned by other rules, or by none that are known, are read again.
    landing, existing = read_landing(spark, at("landing")), spark.read.parquet(at("t2"))
    settled = select_documents(landing, existing, "2024-01-01", "2024-12-31")
    assert [r["settled"] for r in settled.collect()] == [True, True]
    older = select_documents(landing, existing.withColumn("cleaner_version", F.lit(0)), "2024-01-01", "2024-12-31")
    assert not any(r["settled"] for r in older.collect())
    results = results_of(older, src.read_blobs(spark, at("store")), "run-3").collect()
    assert {(r["identifier"], r["status"]) for r in results} == {("a", "skipped"), ("b", "skipped")}
    assert not any(r["settled"] for r in select_documents(landing, existing.drop("cleaner_version"), "2024-01-01", "2024-12-31").collect())


def test_failures_are_counted_while_results_are_written(spark, tmp_path):
    rows = spark.createDataFrame([("a", "s", "2024-01"), ("b", "s", "2024-01"), ("c", "s", "2024-02")], "status string, body string, partition_date string")
    status = F.when(F.col("status") == "a", "failed").when(F.col("status") == "b", "skipped").otherwise("transformed")
    for n, df in enumerate((rows, rows.where("false"))):
        seen = Observation()
        src.write_partitioned(df.withColumn("status", status), str(tmp_path / str(n)), seen=seen, counts=stats.transform_counts())
        assert tuple(stats.observed(spark, seen, ["total", "transformed", "skipped", "failed"]).first()) == ((3, 1, 1, 1) if n == 0 else (0, 0, 0, 0))
