"""Operators of the subpackage against plain versions on small rows: copies, repeats, packing, pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import bwt_merge, components, decontaminate, packing, repeat_runs, scratch, simhash_pivots, suffix_dedup

DOCS = "doc_id long, text string, bits string, start string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], DOCS)


# ---- near-duplicates ----------------------------------------------------------------------------


def reached(pairs, nodes):
    label = {n: n for n in nodes}

    def find(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    pick = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(pick.randint(200, 400), pick.randint(200, 400)) for _ in range(120)]
    pick.shuffle(pairs)
    got = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = reached(pairs, {n for p in pairs if p[0] != p[1] for n in p})
    assert {r["node"]: r["label"] for r in got} == want and len(got) == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_against_all_pairs(spark):
    pick = random.Random(5)
    prints = [pick.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    for _ in range(240):
        n = pick.choice(prints)
        for _ in range(pick.randint(0, 4)):
            n ^= 1 << pick.randrange(64)
        prints.append(n)
    signed = [n - (1 << 64) if n >> 63 else n for n in prints]
    got = simhash_pivots.links(spark.createDataFrame([(n,) for n in signed], "bits long")).collect()
    distinct = sorted(set(signed))
    want = {(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want) > 50


def test_near_duplicates_edges(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long), (9, long.upper()), (3, None), (4, ""), (7, " \n"), (8, "one two"), (8, "one two"), (None, long)]
    got = simhash_pivots.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"]): r for r in got}
    assert by[5]["fingerprint"] == by[9]["fingerprint"] and by[9]["component_id"] == 5 == by[None]["component_id"]
    assert {by[i]["component_id"] for i in (3, 4, 7)} == {3} and by[3]["fingerprint"] == "0" * 16
    kept = simhash_pivots.one_per_group(docs(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 5, 8]
    assert simhash_pivots.near_duplicates(docs(spark, [])).count() == 0


def test_pipeline_stage_keeps_one_of_each_component(spark):
    import corpus_pipeline

    pick = random.Random(12)
    rows = [(1000, None), (1001, " "), (1002, "one two"), (1003, "One two"), (1004, "one")]
    for i in range(20):
        base = [f"w{pick.randrange(5000)}" for _ in range(300)]
        for j in range(6):
            words = list(base)
            for _ in range(pick.choice([0, 1, 1, 2, 4])):
                words[pick.randrange(len(words))] = f"x{pick.randrange(10**6)}"
            rows.append((10 * i + j, " ".join(words)))
    pick.shuffle(rows)
    prints = {i: simhash_pivots.text_fingerprint(t) & (1 << 64) - 1 for i, t in rows}
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = set(reached(pairs, ids).values())
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema)
    got = corpus_pipeline.near_duplicates(spark, table, "").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(want) and len(pairs) > 60 and 20 < len(want) < 120


CLASHING = "_key _text _own _copies _kept_key _kept_text _told _f label bits component_id bucket node _held hash item n_words _at".split()


def test_input_columns_named_like_internal_ones_stay(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    text = " ".join(f"w{i}" for i in range(50))
    table = spark.createDataFrame([(1, text, "en", "s", 0), (2, text, None, "s", 0), (3, "other words here", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    table = table.select("*", *[F.lit(i).alias(name) for i, name in enumerate(CLASHING)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, table, sf)
        assert got.columns == table.columns, name
        rows = got.collect()
        assert {r["doc_id"] for r in rows} == ({1, 3} if name == "near_duplicates" else {1, 2, 3})
        assert all(r[c] == i for r in rows for i, c in enumerate(CLASHING)), name
        assert stage(spark, table.where("false"), sf).count() == 0


def test_one_model_run_in_language_id(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    plan = corpus_pipeline.language_id(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_scratch_folders_go_once_a_result_is_written(spark, tmp_path):
    begun = scratch.made_so_far()
    one, first = scratch.written(spark.range(3), "a")
    two, second = scratch.written(one.where("id > 0"), "b")
    scratch.discard_since(spark, begun, keep=second)
    assert two.count() == 2 and scratch.made_so_far() == begun
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(first)


def test_rows_without_an_id_of_their_own_stay_unless_duplicates(spark):
    a, b, c, d, e = (" ".join(f"{letter}{i}" for i in range(50)) for letter in "abcde")
    rows = [(None, a), (None, a), (None, b), (None, c), (5, c), (7, d), (7, e), (7, e), (8, d)]
    got = simhash_pivots.one_per_group(docs(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, a), (0, b), (5, c), (7, d), (7, e)]


def test_decontamination_judges_each_text_by_itself(spark):
    item = "the quick brown fox jumps over the lazy dog today"
    rows = [(None, item), (None, "one two three four five six"), (7, f"so {item} yes"), (7, "seven eight nine ten eleven twelve"), (8, None)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.decontaminate(docs(spark, rows), items).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == [(0, rows[1][1]), (7, rows[3][1]), (8, "")]


# ---- repeats ------------------------------------------------------------------------------------


def test_merge_of_transforms_finds_repeated_strings():
    pick = random.Random(1)
    for length, letters in ((3, "ab"), (6, "abc"), (10, "ab")):
        base = "".join(pick.choices(letters, k=300)).encode()
        segments = [base[a : a + pick.randint(0, 60)] for a in (pick.randrange(250) for _ in range(30))] + [b"", b"\x00\xff" * 9]
        at = {}
        for i, s in enumerate(segments):
            for p in range(len(s) - length + 1):
                at.setdefault(s[p : p + length], set()).add((i, p))
        want = {frozenset(v) for v in at.values() if len(v) > 1}
        seg, pos, block = bwt_merge.repeated_blocks(segments, length, shard_bytes=200)
        got = {}
        for s, p, b in zip(seg.tolist(), pos.tolist(), block.tolist()):
            got.setdefault(b, set()).add((s, p))
        assert {frozenset(v) for v in got.values()} == want


def plain_removal(rows, window=100):
    """Per (id, text): kept bytes, bytes removed and runs removed."""
    out, first = {}, {}
    texts = sorted({(i, t or "") for i, t in rows}, key=lambda r: r[0])
    for i, t in texts:
        data = t.encode()
        for p in range(len(data) - window + 1):
            first.setdefault(data[p : p + window], (i, p))
    for i, t in texts:
        data = t.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - window + 1):
            if first[data[p : p + window]] != (i, p):
                gone[p : p + window] = b"\1" * window
        n_runs = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out[i, t] = bytes(b for b, g in zip(data, gone) if not g), sum(gone), n_runs
    return out


def test_repeats_against_plain(spark):
    pick = random.Random(4)

    def prose(n):
        return "".join(pick.choice("abcdefghij é\n") for _ in range(n))

    passage, short = prose(150), prose(90)
    rows = [(i, prose(pick.randint(0, 400))) for i in range(20)]
    rows += [(20 + i, prose(pick.randint(0, 80)) + passage + prose(50)) for i in range(10)]
    rows += [(30 + i, prose(60) + short + prose(60)) for i in range(10)]
    rows += [(40, rows[0][1]), (41, rows[25][1]), (42, "ab" * 300), (43, "x" * 99), (44, "x" * 101), (45, "x" * 250), (46, None), (47, "")]
    rows += [(48, passage * 2 + prose(10)), (49, "ab" * 60 + passage[:120] + "ab" * 60), (49, "ab" * 60 + passage[:120] + "ab" * 60)]
    rows += [(50 + i, "".join(c if pick.random() > 0.01 else "X" for c in rows[22][1])) for i in range(6)]
    got = suffix_dedup.remove_repeats(docs(spark, rows)).collect()
    want = plain_removal(rows)
    assert sorted((r["doc_id"], bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in got) == sorted((i, *want[i, t or ""]) for i, t in rows)
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_frequent_grams_do_not_change_which_windows_meet(share):
    pick = random.Random(9)
    text = bytes(pick.choice(b"abc") for _ in range(3000)) * 2
    data, ends = np.frombuffer(text, np.uint8), np.array([len(text)])
    grams = np.unique(repeat_runs.gram_hashes(data) >> np.uint64(1))
    some = np.sort(grams[: int(share * len(grams))])
    _, start, count, gram, _, _ = repeat_runs.runs(data, ends, some)
    per_window = {s + k: g for s, c, g in zip(start.tolist(), count.tolist(), gram.tolist()) for k in range(c)}
    assert len(per_window) == len(text) - 99
    assert all(per_window[p] == per_window[p + 3000] for p in range(3000 - 99))


# ---- packing ------------------------------------------------------------------------------------


def test_first_fit_decreasing_against_plain():
    pick = random.Random(6)
    for _ in range(40):
        cap = pick.choice([8, 64])
        sizes = sorted((pick.randint(1, cap) for _ in range(pick.randint(0, 120))), reverse=True)
        room, want = [], []
        for s in sizes:
            k = next((i for i, r in enumerate(room) if r >= s), len(room))
            if k == len(room):
                room.append(cap)
            want.append((k, cap - room[k]))
            room[k] -= s
        assert list(zip(*packing.first_fit_decreasing(sizes, cap))) == want


def test_tokenizer_cache_against_tokenizer():
    pick = random.Random(7)
    own = packing.WordTokenizer(None)
    signs = "aAbBeéÉßüÜçñ'.,!? \t\n\x0b\u0085 İΣσ<|>endoftext01_-ſǅŁłﬁ中े́"
    for i in range(3000):
        text = "".join(pick.choice(signs) for _ in range(pick.randint(0, 25))) + "<|endoftext|> a" * (i % 7 == 0)
        want = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(next(own.encode([text])), "<u4").tolist() == want, text


def test_packed_pieces(spark):
    pick = random.Random(8)
    rows = [(i, " ".join(pick.choice(["tok", "a,", "zebra"]) for _ in range(pick.randint(0, 90)))) for i in range(120)] + [(500, None), (501, ""), (7, "again"), (None, "n")]
    out = packing.pack_documents(docs(spark, rows), capacity=64, docs_per_group=40).toPandas()
    tokenizer = packing.WordTokenizer(None).tokenizer
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    assert out["length"].sum() == sum(len(x) for _, x in ids)
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and g["length"].sum() <= 64
    known = {(i, len(x), s): np.array(x[s : s + 64], "<u4").tobytes() for i, x in ids for s in range(0, len(x), 64)}
    for r in out.itertuples():
        key = (None if np.isnan(r.doc_id) else int(r.doc_id), r.doc_tokens, r.start)
        assert bytes(r.ids) == known[key] and r.ids_crc32 == zlib.crc32(known[key])
    assert packing.pack_documents(docs(spark, [])).count() == 0


# ---- pipeline -----------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    columns = spark.read.parquet(f"{sf}/documents.parquet")
    first = columns.where("doc_id = 0").first()
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()
    extra = [(900, first["text"], "fr", "s", 0), (901, None, None, "s", 0), (902, "12 34", None, "s", 0), (903, f"so it says {item['text']} and on it goes", None, "s", 0),
             (904, "write to jane.doe@mail.example.com now please my dear friend", None, "s", 0)]
    docs = columns.unionByName(spark.createDataFrame(extra, columns.schema))
    names = [n for n, _ in corpus_pipeline.STAGES]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        if name != names[-1]:
            assert docs.columns == columns.columns and docs.dtypes == columns.dtypes
        seen[name] = docs.toPandas()
        docs = spark.createDataFrame(seen[name], docs.schema)
    ids = {n: set(seen[n]["doc_id"]) for n in names}
    assert not {901, 902} & ids["language_id"] and {900, 903, 904} <= ids["language_id"]
    assert 900 not in ids["near_duplicates"] and 0 in ids["near_duplicates"]
    assert 903 in ids["near_duplicates"] and 903 not in ids["benchmark_decontamination"]
    text = seen["personal_data"].set_index("doc_id").loc[904, "text"]
    assert "jane.doe" not in text and text.endswith("@mail.example.com now please my dear friend")
    assert ids["packing"] == ids["personal_data"] == ids["benchmark_decontamination"]


def test_queries_of_fixed_columns(spark):
    from folioflow.llm.queries import ORACLES, QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
