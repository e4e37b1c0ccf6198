"""Phrases, best-fit packing and periodic runs against plain versions on small rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from folioflow.llm import best_fit, collocations, count_automata, packing, periodic_runs
from folioflow.llm.periodic_runs_query import made_periodic, op13

DOCS = "doc_id long, text string, lang string, runs string, range string, _key string, piece string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "clash", "clash", "clash", "clash") for i, t, lang in rows], DOCS)


# ---- phrases ------------------------------------------------------------------------------------


def random_phrases(pick, n, words):
    out = Counter()
    for _ in range(n):
        out[tuple(pick.choice(words) for _ in range(pick.randint(1, 4)))] += pick.choice([1, 1, 1, 5])
    return out


def automaton(counts):
    symbols = sorted({w for p in counts for w in p})
    number = {w: i for i, w in enumerate(symbols)}
    phrases = {}
    for k in {len(p) for p in counts}:
        own = [p for p in counts if len(p) == k]
        phrases[k] = np.array([[number[w] for w in p] for p in own]), np.array([counts[p] for p in own])
    return count_automata.CountAutomaton.build(symbols, phrases)


def listed(a):
    return Counter({tuple(a.symbols[i] for i in row): int(w) for ids, weights in a.phrases().values() for row, w in zip(ids.tolist(), weights)})


def test_automata_hold_sum_and_look_up_counts():
    pick = random.Random(3)
    words = [w.encode() for w in "a b c dd \u00e9 f".split()]
    for n in (0, 1, 5, 200, 900):
        parts = [random_phrases(pick, n, words) for _ in range(3)]
        built = [count_automata.CountAutomaton.from_bytes(automaton(p).to_bytes()) for p in parts]
        assert [listed(a) for a in built] == parts
        whole = count_automata.union(built)
        total = sum(parts, Counter())
        assert listed(whole) == total
        asked = [list(p) for p in random_phrases(pick, 300, [*words, b"unknown"])]
        assert whole.compose(asked).tolist() == [total.get(tuple(p), 0) for p in asked]
    # Equal ends are shared: 40 first words with the same followers have one state for them.
    shared = automaton(Counter({(f"x{i}".encode(), w): 7 for i in range(40) for w in words}))
    assert len(shared.label) == 40 + len(words)


def plain_collocations(rows, least, top, share=80):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", lowered):
            words = re.findall("[^ \\t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        covered = Counter()
        for p, a in often.items():
            for k in range(2, len(p)):
                for s in range(len(p) - k + 1):
                    covered[p[s : s + k]] = max(covered[p[s : s + k]], a)
        scored = []
        for p, a in often.items():
            if 100 * covered[p] >= share * a:
                continue
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("words_per_range", [50, 10**6])
def test_collocations_against_plain_counts(spark, monkeypatch, words_per_range):
    monkeypatch.setattr(collocations, "_PARTS_AT_ONCE", 7)
    pick = random.Random(6)
    words = ["the", "The", "of", "New", "york\u00a0city", "a\tb", "\u00c9t\u00e9", "\u00e9t\u00e9", "x", "and", "\x00", "it's"]
    chance = [9, 3, 5, 2, 2, 2, 1, 1, 2, 3, 1, 1]
    rows = [(i, "".join(pick.choices(words, chance)[0] + pick.choice([" ", " ", "  ", "\t", ", ", ".", "\r\n", " \x0b", "\x85 "]) for _ in range(pick.randint(0, 120))), pick.choice(["en", "en", "fr", None, "und"])) for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, "only here", "de"), (None, "the the the the the", "en"), (7, "the the the the the", "en"), (7, "the the the the the", "en")]
    for least, top in ((5, 2000), (8, 10)):
        got = collocations.collocations(docs(spark, rows), least=least, top=top, words_per_range=words_per_range)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = plain_collocations(rows, least, top)
        assert sorted(map(tuple, got.collect())) == want and len(want) >= 30


def test_collocations_of_little(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [(1, "too rare", "en")])).count() == 0


# ---- best fit -----------------------------------------------------------------------------------


def test_large_documents_are_matched_at_best():
    pick = random.Random(4)
    for _ in range(200):
        sizes = sorted((pick.randint(34, 100) for _ in range(pick.randint(0, 11))), reverse=True)
        bins, offsets = best_fit.match_and_fit(sizes, 100)

        def most_pairs(rest):
            if len(rest) < 2:
                return 0
            one, *rest = rest
            return max([most_pairs(tuple(rest))] + [1 + most_pairs(tuple(rest[:i] + rest[i + 1 :])) for i in range(len(rest)) if one + rest[i] <= 100])

        assert len(set(bins)) == len(sizes) - most_pairs(tuple(sizes))


def test_small_documents_take_the_best_gap():
    pick = random.Random(9)
    for _ in range(60):
        capacity = pick.choice([9, 50, 300])
        sizes = sorted((pick.randint(1, capacity) for _ in range(pick.randint(0, 80))), reverse=True)
        bins, offsets = best_fit.match_and_fit(sizes, capacity)
        room = {}
        for size, own, offset in zip(sizes, bins, offsets):
            if 3 * size > capacity:
                assert offset == capacity - room.get(own, capacity)
            else:
                fitting = [r for r in room.values() if r >= size]
                assert offset == capacity - (min(fitting) if fitting else capacity)
            room[own] = room.get(own, capacity) - size
            assert room[own] >= 0


def test_packed_documents(spark):
    pick = random.Random(8)
    rows = [(i, " ".join(pick.choice(["tok", "a,", "zebra"]) for _ in range(pick.randint(0, 150))), "en") for i in range(150)]
    rows += [(500, None, "en"), (501, "", "en"), (7, "again", "en"), (7, "again", "en"), (None, "n", "en")]
    out = best_fit.pack_documents(docs(spark, rows), capacity=64, docs_per_group=60).toPandas()
    tokenizer = packing.WordTokenizer(None).tokenizer
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, _ in rows]
    want = Counter((i, s // 64, s, np.array(x[s : s + 64], "<u4").tobytes()) for i, x in ids for s in range(0, len(x), 64))
    assert Counter((None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, bytes(r.ids)) for r in out.itertuples()) == want
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4 for r in out.itertuples())
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and g["length"].sum() <= 64
    assert out["sequence_id"].nunique() <= sum(len(x) for _, x in ids) / 64 * 1.1 + 6
    assert best_fit.pack_documents(docs(spark, [])).count() == 0


# ---- periodic runs ------------------------------------------------------------------------------


def plain_runs(words, least=24, exponent=3):
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(r for r in found if not any(p < r[2] and s <= r[0] and s + n >= r[0] + r[1] for s, n, p in found))


def periodic_texts():
    pick = random.Random(7)
    out = [None, "", " \n", "one", "w " * 23, "w " * 24, "w\x0bv\r" * 12, "a b c " * 8 + "a b c x", "\u00a0 x " * 12]
    for _ in range(120):
        words = []
        while len(words) < pick.choice([5, 60, 300]):
            root = [pick.choice("abcd") for _ in range(pick.choice([1, 2, 3, 5, 8, 13, 40]))]
            words += (root * 9)[: pick.randint(1, 8 * len(root))]
        out.append(" ".join(words))
    return out + [out[-1]]


def test_runs_against_all_periods(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "_WORDS_AT_ONCE", 1000)
    texts = periodic_texts()
    rows = [(None if i == 20 else i // 2, t, "en") for i, t in enumerate(texts)]
    got = periodic_runs.periodic_runs(docs(spark, rows))
    assert got.columns == ["doc_id", "runs", "collapsed"]
    made = Counter((r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in got.collect())
    want, total = Counter(), 0
    for i, text, _ in rows:
        words = (text or "").encode().split()
        runs = plain_runs(words)
        total += len(runs)
        kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
        want[i, tuple(runs), b" ".join(kept).decode()] += 1
    assert made == want and total > 100
    assert periodic_runs.periodic_runs(docs(spark, [])).count() == 0


def test_query_of_runs(spark, tmp_path):
    texts = periodic_texts()
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(None, "a b " * 30, "en")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op13(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        words = made_periodic(i, (text or "").encode())
        mark = None if i is None else zlib.crc32(str(i).encode())
        if mark is not None and mark % 10 == 0 and words:
            own = (text or "").encode().split()
            a = mark // 10 % len(own)
            p = 1 + (len(own) - a) // (3 + mark // 10 % 8)
            assert words == [own[k] if k < a else own[a + (k - a) % p] for k in range(len(own))]
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        row = got[i]
        assert row["n_runs"] == len(runs) and (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
