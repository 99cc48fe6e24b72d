"""Benchmark passages and repeated passages against plain loops."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import decontaminate, sais, suffix

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def word_list(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, size):
    out = []
    for text in docs:
        words, hit, found = word_list(text), set(), set()
        for name, item in items:
            parts = word_list(item)
            width = min(size, len(parts))
            windows = {tuple(parts[i : i + width]) for i in range(len(parts) - width + 1)} if parts else set()
            for at in range(len(words) - width + 1):
                if tuple(words[at : at + width]) in windows:
                    hit |= set(range(at, at + width))
                    found.add(name)
        out.append((len(words), len(hit), sorted(found)))
    return out


def test_search_equals_a_plain_one():
    rng = random.Random(5)
    for _ in range(120):
        letters = rng.choice(["ab", "abcde", "abcdefgh"])
        some = lambda n: " ".join(rng.choice(letters) * rng.randint(1, 2) for _ in range(n))  # noqa: B023, E731
        items = [(str(i), rng.choice([None, "", some(3), some(20), some(30)])) for i in range(rng.randint(0, 5))]
        docs = [rng.choice([None, "", "É,b", some(40).upper(), some(60)]) for _ in range(rng.randint(1, 6))]
        size = rng.choice([1, 2, 3, 10])
        got = decontaminate.Benchmark([k for k, _ in items], pa.array([t or "" for _, t in items], pa.string()), size).search(pa.array(docs, pa.string()))
        got = zip(got["n_words"].to_pylist(), got["n_hit"].to_pylist(), [sorted(set(x)) for x in got["items"].to_pylist()])
        assert list(got) == plain_search(docs, items, size)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_blocks_give_the_same(spark, block_bytes):
    text = [f"w{i}" for i in range(60)]
    items = spark.createDataFrame([(k, " ".join(text[5 * k : 5 * k + 14])) for k in range(8)] + [(None, "lone words"), (3, None)], "item_id long, text string")
    rows = [(1, " ".join(text), 7), (2, " ".join(text[3:30]), 7), (None, "Lone, WORDS!", 7), (4, None, 7), (4, "", 7), (5, "w1 w2", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items int")
    got = decontaminate.find_passages(docs.drop("items"), items, block_bytes=block_bytes).collect()
    want = plain_search([r[1] for r in rows], [(str(k), t) for k, t in [*((k, " ".join(text[5 * k : 5 * k + 14])) for k in range(8)), ("", "lone words")]], 10)
    got = sorted((r.n_words, r.n_hit, list(r["items"])) for r in got)
    assert got == sorted((a, b, sorted(c)) for a, b, c in want)
    clean = decontaminate.remove_contaminated(docs, items, block_bytes=block_bytes)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [4, 4, 5]


def test_longest_match_and_places(spark):
    item = " ".join(f"w{i}" for i in range(30))
    doc = f"a b {' '.join(f'w{i}' for i in range(4, 20))} c"
    got = decontaminate.find_passages(spark.createDataFrame([(doc,)], "text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert (got.longest, [tuple(m) for m in got.matches], [tuple(h) for h in got.hits]) == (16, [("1", 2, 16)], [(2, 18)])


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([("a b c",)], "text string"), spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.find_passages(docs, items).collect()] == [0]
    assert decontaminate.find_passages(docs.limit(0), items).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for k in range(150):
        n, letters = int(rng.integers(0, 80)), int(rng.integers(1, 6))
        x = rng.integers(1, letters + 1, n)
        x = np.tile(x[: max(1, n // 4)], 5) if k % 3 == 0 and n else x
        s = np.concatenate([x, [0]]).astype(np.uint8 if k % 2 else np.uint16)
        values = s.tolist()
        want = sorted(range(len(values)), key=lambda i: values[i:])
        array = sais.suffix_array(s)
        assert array.tolist() == want
        shared = sais.permuted_prefixes(s, array)
        for i, j in zip(want[1:], want):
            same = 0
            while max(i, j) + same < len(values) and values[i + same] == values[j + same]:
                same += 1
            assert shared[i] == same


def test_names_beyond_the_recursion_are_sorted_too():
    rng = np.random.default_rng(4)
    x = rng.integers(1, 250, 30_000)
    x[10_000:16_000] = x[:6_000]
    s = np.concatenate([x, [0]]).astype(np.uint8)
    array, data = sais.suffix_array(s), s.tobytes()
    assert all(data[a:] < data[b:] for a, b in zip(array[:-1], array[1:]))


def plain_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((len(d), [i for i in range(len(d)) if gone[i]], bytes(c for c, g in zip(d, gone) if not g)))
    return out


@pytest.mark.parametrize("settings", [{"anchors": (12, 40)}, {"anchors": (12, 30, 40), "crowd": 2}, {"anchors": (30, 36, 40), "crowd": 1, "shard_bytes": 500}])
def test_repeats_equal_a_plain_search(spark, settings):
    rng = random.Random(2)
    passages = ["".join(rng.choice("abcdeé \0") for _ in range(rng.randint(20, 200))) for _ in range(6)]
    texts = [None, "", "ab" * 300, "abcde" * 70, "x" * 41]
    for _ in range(120):
        own = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 80)))
        text = "".join(rng.choice([*passages, own, own]) for _ in range(rng.randint(0, 6)))
        texts += [text] * rng.choice([1, 1, 1, 2])
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r.i: r for r in suffix.remove_repeats(df, length=40, as_text=True, **settings).collect()}
    for i, (size, gone, kept) in enumerate(plain_repeats(texts, 40)):
        r = got[i]
        assert (r.n_bytes, bytes(r.kept)) == (size, kept)
        assert [b for s in r.removed for b in range(s["start"], s["end"])] == gone
        assert all(a["end"] < b["start"] for a, b in zip(r.removed, r.removed[1:]))
        assert r.kept_text == kept.decode("utf-8", "ignore")
    assert len(got) == len(texts) and suffix.remove_repeats(df.limit(0)).count() == 0


def check_repeats(spark, texts, length, **settings):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r.i: r for r in suffix.remove_repeats(df, length=length, **settings).collect()}
    for i, (size, gone, kept) in enumerate(plain_repeats(texts, length)):
        r = got[i]
        assert (r.n_bytes, bytes(r.kept)) == (size, kept)
        assert [b for s in r.removed for b in range(s["start"], s["end"])] == gone
    assert len(got) == len(texts)


def test_crowds_of_the_last_anchor_are_repeated_whole(spark):
    texts = [f"{k:03d}" + "x" * k + f"{k:03d}" for k in (38, 39, 40, 43, 47, 52, 61, 75)] + ["y" * 40, "z" * 40 + "own" + "z" * 44]
    for crowd in (0, 1, 3):
        check_repeats(spark, texts, 40, anchors=(12, 30, 40), crowd=crowd)
    check_repeats(spark, texts, 40, anchors=(40,), crowd=1)


def test_a_text_that_repeats_itself_at_any_period(spark):
    rng = random.Random(6)
    letters = [chr(c) for c in range(0x21, 0x7F)]
    texts = []
    for period in range(1, 45):  # 29, 11 and 1 hold the anchor once in each window
        unit = "".join(rng.choice(letters) for _ in range(period))
        texts.append("<" + unit * (90 // period + 2) + ">")
    for anchors in ((12, 40), (12, 30, 40), (40,)):
        check_repeats(spark, texts, 40, anchors=anchors, crowd=1)


def test_long_prose_recurses_and_is_sorted(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    text = " ".join(rng.choices(words, k=150_000)).encode()[: 1 << 20]
    s = np.concatenate([np.frombuffer(text, np.uint8), [0]]).astype(np.uint8)
    depth, stepwise = [], []
    inner, step = sais.suffix_array, sais._induce_by_step
    monkeypatch.setattr(sais, "suffix_array", lambda x: depth.append(int(x.max())) or inner(x))
    monkeypatch.setattr(sais, "_induce_by_step", lambda *a: stepwise.append(1) or step(*a))
    array = sais.suffix_array(s)
    assert len(depth) > 1 and depth[1] > 2048 and stepwise  # the names were sorted by the recursion
    assert (np.sort(array) == np.arange(len(s))).all()
    data = s.tobytes()
    ranked = array.tolist()
    assert all(data[a : a + 300] <= data[b : b + 300] for a, b in zip(ranked, ranked[1:]))


def test_many_places_of_one_run_come_back_once(spark):
    rng = random.Random(6)
    line = " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(90))
    rows = [(k, f"{k} {rng.random()} " + line + f" {rng.random()} {k}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    back = suffix.spans(df, "text", crowd=5)
    assert back.count() == 60 and {r["doc_id"]: r["n"] for r in suffix.remove_repeats(df, crowd=5).selectExpr("doc_id", "size(removed) n").collect()} == {k: 1 for k in range(60)}


def test_union_of_intervals():
    for seed in range(40):
        rng = random.Random(seed)
        pairs = [(a, a + rng.randint(1, 6)) for a in (rng.randint(0, 40) for _ in range(rng.randint(1, 9)))]
        covered = {x for a, b in pairs for x in range(a, b)}
        starts, ends = suffix.union(*np.array(pairs).T)
        assert {x for a, b in zip(starts, ends) for x in range(a, b)} == covered and (starts[1:] > ends[:-1]).all()


def test_shards_are_small(monkeypatch):
    rng = random.Random(8)
    lines = [bytes(rng.randrange(97, 123) for _ in range(900)) for _ in range(600)]
    pieces = [(k // 2, k, lines[k // 2] if k % 2 else b"<%d>" % k + lines[k // 2]) for k in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*pieces)], names=["anchor", "digest", "piece"])
    sizes, inner = [], suffix.suffix_array
    monkeypatch.setattr(suffix, "suffix_array", lambda s: sizes.append(len(s)) or inner(s))
    found = pa.Table.from_batches(suffix._shards(400, suffix.SHARD_BYTES)(iter([batch])))
    assert max(sizes) < 1 << 18 and sum(sizes) > 1 << 20
    want = [(k // 2, k, (len(b"<%d>" % k), len(b"<%d>" % k) + 501) if k % 2 == 0 else (0, 501)) for k in range(1200)]
    assert sorted((r["anchor"], r["digest"], (r["from"], r["to"])) for r in found.to_pylist()) == want


def test_runs_of_word_codes_take_one_python_worker_each(spark, monkeypatch):
    plans, keep = {}, suffix.staged
    monkeypatch.setattr(suffix, "staged", lambda df, name: plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, name))
    words = [f"w{k}" for k in range(60)]
    df = spark.createDataFrame([(1, "a " + " ".join(words) + " b"), (2, "c " + " ".join(words) + " d"), (3, None), (4, "own")], "doc_id long, text string")
    got = {r["doc_id"]: r["kept_text"] for r in suffix.remove_repeats(df, as_text=True, words=51).collect()}
    assert got == {1: "a  b", 2: "c  d", 3: "", 4: "own"}
    assert len(plans["runs"]) >= 2 and all(p.count("MapInArrow") == 1 for p in plans["runs"])
