"""BPE, shards, revisits and licences."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import bpe, licences, revisit, ring
from daybook.llm.query_tokens import tokenizer_path


def test_ids_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    rng = random.Random(1)
    odd = [0x85, 0xA0, 0x1C, 0x1F, 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x200B, 0x660, 0x2160, 0x300, 0xFEFF]
    letters = [chr(c) for c in [*range(0x250), *odd]] + ["<|endoftext|>", "'s", "'ll", "  ", "\n\n"] * 20
    texts = [None, "", "ab" * 20_000, " " * 300] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    texts += ["".join(rng.choice("abet ") for _ in range(rng.randint(0, 200))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "i long, text string, ids string")
    made = bpe.decode(bpe.encode(df, tokenizer_path()), tokenizer_path())
    both = bpe.round_trip(df, tokenizer_path()).collect()
    for r, b in zip(sorted(made.collect()), sorted(both)):
        want = library.encode(texts[r.i] or "", add_special_tokens=False).ids
        assert r.ids == want == b.ids
        assert r.decoded == b.decoded == library.decode(want, skip_special_tokens=False)
    cut = spark.createDataFrame([([144, 254],), (None,), ([],)], "ids array<int>")  # half of a character
    want = [library.decode([144, 254], skip_special_tokens=False), "", ""]
    assert [r.decoded for r in bpe.decode(cut, tokenizer_path()).collect()] == want


def test_one_tree_equals_many():
    with open(tokenizer_path(), "rb") as file:
        codec = bpe.Codec(file.read())
    rng = random.Random(3)
    for _ in range(300):
        piece = "".join(rng.choice("theandionrs") for _ in range(rng.randint(1, 60)))
        assert codec.alone(piece.encode()) == codec.learn({piece})[piece]


def check_shards(rows, shards):
    sizes = [sum(r.shard == k for r in rows) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for k in range(shards):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))


def test_ring(spark):
    rows = [(1 if i % 3 else i, i % 2, None) for i in range(9000)] + [(None, 1, None)] * 50
    df = spark.createDataFrame(rows, "k long, extra int, nothing string")
    got = ring.assign(df, "k", 16).collect()
    check_shards(got, 16)
    assert sorted(str((r.k, r.extra)) for r in got) == sorted(str(r[:2]) for r in rows)
    plain = spark.range(20_000).withColumnRenamed("id", "k")
    first = {r.k: r for r in ring.assign(plain, "k", 16).collect()}
    check_shards(list(first.values()), 16)
    assert sum(r.shard == r.home_shard for r in first.values()) > 0.8 * len(first)
    more = {r.k: r.shard for r in ring.assign(plain, "k", 17).collect()}
    assert sum(more[k] != r.shard for k, r in first.items()) < 0.35 * len(first)  # a new hash would move nearly all
    assert ring.assign(df.limit(0), "k").count() == 0


def test_walk_goes_on_clockwise():
    assert ring.walk([(0, 0, 5), (1, 0, 1)], [0, 1], 2) == [(0, 0, 0, 2, 0, 0), (0, 0, 3, 4, 1, 0), (1, 0, 0, 0, 1, 2)]


def archive(spark, rows):
    schema = "record_id string, url string, ts long, kind string, etag string, last_modified long, headers map<string,string>, note string"
    return spark.createDataFrame([(*r, "own") for r in rows], schema)


def test_urls(spark):
    cases = {
        "HTTP://user@WWW.Example.com:80/A/?utm_source=x&b=1#top": "example.com/A/?b=1",
        "https://example.com/A/?b=1&ref=z": "example.com/A/?b=1",
        "https://example.com/": "example.com",
        "not a url": "not a url",
        "": "",
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string").select("url", revisit.canonical_url(F.col("url")).alias("key"))
    assert {r.url: r.key for r in df.collect()} == cases


@pytest.mark.parametrize("block", [10, 1_000_000])
def test_revisits(spark, block):
    full = {"Content-Type": "text/html", "Date": "1"}
    rows = [
        ("r1", "http://a.com/x", 100, "response", "t1", 5, full),
        ("r2", "http://a.com/x", 200, "response", "t2", 6, full),
        ("r3", "http://a.com/x", 200, "response", "t3", 6, {"content-type": "x"}),
        ("v1", "https://www.a.com/x#y", 150, "revisit", "t1", None, {"DATE": "2", "Content-Length": "0"}),
        ("v2", "http://a.com/x", 200, "revisit", "t1", None, None),
        ("v3", "http://a.com/x", 5000, "revisit", "t1", None, {}),
        ("v4", "http://a.com/x", 100, "revisit", "t1", None, {}),
        ("v5", "http://a.com/x", 300, "revisit", None, 6, {}),
        ("v6", "http://a.com/x", 300, "revisit", None, None, {}),
        ("v7", None, 300, "revisit", "t1", None, {}),
        ("v8", "http://a.com/x", None, "revisit", "t1", None, {}),
        ("r9", None, 1, "response", "t1", None, full),
    ]
    got = {r.record_id: r for r in revisit.resolve(archive(spark, rows), block).collect()}
    found = {k: (r.response_id, r.outcome) for k, r in got.items()}
    assert found == {
        "v1": ("r1", "confirmed"), "v2": ("r1", "confirmed"), "v3": ("r3", "changed"), "v4": (None, "missing"),
        "v5": ("r3", "confirmed"), "v6": ("r3", "unchecked"), "v7": (None, "missing"), "v8": (None, "missing"),
    }
    assert got["v1"].headers == {"content-type": "text/html", "date": "2"} and got["v3"].headers is None
    assert got["v2"].headers == {"content-type": "text/html", "date": "1"}
    assert revisit.resolve(archive(spark, [])).count() == 0


def plain_scan(text, templates=None):
    grams, out = licences.bigrams(text or ""), []
    for name, template in sorted((templates or licences.TEMPLATES).items()):
        other, kept = Counter(licences.bigrams(template)), []
        size = sum(other.values())
        for i in range(len(grams)):
            held, common, best = Counter(), 0, (0, None)
            for j in range(i, min(len(grams), i + 2 * size) if grams[i] in other else i):
                held[grams[j]] += 1
                common += held[grams[j]] <= other[grams[j]]
                dice = 2 * common / (j - i + 1 + size)
                if dice > best[0]:
                    best = (dice, j + 1)
            if best[0] < 0.8:
                continue
            if not kept or i > kept[-1][2]:
                kept.append((name, i, best[1], best[0]))
            elif best[0] > kept[-1][3]:
                kept[-1] = (name, i, best[1], best[0])
        out += kept
    return out


def scanned(df, **settings):
    return {r.i: [(m["name"], m["first"], m["last"], m["dice"]) for m in r.licences] for r in licences.scan(df, **settings).collect()}


def test_licences_equal_all_comparisons(spark):
    rng = random.Random(4)
    texts = [None, "", "\n\n", "mit", "Released under the MIT License", "x " * 30_000 + "\nReleased under the MIT license!", "of the " * 300]
    short = [t for t in licences.TEMPLATES.values() if len(t) < 100]
    for k in range(90):
        parts = []
        for _ in range(rng.choice([1, 1, 2, 4])):
            words = rng.choice(short if k % 9 else list(licences.TEMPLATES.values())).split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(["the", "THE", "of", ""])
            parts += [rng.choice(["", "Some prose here, of the License.", "more \u212a."]), rng.choice([" ", "\n * "]).join(words)]
        texts.append("\n".join(parts))
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "i long, text string, licences string")
    assert scanned(df) == {i: plain_scan(t) for i, t in enumerate(texts)}
    assert licences.scan(df.limit(0)).count() == 0 and licences.scan(df).columns == df.columns


def test_licences_with_repeated_bigrams(spark):
    rng = random.Random(8)
    templates = {"t": "a b a b a b c", "u": "a a a a", "none": "word", "v": "c a b c a b"}
    texts = [" ".join(rng.choice("aabbcd") for _ in range(rng.randint(2, 40))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    known = {n: t for n, t in templates.items() if n != "none"}
    assert scanned(df, templates=templates) == {i: plain_scan(t, known) for i, t in enumerate(texts)}
    assert set(map(len, scanned(df, templates={"none": "word"}).values())) == {0}


def test_licences_in_sentences_wrapped_and_whole(spark):
    grant = licences.TEMPLATES["mit-grant"]
    texts = [
        "This project is released under the MIT License, see LICENSE.",
        "# Use of this source code is governed\n# by a BSD-style license.",
        "Copyright 2020 A. Body\n\n" + grant,
        "// " + licences.TEMPLATES["apache-2.0-header"].replace("\n", "\n// "),
        licences.TEMPLATES["mit-text"],
        "The licence of the software is not told here, and the rights to use are those of the people.",
    ]
    found = scanned(spark.createDataFrame(list(enumerate(texts)), "i long, text string"))
    assert [sorted(m[0] for m in found[i]) for i in range(6)] == [
        ["mit"], ["bsd-3-clause"], ["mit-grant"], ["apache-2.0", "apache-2.0-header"], ["mit-grant", "mit-text"], [],
    ]


def test_licences_at_the_least_likeness_count(spark):
    texts = ["Licensed under CC BY-NC", "Licensed under CC BY-NC x y z 4.0. a b c"]  # 4 of 4 and 5 of 9 bigrams against 6: 0.8 and less
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    assert scanned(df) == {0: [("cc-by-nc-4.0", 0, 4, 0.8)], 1: [("cc-by-nc-4.0", 0, 4, 0.8)]}


def test_repeated_records_and_names_that_differ_in_case(spark):
    twice = ("r1", "http://a.com/x", 100, "response", "t1", 5, {"ETag": "t1", "etag": "zz", "X": "1"})
    rows = [twice, twice, ("v1", "http://a.com/x", 150, "revisit", "t1", None, {"Date": "2", "DATE": "1", "date": "3"}),
            ("v2", "http://a.com/x", 160, "revisit", "t1", None, None), ("v2", "http://a.com/x", 160, "revisit", "t1", None, None)]
    for block in (10, 1_000_000):
        got = revisit.resolve(archive(spark, rows), block).collect()
        assert sorted(r.record_id for r in got) == ["v1", "v2", "v2"]
        assert {r.record_id: r.headers for r in got} == {"v1": {"etag": "t1", "x": "1", "date": "1"}, "v2": {"etag": "t1", "x": "1"}}
