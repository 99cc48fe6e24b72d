"""Near copies and fingerprints."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from daybook.llm import dart, order_minhash
from test_passages import word_list

DOC = "doc_id long, text string, _id string"


def shingles(text):
    words = word_list(text)
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def plain_classes(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, total = sum((sets[i] & sets[j]).values()), sum((sets[i] | sets[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or total and both >= 0.8 * total:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        groups[root(i)].append(k)
    return {i: min((k for k in groups[root(i)] if k is not None), default=None) for i in range(len(rows))}


def sample(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows = [(None, None), (0, ""), (1, "Two words"), (2, "two, words!"), (3, "--- !!"), (4, "a " * 400), (5, "a " * 390)]
    for base in range(12):
        words = [word() for _ in range(rng.choice([8, 60, 300]))]
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows) + 3, " ".join(copy)))
    return rows


def test_agreement_is_weighted_similarity():
    rng = random.Random(7)
    texts = []
    for _ in range(60):
        words = [rng.choice("abcdefgh") for _ in range(200)]
        other = list(words)
        for _ in range(rng.randint(0, 30)):
            other[rng.randrange(200)] = rng.choice("xyz")
        texts += [" ".join(words), " ".join(other)]
    units, row = dart.elements(pa.array(texts), 2)
    found = dart.signatures(units, row, len(texts), 512)
    sets = [shingles_of(units, row, i) for i in range(len(texts))]
    for i in range(0, len(texts), 2):
        true = len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1])
        counted = [Counter(zip(t.split(), t.split()[1:])) for t in texts[i : i + 2]]
        assert abs(true - sum((counted[0] & counted[1]).values()) / sum((counted[0] | counted[1]).values())) < 1e-9
        assert abs((found[i] == found[i + 1]).mean() - true) < 0.12


def shingles_of(units, row, i):
    return set(units[row == i].tolist())


def test_fractional_weights():
    units = np.arange(1, 401, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    both, row = np.concatenate([units, units]), np.repeat([0, 1], 400)
    part = np.concatenate([np.full(400, 0.5), np.full(400, 1.0)])
    found = dart.signatures(both, row, 2, 1024, part)
    assert abs((found[0] == found[1]).mean() - 0.5) < 0.06


def test_classes_equal_all_pairs(spark):
    rows = sample()
    df = spark.createDataFrame([(k, t, "own") for k, t in rows], DOC)
    want = plain_classes(rows)
    found, links = dart.classes(df)
    got = defaultdict(set)
    for r in found.collect():
        got[r.doc_id].add(r.class_id)
    assert {k: v for k, v in got.items()} == {k: {want[i]} for i, (k, _) in enumerate(rows)}
    assert links.where("similarity < 0.8").count() == 0
    kept = dart.keep_first(df)
    assert kept.columns == df.columns and {r._id for r in kept.collect()} == {"own"}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    repeated = df.unionByName(df)
    assert dart.keep_first(repeated).count() == kept.count()


def test_similar_sets_share_an_owned_bucket(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(60) for _ in range(100)]
    sets = [(b"e", base[:1]), (b"four", base[:4]), (b"five", base[:5])]  # four and five of them: 0.8 exactly
    for i in range(60):
        size = rng.choice([60, 80, 100])
        sets.append((b"n%d" % i, rng.sample(base, size) + [rng.getrandbits(60) for _ in range(rng.choice([0, 2, 5, 25]))]))
    for i in range(80):  # a family below the least similarity: 80 units of all, 20 of one's own
        sets.append((b"f%d" % i, base[:80] + [rng.getrandbits(60) for _ in range(20)]))
    found = dart.prefix_buckets(spark.createDataFrame(sets, "key binary, units array<long>"), 0.8).collect()
    members, owners = defaultdict(set), defaultdict(set)
    for r in found:
        members[r.bucket].add(bytes(r.key))
        if r.owner:
            owners[r.bucket].add(bytes(r.key))
    met = {frozenset((a, b)) for k, who in owners.items() for a in who for b in members[k] if a != b}
    for i, (a, left) in enumerate(sets):
        for b, right in sets[:i]:
            both = len(set(left) & set(right))
            if both * 10 >= 8 * (len(left) + len(right) - both):
                assert frozenset((a, b)) in met, (a, b)
    family = [p for p in met if all(k.startswith(b"f") and k != b"five" and k != b"four" for k in p)]
    assert len(family) < 80  # of 3,160 pairs


def test_family_below_the_threshold(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    common, rows = [word() for _ in range(400)], []
    for i in range(120):  # a block of own words each: similarity of about 0.7, and some pairs of nearer relatives
        if i % 10 == 9:
            own = list(own)  # noqa: F821
            own[0] = word()
        else:
            own = [word() for _ in range(60)]
        rows.append((i, " ".join(common[:340] + own)))
    df = spark.createDataFrame([(k, t, "own") for k, t in rows], DOC)
    written = []
    keep = dart.staged
    monkeypatch.setattr(dart, "staged", lambda table, name: written.append((name, keep(table, name))) or written[-1][1])
    found, _ = dart.classes(df)
    want = plain_classes(rows)
    assert {r.doc_id: r.class_id for r in found.collect()} == {k: want[i] for i, (k, _) in enumerate(rows)}
    assert len(set(want.values())) == 108
    assert sum(t.count() for name, t in written if name == "pairs") < 1000  # all of them: 7,140


def test_later_rounds_do_not_pass_over_earlier_links(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    common, rows = [word() for _ in range(146)], []
    for i in range(90):  # near copies of one text, and others of it that are near to none
        copy = list(common)
        for _ in range(i % 9):
            copy[rng.randrange(146)] = word()
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame([(k, t, "own") for k, t in rows], DOC)
    passed, inner = [], dart.components
    monkeypatch.setattr(dart, "components", lambda links: passed.append(links.count()) or inner(links))
    found, links = dart.classes(df)
    want = plain_classes(rows)
    assert {r.doc_id: r.class_id for r in found.collect()} == {k: want[i] for i, (k, _) in enumerate(rows)}
    assert 1 < len(set(want.values())) < 90
    assert sum(passed) <= links.count()


def test_components_extended_by_links(spark):
    rng = random.Random(4)
    batches = [[(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (15, 1, 12, 12)]
    labels, all_ = None, []
    for batch in batches:
        all_ += [(min(p), max(p)) for p in batch]
        labels = dart.extended(labels, spark.createDataFrame([(min(p), max(p)) for p in batch], "a long, b long"))
        want = {k: k for p in all_ for k in p}
        for _ in want:
            for a, b in all_:
                want[a] = want[b] = min(want[a], want[b])
        got = labels.collect()
        assert len(got) == len(want) and {r.key: r.label for r in got} == want


def test_no_copies_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", "x"), (2, None, "x")], DOC)
    found, links = dart.classes(df)
    assert sorted(tuple(r) for r in found.select("doc_id", "class_id").collect()) == [(1, 1), (2, 2)] and links.count() == 0
    assert dart.keep_first(df.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51)], "a long, b long")
    got = {r.key: r.label for r in dart.components(links).collect()}
    assert got == {**{i: 0 for i in range(21)}, 50: 50, 51: 50}


def plain_fingerprint(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    return {r.k: r.f for r in order_minhash.fingerprints(df, ["k"], "text", "f").collect()}


def test_fingerprint_selects_per_bin_in_text_order(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdef") for _ in range(n)) for n in (1, 2, 3, 50, 400)]
    got = plain_fingerprint(spark, texts + texts)
    rows = spark.createDataFrame(
        [(k, i, a, b) for k, t in enumerate(texts) for w in [t.split(" ")] for i in range(max(1, len(w) - 1)) for a, b in [(w[i], w[i + 1] if i + 1 < len(w) else None)]],
        "k long, i long, a string, b string",
    )
    hashed = defaultdict(list)
    for r in rows.selectExpr("k", "i", "xxhash64(a, b) as g").collect():
        hashed[r.k].append((r.i, r.g))
    for k in range(len(texts)):
        seen, numbered = Counter(), []
        for i, g in sorted(hashed[k]):
            seen[g] += 1
            numbered.append((i, g, seen[g]))
        table = spark.createDataFrame(numbered, "i long, g long, n int").selectExpr("i", "xxhash64(g, n) as h").collect()
        bins = defaultdict(list)
        for r in table:
            bins[r.h % 64].append((r.h, r.i))
        want = []
        for b, entries in sorted(bins.items()):
            chosen = sorted((i, h & 0xFFFFFFFF) for h, i in sorted(entries)[:2])
            want.append((b, chosen[0][1], chosen[-1][1]))
        entry = spark.createDataFrame(want, "b int, x long, y long").selectExpr("shiftleft(b, 26) | int(shiftrightunsigned(xxhash64(x, y), 38)) as e")
        assert sorted(r.e for r in entry.collect()) == list(got[k]) == list(got[k + len(texts)])


def test_edits_and_neighbours(spark):
    rng = random.Random(9)
    rows = [(3 * k, " ".join(rng.choice(["é", "of", "stone", "river", "x\ny"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(0, 200)))) for k in range(40)]
    rows += [(1000, None), (1001, ""), (1002, "one")]
    texts = dict(rows)
    ids = sorted(texts)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in order_minhash.compare_edits(df).collect()}
    for k, nxt in zip(ids, ids[1:] + ids[:1]):
        text, other = texts[k] or "", texts[nxt] or ""
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        assert got[k].n_chars == len(text) and got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[k].near_next <= 1 and 0 <= got[k].near_edited <= 1
        if edited == text:
            assert got[k].near_edited == 1 and got[k].fingerprint == got[k].edited_fingerprint
    assert got[1000].fingerprint == "" and got[1000].near_next == 1
    odd = spark.createDataFrame([(None, "a b c"), (1, "d e"), (1, "d e"), (1, "f")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in order_minhash.compare_edits(odd).collect()) == ["1", "1", "1", "None"]
    assert order_minhash.compare_edits(df.limit(0)).count() == 0


def test_fingerprints_are_not_dealt_again_by_digest(spark, monkeypatch):
    plans, keep = [], order_minhash.staged
    monkeypatch.setattr(order_minhash, "staged", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, name))
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(None, "a b c"), (None, "a b"), (1, "d e"), (1, "d e"), (1, None), (2, "f")], "doc_id long, text string")
        got = order_minhash.compare_edits(df).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(got) == 6 and "SortMergeJoin [_id#" in plans[-1]
    assert re.search(r"hashpartitioning\(_id#\d+L, _digest", plans[-1]) is None
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
