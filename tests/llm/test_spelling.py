"""Spelling variants against all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from daybook.llm import spelling
from daybook.llm.query_spelling import op12_spelling

DOC = "doc_id long, text string, word string"


def plain_counts(rows):
    n = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            check = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if check % 97 == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(n):
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def variants(rng, word):
    k = rng.randrange(len(word) + 1)
    letter = rng.choice("abcdeàÿ×")
    return rng.choice([word[:k] + letter + word[k:], word[:k] + word[k + 1 :], word[:k] + letter + word[k + 1 :]])


def test_query_equals_all_pairs(spark, tmp_path):
    rng = random.Random(1)
    base = ["".join(rng.choice("abcde") for _ in range(rng.choice([4, 5, 6, 9, 14]))) for _ in range(60)]
    words = base + [variants(rng, variants(rng, w)) for w in base * 3] + [variants(rng, w) for w in base * 6]
    rows = [(k, rng.choice([" ", "7", "\n"]).join(rng.choices(words, k=300)).replace("ab", rng.choice(["AB", "aB"])), "") for k in range(60)]
    rows += [(None, "aaaaa " * 3 + "aaaaaa " * 40, ""), (None, None, ""), (5, "", ""), rows[0], rows[0], (9, "naïveté NAÏVETÉ Naïvete naïvete naïvete" * 3, "")]
    rows += [(70 + k, "b" * 3000 + "c" * (k % 3) + "d" * 2000 + " " + "a" * (5 + k), "") for k in range(12)] * 3
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["word"]: tuple(r)[1:] for r in op12_spelling(spark, str(tmp_path)).collect()}
    expected = plain(plain_counts(rows))
    assert out == expected
    assert sum(v[0] is not None for v in expected.values()) > 30 and any(len(w) > 4000 for w in expected)


def test_neighbours_at_every_place(spark):
    rng = random.Random(2)
    base = "".join(rng.choice("xyz") for _ in range(11))
    made = {base} | {base[:k] + c + base[k + d :] for k in range(12) for c in ("", "q", "é", "x") for d in (0, 1)}
    words = sorted(w for w in made if len(w) >= 5)
    df = spark.createDataFrame(list(enumerate(words)), "id long, word string")
    pairs = {(r["id"], r["near"]) for r in spelling.neighbours(df).collect()}
    assert pairs == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i != j and one_edit(a, b)}


def test_roots_follow_long_chains(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(37)]
    assert {r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {"w37"}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_spelling(spark, str(tmp_path)).collect() == []
