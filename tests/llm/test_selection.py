"""Importance resampling and preference pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import preference, quality

DOC = "doc_id long, text string, kept string"
LABEL = "doc_id long, quality int, toxic int"


def test_features_are_words_and_pairs():
    buckets, row = quality.features(pa.array(["The cat, the CAT", None, "", "x"]))
    assert np.bincount(row, minlength=4).tolist() == [9, 0, 0, 1]  # five words and four pairs
    again, _ = quality.features(pa.array(["the cat , the cat"]))
    assert sorted(buckets[row == 0]) == sorted(again)


def test_log_ratio_ignores_noise():
    raw, target = np.array([1000.0, 1000.0, 3.0]), np.array([300.0, 0.0, 1.0])
    ratio = quality.log_ratio(raw, target, 1.0, 3.0)
    assert ratio[0] > 0 > ratio[1] and ratio[2] == 0
    assert not quality.log_ratio(raw, target * 0, 1.0, 3.0).any()


@pytest.mark.parametrize("k", [1, 2, 50, 299, 400])
def test_kth_largest_is_exact(spark, k):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) ** 5 for _ in range(300)] + [0.25] * 100
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert quality.kth_largest(df, "v", k, bins=7, few=3 if k != 400 else 10) == sorted(values, reverse=True)[k - 1]


def test_bad_documents_are_rejected(spark):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice("the of and to a in river stone house light".split()) for _ in range(60))
    bad = lambda: " ".join(rng.choice("BUY!! now$$$ click*** free%%% win###".split()) for _ in range(60))
    rows = [(i, bad() if i % 5 == 0 else good(), "x") for i in range(400)]
    labels = [(i, int(i % 5 != 0), 0) for i in range(0, 400, 2)]
    docs, marks = spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, LABEL)
    kept = quality.keep_good(docs, marks)
    assert kept.columns == ["doc_id", "text", "kept"]
    got = kept.collect()
    assert {r.kept for r in got} == {"x"} and not [r for r in got if r.doc_id % 5 == 0]
    assert len(got) >= 310
    key = {r.doc_id: r for r in quality.resample(docs.drop("kept"), marks).collect()}
    assert all(math.isfinite(r.gumbel_key) for r in key.values()) and len(key) == 400


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (1, "", "b"), (2, "x " * 50_000, "c")], DOC)
    none = spark.createDataFrame([], LABEL)
    assert quality.keep_good(docs, none).count() == 4
    some = spark.createDataFrame([(2, 1, 0), (2, 1, 0), (None, 1, 0), (9, 1, 0)], LABEL)
    assert quality.resample(docs.drop("kept"), some).count() == 4
    assert quality.keep_good(docs.limit(0), some).count() == 0


TURN = "k long, turn long, role string, text string, prompt string"


def pairs(spark, chosen, rejected):
    as_rows = lambda rows: spark.createDataFrame([(k, t, r, x, "own") for k, t, r, x in rows], TURN)
    out = preference.format_preferences(as_rows(chosen), as_rows(rejected), "k").collect()
    return {r.k: r for r in out}


def test_prompt_is_the_longest_common_prefix(spark):
    start = [(1, 0, "system", "s"), (1, 1, "user", "q")]
    got = pairs(spark, [*start, (1, 2, "assistant", "yes")], [*start[::-1], (1, 5, "assistant", "no"), (1, 6, "user", "?")])[1]
    assert got.prompt == "<|system|>\ns<|end|>\n<|user|>\nq<|end|>\n" and got.prompt_turns == 2 and got.usable
    assert got.chosen == "<|assistant|>\nyes<|end|>\n"
    assert got.chosen_mask == "0" * len("<|assistant|>\n") + "1" * len("yes<|end|>\n")
    assert got.rejected_mask.endswith("0" * len("<|user|>\n?<|end|>\n")) and len(got.rejected_mask) == len(got.rejected)


def test_odd_conversations(spark):
    same = [(2, 0, "user", "a"), (2, 1, "assistant", "b")]
    got = pairs(
        spark,
        [*same, (3, 0, None, None), (4, 0, "user", ""), (None, 0, "user", "lost"), (6, 0, "assistant", "é" * 9), (6, 0, "assistant", "é" * 9)],
        [*same, (3, 0, None, None), (4, 0, "user", None), (5, None, "assistant", "z")],
    )
    assert set(got) == {2, 3, 4, 5, 6}
    assert got[2].chosen == got[2].rejected == "" and not got[2].usable and got[2].prompt_turns == 2
    assert got[3].prompt == "<||>\n<|end|>\n" and got[3].prompt_turns == 1
    assert got[4].prompt_turns == 0 and got[4].chosen == got[4].rejected
    assert got[5].chosen == "" and got[5].rejected_mask.count("1") == len("z<|end|>\n")
    assert got[6].chosen_mask.count("1") == 2 * len("ééééééééé<|end|>\n") and got[6].rejected == ""
    assert pairs(spark, [], []) == {}
