"""The outlier test's spread and what it can reject."""

import math

import numpy as np
import pytest

from affinitext.llm import quality


def test_spread_of_a_normal_sample_is_its_own(spark):
    scale = {"length": 3.0, "word_length": 0.5, "symbols": 2.0, "duplicates": 2.0, "repeats": 2.0}
    x = np.random.default_rng(4).normal(size=(4000, 5)) * list(scale.values())
    columns = "_group string, " + ", ".join(f"_x_{k} double" for k in quality.STATS)
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], columns)
    found = quality.estimates(rows).collect()[0]
    assert list(scale) == list(quality.STATS)
    for i, s in enumerate(scale.values()):
        got = math.sqrt(sum(found[f"_l_{i}_{j}"] ** 2 for j in range(i + 1)))
        assert got == pytest.approx(s, rel=0.1)


def test_repeats_and_long_words_reject_alone(spark):
    def text(k, n, size=5):
        return " ".join(f"{k * 1000 + i:0{size}d}" for i in range(n))

    rows = [(k, text(k, 100 + 7 * k % 300), "en", "a") for k in range(1, 90)]
    twice = text(500, 13)
    rows.append((500, f"{text(501, 74)} {twice} {text(502, 2)} {twice}", "en", "a"))
    rows.append((600, text(600, 100, 12), "en", "a"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    judged = {r.doc_id: r for r in quality.verdicts(docs).collect()}
    assert not any(r._base_failed for r in judged.values())
    assert {i for i, r in judged.items() if not r._kept} == {500, 600}
