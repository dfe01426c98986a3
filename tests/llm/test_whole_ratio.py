"""Toxicity: every word of a text takes part in its score, also those below the margin and those that speak against."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest

from stocktally.llm import toxicity as tox
from tests.llm.test_llm import LABELS, SMALL, grams_by_force, table


@pytest.mark.parametrize("common", [0, 300, tox._COMMON])
def test_all_words_count_in_the_whole_ratio(spark, monkeypatch, common):
    """By loops over all n-grams of all words, whether workers hold none, some or all of the n-grams' ratios."""
    monkeypatch.setattr(tox, "_COMMON", common)
    words = lambda t: (t or "").lower().encode().split()
    docs = table(spark, SMALL, "documents").select("doc_id", "text").limit(100)
    data = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "é " * 30), (5, None), (6, ""), (7, "same same SAME")]
    labels = {i: int(i % 4 == 0) for i, _ in data if i is not None}
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i in labels}
    counts = [Counter(), Counter()]
    for i, t in data:
        if i is not None and fold[i] not in (0, 4):
            for w in words(t):
                counts[labels[i]].update(grams_by_force(w))
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    table_ = [(signed(g), counts[1][g], counts[0][g]) for g in {*counts[0], *counts[1]}]
    ratio = {r.gram: r.ratio for r in tox.gram_ratios(spark.createDataFrame(table_, "gram long, toxic long, ordinary long"), 20.0).collect()}
    want = [(i, t, sum(ratio.get(signed(g), 0) for w in words(t) for g in grams_by_force(w)) / tox._UNIT / max(len(words(t)), 1)) for i, t in data]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = tox.score_toxicity(df, spark.createDataFrame([(i, 1, y) for i, y in labels.items()], LABELS)).collect()
    as_text = lambda rows: sorted((str(i), str(t), f"{x + 0.0:.9f}".replace("-0.000000000", "0.000000000")) for i, t, x in rows)
    assert as_text((r.doc_id, r.text, r.whole_ratio) for r in got) == as_text(want)
    assert min(w[2] for w in want) < 0 < max(w[2] for w in want)


def test_the_curve_weighs_both_ratios():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(400_000, 2))
    label = (rng.random(len(x)) < 1 / (1 + np.exp(-(2 * x[:, 0] + x[:, 1] - 1)))).astype(float)
    slopes, offset = tox.calibrated(x, label)
    assert abs(slopes - [2, 1]).max() < 0.1 and abs(offset + 1) < 0.1
    few = tox.calibrated(x[:80], label[:80])[0]
    assert 0 < few[1] < 0.05 * few[0]  # some dozen rows hardly weigh the second
    assert tox.calibrated(x, label * 0)[0].tolist() == [60, 0]
