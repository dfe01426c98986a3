"""The forest shortens prefixes less where nodes are crowded, and loses no link by it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktally.llm import near_duplicates as near
from tests.llm.test_llm import links_by_force, rows, varied


def crowd_of_pairs(pairs, shared, own, seed):
    """Pairs of near copies, all of which share a passage: pairs are at about 0.8 to 0.9, others at shared / (shared + 2 own)."""
    rng = np.random.default_rng(seed)
    passage = [f"p{x}" for x in range(shared)]
    out = []
    for k in range(pairs):
        rest = [f"o{k}_{x}" for x in range(own)]
        near_copy = list(rest)
        for at in rng.choice(own, 2, replace=False):
            near_copy[at] = f"c{k}_{at}"
        out += [" ".join(passage + rest), " ".join(passage + near_copy)]
    return out


@pytest.fixture(scope="module")
def mixed():
    return dict(enumerate(crowd_of_pairs(60, 100, 40, 3) + varied(12, 1) + varied(6, 2, 1) + ["a b c", "a b c", "", None]))


def forest_of(spark, texts, crowd, **options):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    plain = df.select("doc_id", "text", *near._row_key())
    settings = {"shingle": 5, "threshold": 0.8, "trees": 20, "depth": 5, "seed": 0} | options
    sketched = near.sketches(plain, 5, settings["trees"], settings["depth"], settings["seed"])
    classes = sketched.filter("__n > 0").groupBy("__class").agg(
        F.min("doc_id").alias("__first"), F.first("__nodes").alias("__nodes"), F.min(F.struct("__x", "__y")).alias("__shown")
    ).cache()
    found = near.forest(classes, plain.filter("text IS NOT NULL").select("__x", "__y", "text"), deepest=14, crowd=crowd, **settings)
    first = {r["__class"]: r["__first"] for r in classes.collect()}
    return [(first[r["__class"]], first[r["__head"]], r["__depth"]) for r in found.collect()]


@pytest.mark.parametrize("crowd", [1, 15])
def test_links_with_any_crowd(spark, mixed, crowd):
    links, group = links_by_force(mixed)
    got = rows(near.near_duplicates(spark.createDataFrame(list(mixed.items()), "doc_id long, text string"), crowd=crowd))
    assert len(got) == len(mixed)
    for r in got:
        k = r["doc_id"]
        assert (r["n_links"], r["class_id"]) == (len(links[k]), group[k]), k


def test_depth_differs_between_a_dense_and_a_sparse_part(spark, mixed):
    found = forest_of(spark, mixed, 15)
    dense = {d for a, b, d in found if a < 120}
    sparse = {d for a, b, d in found if a >= 120}
    assert {5, 8} <= dense and sparse == {5}
    assert {d for *_, d in forest_of(spark, mixed, 1000)} == {5}


def test_long_prefixes_part_a_crowd(spark):
    """Candidates that are no pair go down where prefixes stay long, and all pairs are still found."""
    texts = dict(enumerate(crowd_of_pairs(150, 60, 50, 3)))
    wrong = lambda found: len({(a, b) for a, b, _ in found if a // 2 != b // 2})
    assert wrong(forest_of(spark, texts, 5)) < 0.5 * wrong(forest_of(spark, texts, 1000))


def test_recall_at_the_threshold_inside_a_crowd(spark):
    """Pairs at 0.8 meet in the deep prefixes of two crowded classes as often as promised."""
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(3000):
        common, a, b = np.split(rng.integers(0, 1 << 63, 90, dtype=np.uint64), [80, 80 + 10])
        sets.append((np.concatenate([common, a]), np.concatenate([common, b])))
    trees = near.trees_for(8, 0.8, 0.999)
    rng = np.random.default_rng(9)
    factors = rng.integers(1, 1 << 63, trees * 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salts = rng.integers(0, 1 << 63, trees * 8, dtype=np.uint64)
    lows = lambda s: ((s[:, None] ^ salts) * factors).min(axis=0).reshape(trees, 8)
    met = np.mean([(lows(a) == lows(b)).all(axis=1).any() for a, b in sets])
    assert met >= 0.99


def test_trees_follow_the_depth():
    for depth in range(1, 10):
        n = near.trees_for(depth, 0.8, 0.999)
        assert 1 - (1 - 0.8**depth) ** n >= 0.999 and (n == 1 or 1 - (1 - 0.8**depth) ** (n - 1) < 0.999)
    assert near.trees_for(8, 1.0, 0.999) == 1


def test_one_text_in_a_third_of_the_rows_beside_a_crowd(spark, mixed):
    texts = list(mixed.values())
    data = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0])] * 40 + [(3, texts[3])] * 40
    got = near.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), crowd=4)
    assert got.count() == len(data)
    copies = {r["n_copies"] for r in got.filter("doc_id IN (0, 3) OR doc_id IS NULL").collect()}
    assert copies == {41}
