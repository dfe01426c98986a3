"""Rows without an id, one id for many rows, equal rows: nothing is lost, bounds hold, scores do not depend on neighbours."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktally.llm import near_duplicates as near, quality_knn as knn
from stocktally.llm.common import bounded_sample, chunks, labelled_texts, table
from stocktally.llm.lang_id import identify_language
from stocktally.llm.url_filter import filter_urls

SMALL = "/root/testdata/sf0.01"
ID = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 == 0)  # in a fold that is learned from
TEXT = "the quick brown fox jumps over the lazy dog and then it runs away from all of the other animals that live in this old forest near the river bank by the mill"


def near_text(k):
    words = TEXT.split()
    words[-1] = f"w{k}"
    return " ".join(words)


def kept(spark, data):
    out = near.keep_one(spark.createDataFrame(data, "doc_id long, text string").withColumns({"__x": F.lit("mine"), "__row": F.lit(1)}))
    assert out.columns == ["doc_id", "text", "__x", "__row"]
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_a_row_like_no_other_stays_whatever_its_id(spark):
    other = "something else that has nothing to do with the first text in any way at all"
    assert kept(spark, [(2, TEXT), (5, TEXT), (5, other)]) == [(2, TEXT), (5, other)]
    assert kept(spark, [(5, TEXT), (5, other), (5, TEXT)]) == sorted([(5, TEXT), (5, other)], key=str)
    assert kept(spark, [(None, TEXT), (7, near_text(1)), (None, other), (None, None), (None, None), (1, ""), (1, "")]) == sorted(
        [(7, near_text(1)), (None, other), (None, None), (None, None), (1, ""), (1, "")], key=str)
    assert len(kept(spark, [(None, TEXT), (None, near_text(1)), (None, TEXT)])) == 1
    assert kept(spark, [(3, near_text(1)), (3, near_text(2)), (4, TEXT)])[0][0] == 3 and len(kept(spark, [(3, near_text(1)), (3, near_text(2)), (4, TEXT)])) == 1


def test_links_of_documents_without_an_id(spark):
    data = [(None, near_text(1)), (None, near_text(2)), (9, TEXT), (None, "on its own with no other text at all"), (8, TEXT)]
    got = near.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.class_id, r.copy_of, r.n_links) for r in got), key=str) == sorted(
        [(None, 8, None, 3), (None, 8, None, 3), (9, 8, 8, 3), (8, 8, 8, 3), (None, None, None, 0)], key=str)


def test_many_equal_rows_of_a_class(spark):
    data = [(None, TEXT)] * 300 + [(k, near_text(k)) for k in range(200)]
    got = near.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(6), block=16)
    assert {(r.class_id, r.n_links) for r in got.collect()} == {(0, 499)}
    assert len(kept(spark, data)) == 1


def test_sample_bounds_hold_for_one_id(spark):
    one = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"), (F.col("id") % 2).cast("int").alias("lang"))
    for most in (10, 400):
        got = bounded_sample(one, "doc_id", most, None, "text").count()
        assert most / 2 <= got <= 2 * most
        by = {r.lang: r["count"] for r in bounded_sample(one, "doc_id", most, "lang", "text").groupBy("lang").count().collect()}
        assert all(most / 2 <= by[k] <= 2 * most for k in (0, 1))
    same = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    assert bounded_sample(same, "doc_id", 10, None, "text").count() == 1
    assert bounded_sample(one.limit(0), "doc_id", 10, "lang", "text").count() == 0
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    docs = one.select("doc_id", "text").unionByName(spark.createDataFrame([(6, "six"), (7, "seven")], "doc_id long, text string"))
    rows = labelled_texts(docs, labels, "quality", 5, 9, 20)
    assert rows.filter("__label = 1").count() <= 40 and rows.filter("__label = 0").count() == 1


def test_a_language_of_one_id_is_learned(spark):
    words = {"aa": "un deux trois quatre cinq six sept huit neuf dix", "bb": "one two three four five six seven eight nine ten"}
    rng = np.random.default_rng(0)
    data = [(ID, " ".join(rng.choice(words[lang].split(), 12)), lang) for lang in words for _ in range(300)]
    got = identify_language(spark.createDataFrame(data, "doc_id long, text string, lang string"), per_language=40, keep=["lang"])
    assert got.filter("lang = lang_pred").count() >= 0.95 * len(data)


@pytest.mark.parametrize("text, letter", [("² ½ ①", False), ("Ⅷ ४", False), ("__ 12", False), ("ª", True), ("你", True), ("ʰ", True), ("1 é", True), ("́", False)])
def test_letters_are_of_category_l(spark, text, letter):
    data = [(i, t, lang) for i, (t, lang) in enumerate([("ein Text", "de"), ("a text", "en"), ("noch einer", "de"), ("one more", "en"), (text, None)])]
    got = {r.doc_id: r.lang_pred for r in identify_language(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert (got[4] != "und") == letter


def test_urls_without_a_page_id(spark):
    urls = [f"https://a.{t}/{w}/{i}" for i in range(60) for t, w in (("good", "xx"), ("bad", "y/z"), ("else", "xx"))]
    rules = [("good/", "allow"), ("bad/", "block")]
    for ids in ([None] * len(urls), [7] * len(urls), [None, 3] * (len(urls) // 2)):
        for most in (20_000, 25):
            got = filter_urls(spark.createDataFrame(list(zip(ids, urls, strict=True)), "page_id long, url string"), rules, sample_per_class=most).collect()
            assert len(got) == len(urls) and {r.verdict for r in got if ".good/" in r.url} == {"allow"} and {r.verdict for r in got if ".bad/" in r.url} == {"block"}
            assert all(r.verdict == "allow" and r.score < 0.5 for r in got if ".else/" in r.url)
    few = filter_urls(spark.createDataFrame([(None, u) for u in urls[:4]], "page_id long, url string"), rules).collect()
    assert len(few) == 4


def test_quality_scores_do_not_depend_on_the_texts_beside(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    texts = [r.text for r in docs.limit(200).collect()]
    model = knn.fit(labelled_texts(docs, labels.withColumn("quality", F.col("doc_id").cast("int") % 2), "quality", 5, 0, 2000), {0: 160, 1: 160})
    counts = knn.term_counts(texts + texts[:50])
    whole = model.score(counts)
    assert whole[:50].tolist() == whole[200:].tolist()
    for size in (1, 7, 64):
        assert np.concatenate([model.score(counts[a:b]) for a, b in chunks(np.ones(len(counts), np.int64), rows=size)]).tolist() == whole.tolist()


def test_quality_scores_against_force(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    model = knn.fit(labelled_texts(docs, labels, "quality", 5, 0, 60), {0: 500, 1: 3000})
    counts = knn.term_counts([r.text for r in docs.limit(60).collect()])
    vectors = model.embed(counts)
    for row, got in zip(vectors, model.score(counts), strict=True):
        near_ = sorted((-round(float(row @ v), 9), i) for i, v in enumerate(model.vectors))[: model.neighbours]
        votes = [(max(-s, 0.0) ** model.sharpness * model.weights[i], model.labels[i]) for s, i in near_]
        assert abs(got - sum(v * y for v, y in votes) / sum(v for v, _ in votes)) < 1e-9
    shown = {y: (model.labels == y).sum() for y in (0, 1)}
    assert all(abs(w * shown[int(y)] - {0: 500, 1: 3000}[int(y)]) < 1e-6 for w, y in zip(model.weights, model.labels, strict=True))


def test_queries_of_a_bucket_in_turns(spark):
    from stocktally.llm.neighbours import nearest

    vectors = table(spark, SMALL, "embeddings")
    extra = spark.range(10_000, 10_400).select((F.col("id") * 50).alias("vec_id"), F.array([F.lit(1.0).cast("float")] * 64).alias("embedding"))
    vectors = vectors.select("vec_id", "embedding").unionByName(extra)
    want, got = (sorted(map(tuple, nearest(vectors, F.col("vec_id") % 50 == 0, block=100, asked_block=n).collect())) for n in (8192, 60))
    assert got == want and len(want) == 5 * (400 + 10)


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline as cp

    docs = table(spark, SMALL, "documents").filter("doc_id < 300")
    good = docs.filter("length(text) > 400").limit(3).collect()
    odd = [(None, good[0].text, "en", None, 1), (None, good[0].text, "en", None, 1), (good[1].doc_id, good[2].text + " more words", "de", "", 1), (900, None, None, None, None), (901, "", "en", "a", 0),
           (902, "12 34", "en", "a", 5), (903, good[0].text * 40, "en", "a", 1)]
    root = str(tmp_path)
    docs.unionByName(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{root}/documents.parquet")
    table(spark, SMALL, "labels").write.parquet(f"{root}/labels.parquet")
    got = cp.run(spark, root)
    assert all(r.round_trip for r in got.collect()) and 50 < got.select("doc_id").distinct().count() and got.filter("doc_id in (900, 901)").count() == 0
    none = str(tmp_path / "none")
    docs.limit(0).write.parquet(f"{none}/documents.parquet")
    table(spark, SMALL, "labels").limit(0).write.parquet(f"{none}/labels.parquet")
    assert cp.run(spark, none).count() == 0
