"""Workers of the quality classifier score a bounded number of documents at once."""

from __future__ import annotations

from stocktally.llm import quality_knn
from stocktally.llm.quality_knn import classify_quality


def test_a_worker_scores_128_documents_at_once(spark, tmp_path):
    log = tmp_path / "sizes"
    log.mkdir()
    score = quality_knn.QualityModel.score

    class Watched(quality_knn.QualityModel):
        def score(self, counts):
            (log / f"{len(counts)}").touch()
            return score(self, counts)

    fit = quality_knn.fit
    docs = spark.createDataFrame([(i, f"words of text {i % 7} and {'more ' * (i % 5)}") for i in range(700)], "doc_id long, text string").coalesce(1)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    whole = {r.doc_id: r.score for r in classify_quality(docs, labels).collect()}
    try:
        quality_knn.fit = lambda *a, **k: Watched(**vars(fit(*a, **k)))
        watched = {r.doc_id: r.score for r in classify_quality(docs, labels).collect()}
    finally:
        quality_knn.fit = fit
    assert watched == whole and len(watched) == 700
    assert max(int(p.name) for p in log.iterdir()) <= 128
