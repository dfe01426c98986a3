"""Quality classifier: similarity-weighted votes of labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stocktally.llm.common import Shared, Words, chunks, collected, fold_of, labelled_ids, labelled_texts, mix64, with_columns

_EDGE = 1984  # buckets of word beginnings, and as many of word ends
_SHAPES = 72  # kinds of words by their capitals, small letters, digits and other characters
_TERMS = 2 * _EDGE + _SHAPES + 1  # the last one: words equal to the word before
_ROWS = 512  # documents of one block of products
_SCORED = 128  # documents that a worker scores at once: some 350 KB for each, in every worker of an executor


@dataclass
class QualityModel:
    idf: np.ndarray
    basis: np.ndarray  # terms x dims
    vectors: np.ndarray  # labelled documents x dims, of length 1
    labels: np.ndarray
    weights: np.ndarray  # labelled rows that a vector stands for
    neighbours: int
    sharpness: float

    def embed(self, counts: np.ndarray) -> np.ndarray:
        z = weighted(counts, self.idf).astype(np.float64) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Shares of the votes for label 1: exact cosines against every labelled vector, one block of documents.

        Cosines are rounded to nine places and ties at the last neighbour go to the earlier vector, so that a text's
        score does not depend on the texts beside it.
        """
        some = counts.any(axis=1)
        out = np.zeros(len(counts))
        if not len(self.labels):
            out[some] = 0.5
            return out
        near = np.round(self.embed(counts[some]) @ self.vectors.T, 9)
        k = min(self.neighbours, near.shape[1])
        top = np.argpartition(np.arange(near.shape[1]) * 1e-14 - near, k - 1, axis=1)[:, :k]
        top.sort(axis=1)
        votes = np.take_along_axis(near, top, 1).clip(0) ** self.sharpness * self.weights[top]
        total = votes.sum(1)
        share = (votes * self.labels[top]).sum(1) / np.maximum(total, 1e-300)
        out[some] = np.where(total > 0, share, np.average(self.labels, weights=self.weights)).clip(0, 1)
        return out


def term_counts(texts: list[str | None]) -> np.ndarray:
    """Texts x terms: hashed beginnings and ends of words, word shapes, immediate repeats."""
    words = Words(texts)
    n = len(texts)
    out = np.zeros(n * _TERMS, np.int64)
    if len(words.ids):
        raw, starts = words.bytes()
        wide, first, size = raw.astype(np.uint64), starts[:-1] + 1, np.diff(starts) - 1

        def edge(at):
            code = np.full(len(first), 1 << 40, np.uint64)
            for k in range(3):
                code += np.where(size > k, wide[np.minimum(at(k), len(wide) - 1)], 0) << np.uint64(8 * k)
            return code

        begin = mix64(edge(lambda k: first + k)) % np.uint64(_EDGE)
        end = mix64(edge(lambda k: first + size - 1 - k) + np.uint64(1 << 50)) % np.uint64(_EDGE)
        upper, digit = (raw >= 65) & (raw <= 90), (raw >= 48) & (raw <= 57)
        lower = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
        other = (raw > 0) & ~upper & ~lower & ~digit
        u, l, d, o = (np.add.reduceat(x.astype(np.int64), starts[:-1]) for x in (upper, lower, digit, other))
        shape = np.minimum(u, 2) * 24 + np.minimum(l, 1) * 12 + np.minimum(d, 1) * 6 + np.minimum(o, 3)
        base = words.docs * _TERMS
        for offset, term in ((0, begin.astype(np.int64)), (_EDGE, end.astype(np.int64)), (2 * _EDGE, shape)):
            out += np.bincount(base + offset + term[words.ids], minlength=len(out))
        again = np.flatnonzero((words.ids[1:] == words.ids[:-1]) & (words.docs[1:] == words.docs[:-1])) + 1
        out += np.bincount(base[again] + _TERMS - 1, minlength=len(out))
    return out.reshape(n, _TERMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Square roots of term shares times idf, of length 1, then the shares of word shapes and repeats once more."""
    n = counts[:, 2 * _EDGE : 2 * _EDGE + _SHAPES].sum(1, keepdims=True)
    share = np.sqrt(counts / np.maximum(n, 1))
    terms = share * idf
    terms /= np.maximum(np.linalg.norm(terms, axis=1, keepdims=True), 1e-12)
    both = np.concatenate([terms, 2 * share[:, 2 * _EDGE :]], 1).astype(np.float32)
    return both / np.maximum(np.linalg.norm(both, axis=1, keepdims=True), 1e-12)


def fit(sample: DataFrame, totals: dict[int, int], dims: int = 64, neighbours: int = 11, sharpness: float = 8.0) -> QualityModel:
    """Model of a bounded frame (doc_id, __text, __label): its term counts come to the driver, its texts do not.

    totals has the labelled rows of each label; a vector's vote counts for as many as it stands for.
    """

    def packed(texts):
        out = []
        for a, b in chunks(np.ones(len(texts), np.int64), _SCORED):
            for row in term_counts(texts[a:b]):
                at = np.flatnonzero(row)
                out.append(np.concatenate([at, row[at]]).astype(np.int32).tobytes())
        return [out]

    rows = collected(with_columns(sample, "__text", "terms binary", packed, keep=["doc_id", "__label"])).sort_by(
        [("doc_id", "ascending"), ("__label", "ascending")]
    )
    labels = np.array(rows.column("__label").to_pylist(), np.float64)
    shown = {label: int((labels == label).sum()) for label in set(labels.tolist())}
    weights = np.array([max(totals.get(int(x), 0) / shown[x], 1.0) for x in labels.tolist()])
    cells = [np.frombuffer(c, np.int32).reshape(2, -1) for c in rows.column("terms").to_pylist()]
    seen = np.zeros(_TERMS)
    for at, _ in cells:
        seen[at] += 1
    idf = np.log((1 + len(labels)) / (1 + seen))
    width = _TERMS + _SHAPES + 1
    if not len(labels):
        return QualityModel(idf, np.zeros((width, 1), np.float32), np.zeros((0, 1), np.float32), labels, weights, neighbours, sharpness)
    # One matrix of single precision; counts exist for one block of rows at a time.
    x = np.empty((len(labels), width), np.float32)
    for a, b in chunks(np.ones(len(cells), np.int64), _ROWS):
        counts = np.zeros((b - a, _TERMS), np.int64)
        for i, (at, n) in enumerate(cells[a:b]):
            counts[i, at] = n
        x[a:b] = weighted(counts, idf)
    dims = min(dims, *x.shape)
    # Truncated singular vectors by subspace iteration from a fixed start.
    q = np.random.default_rng(5).normal(size=(x.shape[1], min(dims + 16, x.shape[1]))).astype(np.float32)
    for _ in range(4):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    basis = (q @ np.linalg.svd(x @ q, full_matrices=False)[2].T)[:, :dims].astype(np.float32)
    vectors = x.astype(np.float64) @ basis if len(x) <= _ROWS else np.concatenate([x[a:b].astype(np.float64) @ basis for a, b in chunks(np.ones(len(x), np.int64), _ROWS)])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return QualityModel(idf, basis.astype(np.float64), vectors, labels, weights, neighbours, sharpness)


def classify_quality(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 5, held_out: int = 0, sample_per_class: int = 2000,
    threshold: float = 0.3, keep: list[str] | None = None,
) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted.

    At most about `sample_per_class` labelled rows of each label, outside the held-out fold, become the broadcast
    vectors (2 x 2000 x 64 doubles by default, 2 MB); a vote counts for the labelled rows that its vector stands for, so
    that the labels keep their natural mix in tables of every size; every document is compared with all of them in blocks.
    A null or empty text has score 0; without any labelled rows other texts have 0.5; a text unlike every labelled
    one gets the mean label. Copies of a text get the same score, also of a very long one, which is taken whole; of
    equally near neighbours the ones with the smaller ids vote. Input columns of the new names are replaced.
    """
    totals = {r["__label"]: r["count"] for r in labelled_ids(labels, label, folds, held_out).groupBy("__label").count().collect()}  # a row per label
    model = fit(labelled_texts(docs, labels, label, folds, held_out, sample_per_class), totals)
    shared = Shared(docs.sparkSession, model)

    def compute(texts):
        scores = [shared.value.score(term_counts(texts[a:b])) for a, b in chunks(np.ones(len(texts), np.int64), _SCORED)]
        score = np.concatenate(scores)
        return [score, (score >= threshold).astype(np.int32)]

    scored = with_columns(docs, "text", "score double, predicted int", compute, keep=None if keep is None else list({*keep, "doc_id"}))
    out = scored.withColumn("held_out", F.coalesce(fold_of(F.col("doc_id"), folds) == held_out, F.lit(False)))
    return out if keep is None else out.select(*keep, "held_out", "score", "predicted")
