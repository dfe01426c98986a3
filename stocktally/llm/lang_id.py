"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from stocktally.llm.common import Shared, Words, bounded_sample, chunks, collected, fold_of, mix64, with_columns

BUCKETS = 1 << 15
_LETTER = regex.compile(r"\p{L}")  # numbers such as ² or Ⅷ are none
_BLOCK = 8192  # words whose subword vectors are held at a time
_GRAMS = (2, 3, 4)  # bytes of a subword; a word's ends are zero bytes


@dataclass
class LanguageModel:
    languages: list[str]
    embedding: np.ndarray  # buckets x dims
    weights: np.ndarray  # dims x languages
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0  # probabilities below this are rejected

    def probabilities(self, words: Words) -> np.ndarray:
        n = len(words.lengths)
        if not len(words.ids):
            return np.full((n, len(self.languages)), 1 / max(1, len(self.languages)))
        codes, of = subwords(words)
        starts = np.searchsorted(of, np.arange(len(words.distinct)))
        by_word = np.empty((len(starts), self.embedding.shape[1]), np.float32)
        for a in range(0, len(starts), _BLOCK):
            first = starts[a : a + _BLOCK]
            end = starts[a + _BLOCK] if a + _BLOCK < len(starts) else len(codes)
            by_word[a : a + _BLOCK] = np.add.reduceat(self.embedding[codes[first[0] : end]], first - first[0], axis=0)
        sizes = np.diff(np.append(starts, len(codes)))
        mean = words.sums(by_word) / np.maximum(words.sums(sizes), 1)[:, None]
        return softmax((mean @ self.weights + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def subwords(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the distinct words, and the word of each, in the order of the words."""
    raw, starts = words.bytes()
    wide = np.concatenate([raw.astype(np.uint64), np.zeros(max(_GRAMS), np.uint64)])
    owner = np.repeat(np.arange(len(words.distinct)), np.diff(starts))
    place = np.arange(len(owner))
    ends = starts[1:]
    codes, of = [], []
    for n in _GRAMS:
        fits = place + n - 1 <= ends[owner]
        at = place[fits]
        code = np.full(len(at), n << 40, np.uint64)
        for k in range(n):
            code += wide[at + k] << np.uint64(8 * k)
        codes.append((mix64(code) % np.uint64(BUCKETS)).astype(np.int64))
        of.append(owner[fits])
    codes, of = np.concatenate(codes), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return codes[order], of[order]


def subword_counts(texts: list[str | None]) -> list[bytes]:
    """Per text: the buckets of its subwords and their counts."""
    out = []
    for t in texts:
        words = Words([t], lower=True)
        if not len(words.ids):
            out.append(b"")
            continue
        codes, of = subwords(words)
        row = np.bincount(codes, np.bincount(words.ids, minlength=len(words.distinct))[of], BUCKETS)
        at = np.flatnonzero(row)
        out.append(np.concatenate([at, row[at]]).astype(np.int32).tobytes())
    return out


def train(cells: list[bytes], y: np.ndarray, languages: list[str], dims: int, epochs: int, rate: float) -> LanguageModel:
    """Mini-batch SGD over (buckets, counts) rows; classes weigh alike."""
    rng = np.random.default_rng(3)
    model = LanguageModel(languages, rng.normal(0, 0.1, (BUCKETS, dims)), rng.normal(0, 0.1, (dims, len(languages))), np.zeros(len(languages)))
    rows = [np.frombuffer(c, np.int32).reshape(2, -1) for c in cells]
    weight = len(y) / (len(languages) * np.maximum(np.bincount(y, minlength=len(languages)), 1))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for a in range(0, len(y), 32):
            pick = order[a : a + 32]
            used, where = np.unique(np.concatenate([rows[i][0] for i in pick]), return_inverse=True)
            x = np.zeros((len(pick), len(used)))
            line = np.repeat(np.arange(len(pick)), [rows[i].shape[1] for i in pick])
            x[line, where] = np.concatenate([rows[i][1] for i in pick])
            x /= np.maximum(x.sum(1, keepdims=True), 1)
            mean = x @ model.embedding[used]
            error = softmax(mean @ model.weights + model.bias)
            error[np.arange(len(pick)), y[pick]] -= 1
            error *= weight[y[pick]][:, None] / len(pick)
            back = x.T @ (error @ model.weights.T)
            model.weights -= step * mean.T @ error
            model.bias -= step * error.sum(0)
            model.embedding[used] -= step * 50 * back  # a subword is a small share of a text
    model.embedding = model.embedding.astype(np.float32)
    return model


def logits(model: LanguageModel, cells: list[bytes]) -> np.ndarray:
    out = np.zeros((len(cells), len(model.languages)))
    for i, c in enumerate(cells):
        at, n = np.frombuffer(c, np.int32).reshape(2, -1)
        out[i] = n @ model.embedding[at] / max(n.sum(), 1) @ model.weights + model.bias
    return out


def fit(docs: DataFrame, label: str, folds: int, held_out: int, per_language: int, dims: int, epochs: int, rate: float, lost: float, bound: float) -> LanguageModel:
    calibration = (held_out + 1) % folds
    rows = (
        docs.select(F.col("doc_id"), F.col("text").alias("__text"), F.col(label).alias("__label"))
        .withColumn("__fold", fold_of(F.col("doc_id"), folds))
        .filter((F.col("__fold") != held_out) & F.col("__label").isNotNull() & F.col("__text").isNotNull())
    )
    sample = bounded_sample(rows, "doc_id", per_language, "__label", "__text")
    cells = collected(with_columns(sample, "__text", "cell binary", lambda t: [subword_counts(t)], keep=["doc_id", "__label", "__fold"]))
    cells = cells.sort_by([("doc_id", "ascending"), ("__label", "ascending")]).to_pydict()
    used = [i for i, c in enumerate(cells["cell"]) if c]
    languages = sorted({cells["__label"][i] for i in used})
    if len(languages) < 2:
        return LanguageModel(languages, np.zeros((BUCKETS, 1), np.float32), np.zeros((1, len(languages))), np.zeros(len(languages)))
    y = np.array([languages.index(cells["__label"][i]) for i in used])
    fold = np.array([cells["__fold"][i] for i in used])
    cell = [cells["cell"][i] for i in used]
    learn = np.flatnonzero(fold != calibration)
    if len(set(y[learn].tolist())) < len(languages):
        learn = np.arange(len(y))
    model = train([cell[i] for i in learn], y[learn], languages, dims, epochs, rate)
    check = np.flatnonzero(fold == calibration)
    if len(check):
        z = logits(model, [cell[i] for i in check])
        truth = np.arange(len(check)), y[check]
        # The temperature with the least log loss on rows that were not trained on, then the rejection bound.
        grid = np.geomspace(0.3, 5, 40)
        loss = [-np.log(np.maximum(softmax(z / t)[truth], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        best = softmax(z / model.temperature).max(1)
        model.least = float(min(bound, np.quantile(best, lost)))
    return model


def identify_language(
    docs: DataFrame, *, label: str = "lang", folds: int = 4, held_out: int = 2, per_language: int = 800, dims: int = 16,
    epochs: int = 6, rate: float = 0.5, lost: float = 0.001, bound: float = 0.5, keep: list[str] | None = None,
) -> DataFrame:
    """docs with held_out, lang_pred, score and accepted.

    The model is fitted in the driver on subword counts of at most about `per_language` documents of each value of
    `label` outside the held-out fold, copies of a row counted once; a quarter of the folds sets the temperature and the rejection bound, the
    smaller of `bound` and the `lost` quantile of its confidences. Every document is scored from its whole text.
    A null text or one without a letter gets `und`, score 0, accepted false; others get the likeliest language and
    its calibrated probability, accepted if it reaches the bound. With one language only, all get it with score 1;
    with none to learn from, `und`. Copies get the same answer. Input columns of the new names are replaced.
    """
    model = fit(docs, label, folds, held_out, per_language, dims, epochs, rate, lost, bound)
    shared = Shared(docs.sparkSession, model)

    def compute(texts):
        model = shared.value
        names, scores, accepted = [], [], []
        for a, b in chunks(np.ones(len(texts), np.int64), 1024):
            part = texts[a:b]
            if not model.languages:
                names += ["und"] * len(part)
                scores += [0.0] * len(part)
                accepted += [False] * len(part)
                continue
            p = model.probabilities(Words(part, lower=True))
            for t, k, s in zip(part, p.argmax(1).tolist(), p.max(1).tolist(), strict=True):
                known = t is not None and _LETTER.search(t) is not None
                names.append(model.languages[k] if known else "und")
                scores.append(s if known else 0.0)
                accepted.append(known and s >= model.least)
        return [names, scores, accepted]

    scored = with_columns(docs, "text", "lang_pred string, score double, accepted boolean", compute, most=1 << 20, keep=None if keep is None else list({*keep, "doc_id"}))
    out = scored.withColumn("held_out", F.coalesce(fold_of(F.col("doc_id"), folds) == held_out, F.lit(False)))
    return out if keep is None else out.select(*keep, "held_out", "lang_pred", "score", "accepted")
